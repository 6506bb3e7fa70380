"""The Spark session of the command line and the settings that tables need on any session."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC", "spark.sql.timestampType": "TIMESTAMP_NTZ", "spark.sql.adaptive.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def store_settings(endpoint: str | None, region: str | None, key: str | None, secret: str | None, token: str | None) -> dict[str, str]:
    """Hadoop's settings for an S3-like store; empty without any of them."""
    given = {"endpoint": endpoint, "endpoint.region": region if endpoint or key else None, "access.key": key, "secret.key": secret, "session.token": token}
    out = {f"fs.s3a.{k}": v for k, v in given.items() if v}
    if endpoint:
        out |= {"fs.s3a.path.style.access": "true", "fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https")).lower()}
    if token:
        out["fs.s3a.aws.credentials.provider"] = "org.apache.hadoop.fs.s3a.TemporaryAWSCredentialsProvider"
    return out


def build_session(app: str = "lakesync", **settings: str) -> SparkSession:
    """A session with the settings of this library; master, memory and so on come from spark-submit or settings."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Columns are matched by field id: needed when reading and writing tables on a session made elsewhere."""
    spark.conf.set("spark.sql.parquet.fieldId.write.enabled", "true")
    spark.conf.set("spark.sql.parquet.fieldId.read.enabled", "true")
    return spark
