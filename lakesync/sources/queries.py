"""What a job's SQL runs on: views of the Spark session, or a database over JDBC."""

from __future__ import annotations

import re
from datetime import date, datetime
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.transforms import normalise


class Source(Protocol):
    def query(self, sql: str, parameters: dict[str, Any]) -> DataFrame: ...


# Text that holds no parameters: quoted strings and names, casts, comments.
_TOKEN = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|--[^\n]*|/\*.*?\*/|::|:([A-Za-z_]\w*)", re.S)


def parameter_names(sql: str) -> list[str]:
    """Names of the :parameters of a query, in order of first appearance."""
    return list(dict.fromkeys(m[1] for m in _TOKEN.finditer(sql) if m[1]))


def literal(value: Any) -> str:
    """A value as an SQL literal for a JDBC query."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, datetime) and value.tzinfo:
        return f"TIMESTAMP WITH TIME ZONE '{value.isoformat(' ')}'"
    if isinstance(value, datetime):
        return f"{{ts '{value.isoformat(' ')}'}}"  # JDBC's own notation, which every driver translates
    if isinstance(value, date):
        return f"{{d '{value.isoformat()}'}}"
    return "'" + str(value).replace("'", "''") + "'"


def render(sql: str, parameters: dict[str, Any]) -> str:
    """The query with every :parameter replaced by a literal; a missing one raises, casts and quoted text are left alone."""
    if missing := [n for n in parameter_names(sql) if n not in parameters]:
        raise ValueError(f"Missing SQL parameter(s): {', '.join(missing)}")
    return _TOKEN.sub(lambda m: literal(parameters[m[1]]) if m[1] else m[0], sql)


class SparkSource:
    """Spark SQL over registered views. folder: a folder of <name>.parquet files to register first."""

    def __init__(self, spark: SparkSession, views: dict[str, DataFrame] | None = None, folder: str | None = None):
        self.spark = spark
        for name, df in (views or {}).items():
            df.createOrReplaceTempView(name)
        if folder:
            from .files import Files

            for name in Files(spark).names(folder):
                if name.endswith(".parquet"):
                    spark.read.parquet(f"{folder.rstrip('/')}/{name}").createOrReplaceTempView(name.removesuffix(".parquet"))

    def query(self, sql: str, parameters: dict[str, Any], partition: tuple[str, int, int, int] | None = None) -> DataFrame:
        """Rows of the query; :name parameters are bound by value, ones it does not use are ignored. partition: ignored, as Spark splits what it reads."""
        names = parameter_names(sql)
        if missing := [n for n in names if n not in parameters]:
            raise ValueError(f"Missing SQL parameter(s): {', '.join(missing)}")
        args = {n: F.expr(f"{'timestamp_ltz' if parameters[n].tzinfo else 'timestamp_ntz'}'{parameters[n].isoformat(' ')}'") if isinstance(parameters[n], datetime) else parameters[n] for n in names}
        return normalise(self.spark.sql(sql, args=args) if args else self.spark.sql(sql))


class JdbcSource:
    """A database: the query runs there, its rows come in by one connection, or by several over ranges of a number column."""

    def __init__(self, spark: SparkSession, url: str, options: dict[str, str] | None = None):
        self.spark, self.url, self.options = spark, url, dict(options or {})

    def query(self, sql: str, parameters: dict[str, Any], partition: tuple[str, int, int, int] | None = None) -> DataFrame:
        """partition: (column, lowest, highest, connections)."""
        text = render(sql, parameters).strip().rstrip(";")
        reader = self.spark.read.format("jdbc").options(**self.options).option("url", self.url).option("dbtable", f"({text}) q").option("preferTimestampNTZ", "true")
        if partition:
            column, low, high, n = partition
            reader = reader.option("partitionColumn", column).option("lowerBound", low).option("upperBound", high).option("numPartitions", n)
        return normalise(reader.load())


def dsn_to_jdbc(dsn: str) -> tuple[str, dict[str, str]]:
    """A `host=… port=… dbname=… user=… password=…` string as JDBC URL and options; a jdbc: URL stays as it is."""
    if dsn.startswith("jdbc:"):
        return dsn, {}
    found = dict(re.findall(r"(\w+)\s*=\s*('[^']*'|\S+)", dsn))
    found = {k: v.strip("'") for k, v in found.items()}
    url = f"jdbc:postgresql://{found.get('host', 'localhost')}:{found.get('port', '5432')}/{found.get('dbname', '')}"
    options = {k: found[k] for k in ("user", "password") if k in found} | {"driver": "org.postgresql.Driver"}
    return url + (f"?sslmode={found['sslmode']}" if "sslmode" in found else ""), options


def open_source(spark: SparkSession, kind: str, dsn: str) -> Source:
    """postgres and jdbc take a connection string, spark a folder of Parquet files or nothing (views of the session)."""
    if kind == "spark":
        return SparkSource(spark, folder=dsn or None)
    url, options = dsn_to_jdbc(dsn)
    return JdbcSource(spark, url, options)
