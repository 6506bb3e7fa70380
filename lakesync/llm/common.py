"""Helpers shared by the training-data operators: scratch tables, Arrow batch bounds and input alignment."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that an Arrow batch carries to a Python worker at most (a single longer text makes a batch of its own).
ARROW_ROWS, ARROW_BYTES = 256, 8 << 20
#: A key with more than this share of all rows is hot, so there are at most as many hot keys as the share's inverse.
HOT_KEYS, HOT_LEAST = 10_000, 1024


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir of the session.

    Only where it is unset and the master is local (tests), where all share one disk, an own temporary folder is made and
    set; a cluster without the setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='lakesync-')}"
        spark.sparkContext.setCheckpointDir(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)  # with its store's name, so that Python workers find the same one
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString().rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder through Hadoop's file system, whatever store holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Intermediate tables written under the shared folder, so that lineage ends there and lost executors cost no recomputation.

    The folder is removed when the Python process ends; `drop` frees a table earlier.
    """

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/lakesync-scratch/{tag}-{uuid.uuid4().hex}"
        atexit.register(self.close)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and read it back."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            delete_path(self.spark, self.path(name))

    def close(self) -> None:
        try:
            if self.spark.sparkContext._jsc is not None:
                delete_path(self.spark, self.root)
        except Exception:  # noqa: BLE001  the session may be gone at interpreter exit
            pass


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that this session's Python operators get; the bounds are the same for all of them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def spread_join(many: DataFrame, one: DataFrame, key: str, by: Column, counts: DataFrame, how: str = "inner") -> DataFrame:
    """many joined with one (a row for each key), where the rows of a hot key are dealt by `by` over several tasks.

    counts has key and n, how many rows of many hold it (an upper bound will do). Each of the at most HOT_KEYS keys above
    a HOT_KEYS-th of all rows goes to so many tasks that none gets more than that share; its row of one goes to each.
    """
    spark = many.sparkSession
    least = max(HOT_LEAST, (counts.agg(F.sum("n")).first()[0] or 0) // HOT_KEYS)
    hot = counts.where(F.col("n") > least).select(key, F.ceil(F.col("n") / F.lit(least)).cast("int").alias("hot_parts"))
    found = hot._jdf.collectAsList()
    if found.isEmpty():
        return many.join(one, key, how)
    # A local relation: rows from Python would be an RDD, for which every executor starts Python workers beside those of Arrow.
    hot = F.broadcast(DataFrame(spark._jsparkSession.createDataFrame(found, hot._jdf.schema()), spark))
    parts = F.coalesce("hot_parts", F.lit(1))
    many = many.join(hot, key, "left").withColumn("hot_part", F.pmod(F.xxhash64(by), parts).cast("int")).drop("hot_parts")
    one = one.join(hot, key, "left").withColumn("hot_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("hot_parts")
    return many.join(one, [key, "hot_part"], how).drop("hot_part")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
