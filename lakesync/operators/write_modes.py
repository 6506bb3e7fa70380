"""Write modes: what a table holds after a batch was written to it.

`table` is what it holds now (None for a table without rows), `batch` what comes in. Results are bags in the table's
column order; columns are matched by name. Keys are equal when they are equal or both null. Batches are not freed
of repeated keys unless `latest` did it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.transforms import label

OP = "_op"
# The operation words of a change batch, in upper case.
UPDATES, DELETES = ("U", "UPDATE"), ("D", "DELETE")


def union_all(frames: list[DataFrame | None]) -> DataFrame | None:
    """All rows of the frames that are there, by column name; None if there is none."""
    there = [f for f in frames if f is not None]
    return reduce(lambda a, b: a.unionByName(b), there) if there else None


def anti_join(table: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of table whose key tuple is not in keys, nulls being equal. Key columns that table lacks match nothing."""
    if missing := [c for c in columns if c not in keys.columns]:
        raise ValueError(f"Key columns {missing} are not in the batch")
    if any(c not in table.columns for c in columns):
        return table
    distinct = keys.select(*(F.col(f"`{c}`").alias(f"__key_{i}") for i, c in enumerate(columns))).distinct()
    same = reduce(lambda a, b: a & b, (table[f"`{c}`"].eqNullSafe(distinct[f"__key_{i}"]) for i, c in enumerate(columns)))
    return table.join(distinct, same, "left_anti")


def append(table: DataFrame | None, batch: DataFrame) -> DataFrame:
    return union_all([table, batch])


def overwrite(table: DataFrame | None, batch: DataFrame, column: str, transform: str | None = None) -> DataFrame:
    """Replace the partitions that occur in batch: values of column, or its transform's values. Null is a partition of its own."""
    if table is None:
        return batch
    if transform is None:
        return union_all([anti_join(table, batch, [column]), batch])
    of = lambda df: label(F.col(f"`{column}`"), transform)
    kept = anti_join(table.withColumn("__partition", of(table)), batch.select(of(batch).alias("__partition")), ["__partition"])
    return union_all([kept.drop("__partition"), batch])


def upsert(table: DataFrame | None, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of table whose key is not in batch, and batch."""
    return batch if table is None else union_all([anti_join(table, batch, keys), batch])


def operation(op: Column) -> Column:
    """I, U or D of an operation word in any case; null and unknown words insert."""
    word = F.upper(op)
    return F.when(word.isin(*UPDATES), "U").when(word.isin(*DELETES), "D").otherwise("I")


def split_changes(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to write, rows whose keys replace or delete) of a change batch, the first without the operation column."""
    if OP not in batch.columns:
        raise ValueError(f"merge_into needs a column '{OP}'")
    if not isinstance(batch.schema[OP].dataType, T.StringType):
        raise ValueError(f"Column '{OP}' must be a string")
    op = operation(F.col(OP))
    return batch.where(op != "D").drop(OP), batch.where(op != "I").drop(OP)


def merge_into(table: DataFrame | None, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of table whose key batch neither updates nor deletes, and batch's inserts and updates."""
    written, replaced = split_changes(batch)
    return written if table is None else union_all([anti_join(table, replaced, keys), written])


def latest(batch: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Of rows with equal keys the last one by order_by."""
    last = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order_by))
    return batch.withColumn("__rank", F.row_number().over(last)).where("__rank = 1").drop("__rank")


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df's columns in the table's order and types; those that df lacks are null, others are left out."""
    there = set(df.columns)
    return df.select(*((F.col(f"`{f.name}`").cast(f.dataType) if f.name in there else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields))
