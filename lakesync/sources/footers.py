"""Row counts and value ranges of Parquet files, from their footers alone; no rows are read."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import date, datetime
from typing import Any

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Files whose footers the driver reads itself; those of more files are read by the executors.
ON_THE_DRIVER = 64
LONGEST_TEXT = 64
#: Lowest value, highest value, whether nulls occur; values as numbers or as text that sorts like them.
Range = list[Any]


def plain(value: Any) -> Any:
    """A value as JSON holds it, in the order of the values; None where it has no such form."""
    if isinstance(value, bool):
        return None
    if isinstance(value, datetime):
        return value.isoformat("T", "microseconds") if value.tzinfo is None else None
    if isinstance(value, date):
        return value.isoformat()
    return value if isinstance(value, int) or isinstance(value, str) and len(value) <= LONGEST_TEXT else None


def as_plain(column: Column, kind: T.DataType) -> Column | None:
    """A column's values in the same form; None for types without ranges."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return column.cast("long")
    if isinstance(kind, T.StringType):
        return column
    if isinstance(kind, T.DateType):
        return F.date_format(column, "yyyy-MM-dd")
    if isinstance(kind, T.TimestampNTZType):
        return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return None


def meets(held: Range | None, wanted: Range) -> bool:
    """Whether a file of range `held` may have a value of range `wanted`; a file without a range may have any."""
    if held is None or held[2] and wanted[2]:
        return True
    if held[0] is None or wanted[0] is None:
        return False
    return type(held[0]) is not type(wanted[0]) or held[0] <= wanted[1] and wanted[0] <= held[1]


def _open(path: str):
    from pyarrow import fs

    if match := re.match(r"(\w[\w+.-]*)://([^/]*)(/.*)", path):
        if match[1] != "file":
            store, root = fs.FileSystem.from_uri(f"{match[1]}://{match[2]}/")
            return store, root.rstrip("/") + match[3]
        return fs.LocalFileSystem(), match[3]
    return fs.LocalFileSystem(), path.removeprefix("file:")


def footer(path: str) -> tuple[int, dict[str, Range]]:
    """Rows of a file and the ranges of its columns; nested columns and those without statistics have none."""
    from pyarrow import parquet

    store, where = _open(path)
    meta, ranges = parquet.read_metadata(where, filesystem=store), {}
    for c in range(meta.num_columns):
        found, name = [], meta.schema.column(c).path
        for g in range(meta.num_row_groups):
            held = meta.row_group(g).column(c)
            s = held.statistics
            if s is None or not s.has_null_count or not (s.has_min_max or s.null_count == held.num_values):
                break
            low, high = (plain(s.min), plain(s.max)) if s.has_min_max else (None, None)
            if s.has_min_max and (low is None or high is None):
                break
            found.append((low, high, s.null_count > 0))
        else:
            values = [f for f in found if f[0] is not None]
            if found and "." not in name:
                ranges[name] = [min((f[0] for f in values), default=None), max((f[1] for f in values), default=None), any(f[2] for f in found)]
    return meta.num_rows, ranges


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for paths in batches:
        found = [(p, *footer(p)) for p in paths["path"]]
        yield pd.DataFrame([(p, n, json.dumps(r)) for p, n, r in found], columns=["path", "records", "ranges"])


def footers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[int, dict[str, Range]]]:
    """Rows and ranges by path. Files in a store that Arrow doesn't know raise."""
    if len(paths) <= ON_THE_DRIVER:
        return {p: footer(p) for p in paths}
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(-(-len(paths) // ON_THE_DRIVER))
    rows = listed.mapInPandas(_footers, "path string, records long, ranges string").collect()
    return {r["path"]: (r["records"], json.loads(r["ranges"])) for r in rows}
