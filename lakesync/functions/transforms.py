"""Partition transforms of dates and timestamps, as numbers since 1970 and as labels.

All forms go through to_date() and hour(), so they do not depend on the session's time zone for timestamps without
one, and they round down before 1970. Null gives null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRANSFORMS = ("hour", "day", "month", "year")


def _days(column: Column) -> Column:
    return F.datediff(F.to_date(column), F.lit("1970-01-01").cast("date"))


def number(column: Column, transform: str) -> Column:
    """Hours, days, months or years since 1970."""
    years = F.year(column) - 1970
    return {
        "hour": lambda: (_days(column).cast("long") * 24 + F.hour(column)).cast("long"), "day": lambda: _days(column),
        "month": lambda: years * 12 + F.month(column) - 1, "year": lambda: years,
    }[transform]()


def label(column: Column, transform: str) -> Column:
    """YYYY-MM-DD-HH, YYYY-MM-DD, YYYY-MM or YYYY."""
    day = F.to_date(column)
    return {
        "hour": lambda: F.concat(day.cast("string"), F.lit("-"), F.lpad(F.hour(column).cast("string"), 2, "0")), "day": lambda: day.cast("string"),
        "month": lambda: F.substring(day.cast("string"), 1, 7), "year": lambda: F.substring(day.cast("string"), 1, 4),
    }[transform]()


def check_transform(schema: T.StructType, column: str, transform: str) -> None:
    """Raise unless the column exists and the transform fits its type."""
    if transform not in TRANSFORMS:
        raise ValueError(f"Unknown partition transform '{transform}'. Use one of: {', '.join(TRANSFORMS)}")
    if column not in schema.fieldNames():
        raise ValueError(f"Partition column '{column}' is not in the schema")
    kind = schema[column].dataType
    if not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"Partition column '{column}' must be a date or a timestamp, is {kind.simpleString()}")
    if transform == "hour" and isinstance(kind, T.DateType):
        raise ValueError(f"Transform 'hour' does not fit date column '{column}'")


def table_type(kind: T.DataType) -> T.DataType:
    """The type that a table keeps for a source type: decimals are doubles, times are UTC without zone, the rest without a counterpart is text."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.IntegerType()
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return T.TimestampNTZType()
    if isinstance(kind, (T.LongType, T.FloatType, T.DoubleType, T.BooleanType, T.DateType)):
        return kind
    return T.StringType()


def normalise(df: DataFrame) -> DataFrame:
    """df with the types that tables keep."""
    out = []
    for field in df.schema.fields:
        column, kind = df[f"`{field.name}`"], table_type(field.dataType)
        if isinstance(field.dataType, T.TimestampType):
            column = F.to_utc_timestamp(column, F.current_timezone()).cast("timestamp_ntz")
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(column)
        elif kind != field.dataType:
            column = column.cast(kind)
        out.append(column.alias(field.name))
    return df.select(*out)
