"""Rows given as JSON literals, made to fit a schema. Input is a command-line argument, so this runs on the driver."""

from __future__ import annotations

import json
import math
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _integer(value, bits: int | None = None):
    if isinstance(value, bool) or not isinstance(value, int) or not -(2**63) <= value < 2**63:
        return None
    return value if bits is None else (value + 2 ** (bits - 1)) % 2**bits - 2 ** (bits - 1)


def _number(value):
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) and not (isinstance(value, float) and math.isnan(value)) else None


def _date(value):
    try:
        return date.fromisoformat(value) if isinstance(value, str) and len(value) == 10 else None
    except ValueError:
        return None


def _instant(value):
    """An RFC 3339 time with offset, as UTC without zone."""
    try:
        found = datetime.fromisoformat(value) if isinstance(value, str) else None
    except ValueError:
        return None
    return found.astimezone(UTC).replace(tzinfo=None) if found is not None and found.tzinfo is not None else None


_COERCE = {
    T.LongType: _integer, T.IntegerType: lambda v: _integer(v, 32), T.DoubleType: _number, T.FloatType: _number,
    T.StringType: lambda v: v if isinstance(v, str) else None, T.BooleanType: lambda v: v if isinstance(v, bool) else None,
    T.DateType: _date, T.TimestampNTZType: _instant,
}


def coerce(value, kind: T.DataType):
    """A JSON value as a value of a type: null for JSON null and values of another JSON type; int wraps around."""
    if value is None:
        return None
    found = _COERCE.get(type(kind))
    return found(value) if found else json.dumps(value)


def json_rows(spark: SparkSession, text: str, schema: T.StructType) -> DataFrame:
    """A JSON array of objects as a DataFrame: missing keys are null, extra keys are ignored."""
    rows = json.loads(text)
    if not isinstance(rows, list) or not all(isinstance(r, dict) for r in rows):
        raise ValueError("JSON must be an array of objects")
    return spark.createDataFrame([tuple(coerce(r.get(f.name), f.dataType) for f in schema.fields) for r in rows], schema)


def json_parameters(text: str) -> dict:
    """A message's JSON object as query parameters: nested values become JSON text."""
    found = json.loads(text)
    if not isinstance(found, dict):
        raise ValueError("Message payload must be a JSON object")
    return {k: json.dumps(v) if isinstance(v, (dict, list)) else v for k, v in found.items()}
