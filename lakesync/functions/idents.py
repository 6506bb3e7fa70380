"""Dotted names and schema strings."""

from __future__ import annotations

from pyspark.sql import types as T

# The type words of a schema string.
TYPE_WORDS = {
    "long": T.LongType(), "int64": T.LongType(), "int": T.IntegerType(), "int32": T.IntegerType(),
    "string": T.StringType(), "str": T.StringType(), "double": T.DoubleType(), "float64": T.DoubleType(),
    "float": T.FloatType(), "float32": T.FloatType(), "boolean": T.BooleanType(), "bool": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampNTZType(),
}


def parse_namespace(name: str) -> tuple[str, ...]:
    """`a.b` as ("a", "b"); empty parts are an error."""
    parts = tuple(p.strip() for p in name.split("."))
    if not all(parts) or any("/" in p or p.startswith("_") for p in parts):
        raise ValueError(f"Invalid namespace '{name}'")
    return parts


def parse_table(name: str) -> tuple[tuple[str, ...], str]:
    """`a.b.t` as (("a", "b"), "t"): the last dot separates the table."""
    namespace, dot, table = name.rpartition(".")
    if not dot or not table.strip():
        raise ValueError(f"Table must be 'namespace.table', got '{name}'")
    parse_namespace(table)
    return parse_namespace(namespace), table.strip()


def parse_type(word: str) -> T.DataType:
    if (found := TYPE_WORDS.get(word.strip().lower())) is None:
        raise ValueError(f"Unknown type '{word.strip()}'. Use one of: {', '.join(TYPE_WORDS)}")
    return found


def parse_schema(schema: str) -> T.StructType:
    """`id:long,name:string` as a schema of nullable columns."""
    fields, seen = [], set()
    for part in schema.split(","):
        name, colon, kind = (x.strip() for x in part.partition(":"))
        if not colon or not name:
            raise ValueError(f"Column must be 'name:type', got '{part.strip()}'")
        if name in seen:
            raise ValueError(f"Column '{name}' is named twice")
        seen.add(name)
        fields.append(T.StructField(name, parse_type(kind), True))
    return T.StructType(fields)


def parse_pair(text: str) -> tuple[str, str]:
    key, equals, value = text.partition("=")
    if not equals or not key.strip():
        raise ValueError(f"Property must be KEY=VALUE, got '{text}'")
    return key.strip(), value
