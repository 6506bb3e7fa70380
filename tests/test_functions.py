from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesync.functions import transforms
from lakesync.functions.coerce import coerce, json_parameters, json_rows
from lakesync.functions.idents import parse_namespace, parse_pair, parse_schema, parse_table, parse_type


def test_names():
    assert parse_namespace("a.b") == ("a", "b")
    assert parse_table("a.b.t") == (("a", "b"), "t")
    assert parse_pair("k=v=w") == ("k", "v=w")
    for bad in ("t", ".t", "a.", "a..b", "a/b.t"):
        with pytest.raises(ValueError):
            parse_table(bad)


@pytest.mark.parametrize("word,kind", [("LONG", "bigint"), ("int64", "bigint"), ("int32", "int"), ("str", "string"), ("float64", "double"), ("float32", "float"), ("bool", "boolean"), ("date", "date"), ("timestamp", "timestamp_ntz")])
def test_type_words(word, kind):
    assert parse_type(f" {word} ").simpleString() == kind


def test_schema():
    found = parse_schema(" id : long , name:string")
    assert found.simpleString() == "struct<id:bigint,name:string>" and all(f.nullable for f in found)
    for bad in ("id", "id:", "id:uuid", "id:long,id:int"):
        with pytest.raises(ValueError):
            parse_schema(bad)


@pytest.mark.parametrize("value,kind,want", [
    (2**31, T.IntegerType(), -(2**31)), (1.5, T.LongType(), None), ("x", T.LongType(), None), (True, T.LongType(), None), (3, T.DoubleType(), 3.0),
    (5, T.StringType(), None), ("2024-02-30", T.DateType(), None), ("2024-02-29", T.DateType(), date(2024, 2, 29)), ("20240229", T.DateType(), None),
    ("2024-01-01T02:00:00+02:00", T.TimestampNTZType(), datetime(2024, 1, 1)), ("2024-01-01T02:00:00", T.TimestampNTZType(), None), (None, T.StringType(), None), (1, T.BooleanType(), None),
])
def test_coercion(value, kind, want):
    assert coerce(value, kind) == want


def test_json_rows(spark):
    df = json_rows(spark, '[{"id": 1, "x": 9}, {"name": "b"}]', parse_schema("id:long,name:string"))
    assert rows(df) == [(1, None), (None, "b")]
    with pytest.raises(ValueError):
        json_rows(spark, '{"id": 1}', parse_schema("id:long"))


def test_json_parameters():
    assert json_parameters('{"a": 1, "b": [1], "c": null, "d": true}') == {"a": 1, "b": "[1]", "c": None, "d": True}
    with pytest.raises(ValueError):
        json_parameters("[1]")


def test_transforms_round_down_and_ignore_the_time_zone(spark):
    df = spark.sql("SELECT * FROM VALUES (timestamp_ntz'1969-12-31 23:30:00'), (timestamp_ntz'2024-03-10 02:30:00'), (null) AS t(ts)")
    number = [transforms.number(F.col("ts"), t).alias(t) for t in transforms.TRANSFORMS]
    label = [transforms.label(F.col("ts"), t).alias(f"l{t}") for t in transforms.TRANSFORMS]
    want = [(-1, -1, -1, -1, "1969-12-31-23", "1969-12-31", "1969-12", "1969"), (475010, 19792, 650, 54, "2024-03-10-02", "2024-03-10", "2024-03", "2024"), (None,) * 8]
    for zone in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert [tuple(r) for r in df.select(*number, *label).collect()] == want
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_transform_checks():
    schema = parse_schema("d:date,t:timestamp,s:string")
    transforms.check_transform(schema, "d", "month")
    for column, transform in (("d", "hour"), ("s", "day"), ("x", "day"), ("t", "week")):
        with pytest.raises(ValueError):
            transforms.check_transform(schema, column, transform)


def test_normalise(spark):
    df = spark.sql("SELECT CAST(1.5 AS DECIMAL(5,2)) a, CAST(3 AS SMALLINT) b, timestamp_ltz'2024-01-01 00:00:00Z' c, array(1) d, binary('x') e, 1L f")
    assert transforms.normalise(df).schema.simpleString() == "struct<a:double,b:int,c:timestamp_ntz,d:string,e:string,f:bigint>"
    assert tuple(transforms.normalise(df).first()) == (1.5, 3, datetime(2024, 1, 1), "[1]", "x", 1)
