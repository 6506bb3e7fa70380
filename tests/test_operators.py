from collections import Counter

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakesync.functions.idents import parse_schema
from lakesync.operators import paging
from lakesync.operators import write_modes as modes

ROW = st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "a", "b"]), st.integers(0, 9))
OPS = st.sampled_from(["I", "u", "Update", "d", "DELETE", None, "?"])
SHAPE = "k long, p string, v long"


def model_merge(table, batch):
    kind = lambda op: {"U": "U", "UPDATE": "U", "D": "D", "DELETE": "D"}.get((op or "").upper(), "I")
    gone = {b[0] for b in batch if kind(b[3]) != "I"}
    return [t for t in table if t[0] not in gone] + [b[:3] for b in batch if kind(b[3]) != "D"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(table=st.lists(ROW, max_size=6), batch=st.lists(st.tuples(ROW, OPS), max_size=5))
def test_modes_equal_a_model(spark, table, batch):
    t, b = spark.createDataFrame(table, SHAPE), spark.createDataFrame([r for r, _ in batch], SHAPE)
    changes = [(*r, op) for r, op in batch]
    plain = [r for r, _ in batch]
    bag = lambda df: Counter(tuple(r) for r in df.collect())
    assert bag(modes.append(t, b)) == Counter(table + plain)
    assert bag(modes.upsert(t, b, ["k"])) == Counter([x for x in table if x[0] not in {y[0] for y in plain}] + plain)
    assert bag(modes.upsert(t, b, ["k", "p"])) == Counter([x for x in table if x[:2] not in {y[:2] for y in plain}] + plain)
    assert bag(modes.overwrite(t, b, "p")) == Counter([x for x in table if x[1] not in {y[1] for y in plain}] + plain)
    assert bag(modes.merge_into(t, spark.createDataFrame(changes, f"{SHAPE}, _op string"), ["k"])) == Counter(model_merge(table, changes))


def test_first_runs(spark):
    b = spark.createDataFrame([(1, "a", 1, "D"), (2, "a", 2, None)], f"{SHAPE}, _op string")
    assert rows(modes.merge_into(None, b, ["k"])) == [(2, "a", 2)]
    assert modes.upsert(None, b, ["k"]) is b and modes.overwrite(None, b, "p") is b and modes.union_all([None]) is None


def test_columns_bind_by_name_and_missing_keys_raise(spark):
    t, b = spark.createDataFrame([(1, "x")], "k long, s string"), spark.createDataFrame([("y", 1)], "s string, k long")
    assert rows(modes.upsert(t, b, ["k"])) == [(1, "y")]
    assert rows(modes.anti_join(t, b.withColumnRenamed("k", "z"), ["z"])) == [(1, "x")]
    with pytest.raises(ValueError):
        modes.upsert(t, b.drop("k"), ["k"])
    for bad in (b, b.withColumn("_op", F.lit(1))):
        with pytest.raises(ValueError):
            modes.merge_into(t, bad, ["k"])


def test_overwrite_by_transform(spark):
    t = spark.sql("SELECT * FROM VALUES (1, date'2024-01-05'), (2, date'2024-02-05'), (3, null) AS t(id, d)")
    b = spark.sql("SELECT * FROM VALUES (9, date'2024-01-31') AS t(id, d)")
    assert [r[0] for r in rows(modes.overwrite(t, b, "d", "month"))] == [2, 3, 9]
    assert [r[0] for r in rows(modes.overwrite(t, t.where("d is null"), "d", "month"))] == [1, 2, 3]


def test_latest_and_align(spark):
    b = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 1)], SHAPE)
    assert rows(modes.latest(b, ["k"], ["v"])) == [(1, "b", 2), (None, "c", 1)]
    assert rows(modes.align(b, parse_schema("v:int,new:string,k:long")))[0] == (1, None, 1)


def test_key_sets_are_joined_by_hash_or_sort_not_by_nested_loops(spark):
    t, b = spark.createDataFrame([(1, "a", 1)], SHAPE), spark.createDataFrame([(1, "a", 1)], SHAPE)
    plan = modes.upsert(t, b, ["k", "p"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_pages(spark):
    df = spark.createDataFrame([(i if i != 3 else None, f"U{i:02d}") for i in range(8)], "id long, name string")
    page = paging.keyset_page(df, "id", 1, 3)
    assert [r["id"] for r in page.collect()] == [2, 4, 5] and paging.CURSOR in page.columns
    assert [r["name"] for r in paging.keyset_page(df, "name", None, 2).collect()] == ["U00", "U01"]
    assert [r["id"] for r in paging.offset_page(df, ["name"], 2, 4).collect()] == [4, 5]
    assert paging.strip(page, paging.CURSOR, "absent").columns == ["id", "name"]
    assert rows(df.where(paging.any_of("id", [1, None])))[0][0] == 1 and df.where(paging.any_of("id", [None])).count() == 1
    assert df.where(paging.any_of("id", [])).count() == 0 and paging.after_watermark(df, "id", 5).count() == 2 and paging.after_watermark(df, "id", None).count() == 8
    with pytest.raises(ValueError):
        paging.keyset_page(df, "absent", None, 1)
    with pytest.raises(ValueError):
        paging.offset_page(df, [], 1, 0)


def test_page_sql():
    assert paging.page_sql("SELECT id FROM t", "id", 5) == "SELECT * FROM (SELECT i.*, i.id AS _pgcursor FROM (SELECT id FROM t) i) p WHERE _pgcursor > :_cursor ORDER BY _pgcursor LIMIT 5"
    assert paging.page_sql("SELECT 1", None, 5, 10).endswith("p LIMIT 5 OFFSET 10")
    assert paging.page_sql("SELECT 1", None, 5, 10, "fetch").endswith("OFFSET 10 ROWS FETCH NEXT 5 ROWS ONLY")
    assert [paging.page_count(n, 10) for n in (0, 9, 10, 25)] == [1, 1, 2, 3]
