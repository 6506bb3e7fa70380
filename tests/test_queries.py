import duckdb
import pandas as pd
import pytest
from conftest import DATA

import __spark_entry__ as entry
from lakesync.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    found = duckdb.connect()
    for table in TABLES:
        found.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/sf0.001/{table}.parquet'")
    return found


def plain(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    number = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)[:19].replace(" 00:00:00", "")
    return sorted(repr([None if pd.isna(v) else number(v) for v in row]) for row in frame.values.tolist())


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_sql(spark, oracle, name):
    found, want = QUERIES[name](spark, f"{DATA}/sf0.001").toPandas(), oracle.execute(ORACLE_SQL[name]).df()
    assert sorted(found.columns) == sorted(want.columns) and plain(found) == plain(want)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE_SQL])
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, f"{DATA}/sf0.001").count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())
