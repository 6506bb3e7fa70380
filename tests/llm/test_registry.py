import re

import duckdb
import pytest
from conftest import DATA

from lakesync.llm.registry import ORACLE_SQL, QUERIES


def test_names():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 11)) and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/sf0.001/{table}.parquet'")
    found = QUERIES[name](spark, f"{DATA}/sf0.001")
    want = db.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r) for r in found.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))
