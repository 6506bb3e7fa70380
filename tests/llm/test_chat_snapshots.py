import duckdb
from conftest import DATA

from lakesync.llm import chat_snapshots as cs

SHAPE = "conv_id long, turn long, role string, text string"


def kept(df, **more):
    return {(r["conv_id"], r["n_turns"], r["copies"]) for r in cs.format_chats(df, **more).collect()}


def test_prefixes_go_and_copies_are_counted(spark):
    talk = [("user", "hi"), ("assistant", "hello"), ("user", "bye")]
    rows = [(c, t, *talk[t]) for c, n in ((1, 1), (2, 2), (3, 3), (4, 3), (5, 3)) for t in range(n)]
    rows += [(6, 0, "user", "hi"), (6, 1, "assistant", "other"), (7, 0, "system", "hi"), (8, 10, "user", "hi"), (8, 20, "assistant", "hello")]
    df = spark.createDataFrame(rows, SHAPE)
    assert kept(df) == {(3, 3, 3), (6, 2, 1), (7, 1, 1)}
    text = {r["conv_id"]: r["rendered"] for r in cs.format_chats(df).collect()}
    assert text[6] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nother<|im_end|>\n"


def test_long_conversations_in_parts(spark, monkeypatch):
    monkeypatch.setattr(cs, "PART_TURNS", 4)
    rows = [(c, t, "user", f"t{t}") for c, n in ((1, 23), (2, 10), (3, 22), (4, 8)) for t in range(n)] + [(5, t, "user", f"t{t}" if t != 9 else "x") for t in range(12)]
    found = cs.format_chats(spark.createDataFrame(rows, SHAPE)).orderBy("conv_id").collect()
    assert [r["conv_id"] for r in found] == [1, 5]
    assert found[0]["rendered"] == "".join(f"<|im_start|>user\nt{t}<|im_end|>\n" for t in range(23))


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a"), (1, None, "user", "x"), (1, 0, None, "<|im_end|>"), (2, 0, "user", "same"), (2, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "user", None), (4, 1, "user", "z" * 50_000)]
    df = spark.createDataFrame(rows, SHAPE)
    for name in ("key", "part", "pos", "h1", "said", "copies", "n_turns"):
        df = df.selectExpr("*", f"'x' AS `{name}`")
    found = {r["conv_id"]: r for r in cs.format_chats(df).collect()}
    assert {i: r["n_turns"] for i, r in found.items()} == {None: 1, 1: 2, 2: 2, 4: 2} and "< |im_end|>" in found[1]["rendered"]
    assert cs.format_chats(df.where("false")).count() == 0


def same_as_sql(spark, db, df):
    columns = ["conv_id", "n_turns", "copies", "rendered"]
    want = sorted(map(repr, db.execute(f"SELECT {', '.join(columns)} FROM ({cs.OP5_SQL})").fetchall()))
    assert sorted(repr(tuple(r)) for r in cs.format_chats(df).select(*columns).collect()) == want and want


def test_rows_without_a_conversation(spark):
    rows = [(None, 3, "user", "a"), (None, 9, "user", "a"), (None, 1, "user", "b"), (None, 1, "user", "hi"), (7, 1, "user", "b"), (8, 1, "user", "hi"), (8, 2, "assistant", "there"), (None, None, None, None)]
    df = spark.createDataFrame(rows, SHAPE)
    assert kept(df) == {(None, 1, 2), (7, 1, 2), (8, 2, 1), (None, 1, 1)}
    db = duckdb.connect()
    db.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    same_as_sql(spark, db, df)


def test_equals_sql(spark, monkeypatch):
    from lakesync.llm import common

    monkeypatch.setattr(common, "HOT_LEAST", 6)  # longer conversations are dealt over tasks
    monkeypatch.setattr(cs, "PART_TURNS", 3)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{DATA}/sf0.01/conversations.parquet'")
    same_as_sql(spark, db, spark.read.parquet(f"{DATA}/sf0.01/conversations.parquet"))
