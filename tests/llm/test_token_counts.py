import random

import pytest
from helpers import odd_documents
from pyspark.sql import functions as F

from lakesync.llm import token_counts as tc


@pytest.fixture(scope="module")
def by():
    return tc.Counter(tc.read_ranks())


PARTS = ["a", "the", " ", "  ", "\n", "'", "s", "'ll", "l", "9", "42", "!", "?", "é", "日本", " x", "\t", "...", "<|endoftext|>"]


def test_edits_equal_fresh_counts(by):
    draw = random.Random(1)
    some = lambda sizes: "".join(draw.choice(PARTS) for _ in range(draw.choice(sizes)))
    for _ in range(400):
        tree = tc.TokenTree(by, some([0, 1, 3, 20, 200, 1500]))
        for _ in range(6):
            start = draw.randint(0, len(tree.text))
            end, new = min(len(tree.text), start + draw.choice([0, 0, 1, 2, 5, 50, 400])), some([0, 1, 2, 5, 300])
            want = tree.text[:start] + new + tree.text[end:]
            tree.edit(start, end, new)
            assert tree.text == want and tree.tokens == len(by.encoding.encode_ordinary(want)) and tree.pieces == len(by.pattern.findall(want))
            again = tc.TokenTree.restore(by, want, tree.state())
            assert (again.tokens, again.pieces) == (tree.tokens, tree.pieces)


def test_only_the_touched_region_is_encoded(by):
    tree = tc.TokenTree(by, "lorem ipsum " * 5000)
    tree.encoded = 0
    tree.edit(30_000, 30_003, "dolor")
    assert 0 < tree.encoded < 10
    tree.encoded = 0
    tree.edit(10**9, -5, "end")  # clipped to the text
    assert tree.text.endswith("end") and tree.encoded < 10


def test_columns_and_state(spark, by):
    docs = spark.createDataFrame([(1, "one two three"), (2, None), (3, "")], "id long, text string")
    docs = docs.withColumn("edits", F.array(F.struct(F.lit(3).alias("start"), F.lit(4).alias("end"), F.lit(None).cast("string").alias("text")), F.struct(F.lit(None).cast("int").alias("start"), F.lit(0).alias("end"), F.lit("x ").alias("text"))).cast(tc.EDITS))
    first = {r["id"]: r["counted"] for r in tc.count_tokens(docs, edits="edits").collect()}
    assert first[1]["edited_text"] == "x onetwo three" and first[1]["edited_tokens"] == len(by.encoding.encode_ordinary("x onetwo three")) and first[2]["n_tokens"] == 0 and first[3]["edited_text"] == "x "
    held = tc.count_tokens(docs).select("id", "text", F.col("counted.tree").alias("tree"))
    again = {r["id"]: r["counted"] for r in tc.count_tokens(held, state="tree").collect()}
    assert {i: r["n_tokens"] for i, r in again.items()} == {i: r["n_tokens"] for i, r in first.items()}


def test_null_positions(spark):
    edits = [(None, None, "a"), (2, None, "b"), (None, 2, None), None, (1, 2, None)]
    docs = spark.createDataFrame([("xyz", edits), ("xyz", None), (None, edits)], f"text string, edits {tc.EDITS}")
    found = tc.count_tokens(docs, edits="edits").select("counted.edited_text").collect()
    assert [r[0] for r in found] == ["bz", "xyz", ""]  # axyz, axbyz, byz, bz; a, ab, empty


def test_query_equals_plain_encoding(spark, by):
    docs = odd_documents(spark)
    rows = tc.count_tokens(docs.withColumn("edits", tc.sample_edits()), edits="edits").select("text", "counted").collect()
    assert len(rows) == docs.count()
    for text, r in rows:
        assert r["n_tokens"] == len(by.encoding.encode_ordinary(text or "")) and r["edited_tokens"] == len(by.encoding.encode_ordinary(r["edited_text"]))
    assert tc.count_tokens(docs.where("false")).count() == 0
