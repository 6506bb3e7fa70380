import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from helpers import SHAPE, odd_documents, sentence

from lakesync.llm import jaccard_join as jj
from lakesync.llm.common import Scratch
from lakesync.llm.components import components


def truth(texts):
    """Links of all pairs by definition, and the smallest id of each component."""
    sets = {}
    for i, text in texts.items():
        w = jj.words(text)
        n = min(5, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    links, parent = defaultdict(int), {i: i for i in texts}

    def find(i):
        return i if parent[i] == i else find(parent[i])

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (find(i), links[i]) for i in texts}


def edited(text, n, seed):
    draw, w = random.Random(seed), text.split()
    for _ in range(n):
        w[draw.randrange(len(w))] = f"new{draw.randint(0, 10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    """The second time every group, bucket and key counts as large: blocks, tiles, cells and hot keys all occur."""
    from lakesync.llm import common

    if small:
        for name, value in (("BLOCK", 8), ("CELL", 3)):
            monkeypatch.setattr(jj, name, value)
        monkeypatch.setattr(common, "HOT_LEAST", 2)
    base = [sentence(k, 150) for k in range(4)]
    texts = {}
    for k in range(40):  # one large group of near copies, of which many pairs are just below or above 0.8
        texts[k] = edited(base[0], 1 + k % 4, k)
    for k in range(40, 60):
        texts[k] = base[1 + k % 3] if k % 4 == 0 else edited(base[1 + k % 3], k % 5, k)
    for k in range(60, 80):  # a common passage is no copy
        texts[k] = base[0][:300] + " " + sentence(1000 + k, 90)
    for k in range(80, 84):
        texts[k] = ["", "one two", "one two", "!!!"][k - 80]
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in texts.items()], SHAPE)
    found = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jj.near_duplicates(df).collect()}
    assert found == truth(texts)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    found = jj.near_duplicates(docs)
    assert found.columns == ["doc_id", "text_hash", "class_id", "n_links", "leads"]
    rows = found.collect()
    assert {(r["class_id"], r["doc_id"]) for r in rows if r["leads"]} >= {(9, None), (0, 0), (13, 13)} and not any(r["leads"] for r in rows if r["doc_id"] in (10, 14))
    rows = [(r["doc_id"], r["class_id"], r["n_links"]) for r in rows]
    assert len(rows) == docs.count()
    assert {r for r in rows if r[0] in (9, 10)} == {(9, 9, 4), (10, 9, 4)} and (13, 13, 1) in rows and (14, 13, 1) in rows and (0, 0, 0) in rows and (None, 9, 4) in rows and (None, None, 0) in rows
    assert jj.near_duplicates(docs.where("false")).count() == 0


def test_pruning_follows_the_posterior():
    random_values = np.random.default_rng(0).integers(0, 2**32, (2, jj.HASHES), dtype=np.uint32)
    same = np.repeat(random_values[:1], 2, axis=0)
    assert list(jj.survivors(same, same, np.array([0]), np.array([1]))) == [0]
    assert len(jj.survivors(random_values, random_values, np.array([0]), np.array([1]))) == 0
    needed = dict(jj.least_matches(0.8))
    assert needed[16] < 0.8 * 16 and 0.55 < needed[160] / 160 < 0.8
    lost = sum(np.random.default_rng(k).binomial(160, 0.8) < needed[160] for k in range(2000))
    assert lost == 0 and 20 < jj.most_unequal_bits(0.8) < 45


def test_minhash_estimates_similarity():
    a, b = np.arange(0, 900, dtype=np.uint64), np.arange(100, 1000, dtype=np.uint64)
    a, b = np.unique(jj._mixed(a)), np.unique(jj._mixed(b))
    assert abs((jj.minhash(a) == jj.minhash(b)).mean() - 0.8) < 0.1


def test_tiles_hang_together(monkeypatch):
    """A chain of sets, each 0.8 or more like the next one only, in an order that links tiles late."""
    monkeypatch.setattr(jj, "TILE", 3)
    chain = [np.arange(10 * k, 10 * k + 100, dtype=np.uint64) for k in range(24)]
    reps = [int(r) for r in np.random.default_rng(3).permutation(24)]
    for low, high, block in ((0, 0, [0] * 24), (0, 1, [k % 2 for k in range(24)])):
        rows = pd.DataFrame({"rep": reps, "block": block, "low": low, "high": high, "weight": 1, "values": [jj.minhash(jj._mixed(c)).tobytes() for c in chain], "set": [np.sort(jj._mixed(c)).tobytes() for c in chain]})
        found = jj._compare(rows)
        assert set(found["root"]) == {0} and sorted(found["rep"]) == list(range(24)) and found["links"].sum() == 2 * 23


def test_sketch_bits_are_independent_in_small_sets():
    draw, lost = np.random.default_rng(1), 0
    for _ in range(2000):
        x = draw.integers(0, 2**63, 5, dtype=np.int64).astype(np.uint64)
        values = np.stack([jj.minhash(x[:4]), jj.minhash(x)])
        a, b = jj.sketch(values)
        lost += int((a != b).sum()) > jj.most_unequal_bits(0.8)
    assert lost <= 1


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (7, 7), (None, 1)] + [(k, k + 1) for k in range(20, 40)]
    found = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"))
    assert {r["node"]: r["root"] for r in found.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 7: 7} | {k: 20 for k in range(20, 41)}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0


def test_a_task_has_one_python_function(spark, monkeypatch):
    """Each function in a plan gets a Python worker of its own in every task, and idle workers keep their memory."""
    plans, table = {}, Scratch.table

    def seen(self, df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return table(self, df, name)

    monkeypatch.setattr(Scratch, "table", seen)
    assert jj.near_duplicates(odd_documents(spark)).count() > 0
    counts = {name: len(re.findall("ArrowEvalPython|FlatMapGroupsInPandas", plan)) for name, plan in plans.items()}
    assert counts["sets"] == counts["described"] == counts["inside"] == 1 and max(counts.values()) == 1, counts


def test_hot_keys_need_no_python_workers(spark, monkeypatch):
    from pyspark.sql import functions as F

    from lakesync.llm import common

    monkeypatch.setattr(common, "HOT_LEAST", 2)
    for key in (F.col("id") % 4, F.concat(F.lit("k"), F.col("id") % 4), F.struct((F.col("id") % 4).alias("a"), F.lit("x").alias("b"))):
        many = spark.range(40).where("id % 4 < 2 or id < 8").withColumn("key", key)
        one = many.groupBy("key").agg(F.max("id").alias("most")).where("most <> 2 and most <> 6")
        counts = many.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        for how in ("inner", "left"):
            found = common.spread_join(many, one, "key", F.col("id"), counts, how)
            assert not re.search("RDD", found._jdf.queryExecution().optimizedPlan().toString())
            assert rows(found.select("id", "most")) == rows(many.join(one, "key", how).select("id", "most"))
