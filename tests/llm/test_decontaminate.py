import random
import re
from collections import Counter

from helpers import SHAPE, odd_documents, sentence

from lakesync.llm import decontaminate as dc


def truth(docs, items):
    """Pairs with a window of the item's size of similarity 0.8 or more, at any place."""
    bag = lambda w: Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    cut = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = set()
    for i, text in docs:
        w = cut(text)
        for item, said in items:
            v = cut(said)
            if len(v) < 5 or len(w) < 5:
                continue
            want = bag(v)
            for s in range(max(1, len(w) - len(v) + 1)):
                have = bag(w[s : s + len(v)])
                both = sum((have & want).values())
                if both >= 0.8 * (sum(have.values()) + sum(want.values()) - both):
                    out.add((i, item))
                    break
    return out


def run(spark, docs, items, **more):
    d, b = spark.createDataFrame([(i, t, None, None, 0) for i, t in docs], SHAPE), spark.createDataFrame(items, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in dc.contaminated(d, b, **more).collect()}


def planted():
    items = [(k, sentence(500 + k, 12 + 3 * k)) for k in range(15)] + [(90, "too short"), (91, None), (92, sentence(500, 12))]
    draw, docs = random.Random(3), []
    for k in range(90):
        words, item = sentence(k, 120).split(), items[k % 15][1].split()
        kind = k % 6
        if kind == 1:
            item[draw.randrange(len(item))] = "changed"
        elif kind == 2:
            item = item[1:-1]
        elif kind == 3:
            item = item[: len(item) // 2]
        elif kind == 4:
            item[0:1] = ["other", "start"]
        at = draw.randrange(100)
        docs.append((k, " ".join(words[:at] + (item if kind < 5 else []) + words[at:])))
    docs += [(100, items[0][1].upper()), (101, f"({items[3][1]})!"), (102, "a b a b a b a b a b a b")]
    items.append((93, "a b a b a b a b a b a b"))
    return docs, items


def test_equals_brute_force(spark):
    docs, items = planted()
    found, want = run(spark, docs, items), truth(docs, items)
    assert len(want) > 30 and found <= want and len(want - found) <= 0.02 * len(want)  # the radius may miss a few at the very threshold


def moved():
    """Items inside longer documents with their halves swapped, and with words inserted and changed about the anchors."""
    items = [(k, sentence(700 + k, 50 + 5 * k)) for k in range(10)]
    docs, draw = [], random.Random(5)
    for k in range(30):
        item, words = items[k % 10][1].split(), sentence(2000 + k, 150).split()
        if k < 10:
            item = item[len(item) // 2 :] + item[: len(item) // 2]
        elif k < 20:
            item[6:6] = ["inserted"]
            item[len(item) - 3] = "changed"
        else:
            for _ in range(2):
                item.insert(draw.randrange(len(item)), "inserted")
        at = draw.randrange(100)
        docs.append((k, " ".join(words[:at] + item + words[at:])))
    return docs, items


def test_windows_with_an_anchor_at_another_place(spark, monkeypatch):
    docs, items = moved()
    want = truth(docs, items)
    assert {(k, k) for k in range(10)} <= want and all(sum(k // 10 == kind for k, _ in want) >= 3 for kind in range(3))
    assert run(spark, docs, items) == want
    monkeypatch.setattr(dc, "BLOCK_ANCHORS", 40)
    assert run(spark, docs, items) == want


def test_starts_are_those_of_all_windows_with_a_shingle(spark):
    from pyspark.sql import functions as F

    draw = random.Random(9)
    cases = [(draw.sample(range(size - 4), draw.randint(1, min(6, size - 4))), n, size) for n in (5, 7, 20) for size in (5, 12, 40, 90)]
    rows = spark.createDataFrame(cases, "at array<int>, n int, size int").select("*", dc.starts(F.col("at"), F.col("n"), F.col("size")).alias("found")).collect()
    for r in rows:
        want = [s for s in range(max(0, r["size"] - r["n"]) + 1) if any(s <= p and p + 5 <= s + max(r["n"], r["size"] if r["size"] < r["n"] else 0) for p in r["at"])]
        assert r["found"] == want


def test_anchors_in_blocks(spark, monkeypatch):
    docs, items = planted()
    at_once = run(spark, docs, items)
    monkeypatch.setattr(dc, "BLOCK_ANCHORS", 40)
    assert run(spark, docs, items) == at_once


def test_index_finds_every_fingerprint_within_the_radius(spark):
    from pyspark.sql import functions as F

    draw = random.Random(1)
    base = [draw.randrange(65_536) for _ in range(dc.BLOCKS)]
    for _ in range(200):
        bits = draw.sample(range(16 * dc.BLOCKS), dc.RADIUS)
        other = list(base)
        for b in bits:
            other[b // 16] ^= 1 << b % 16
        assert any(bin(x ^ y).count("1") <= dc.NEAR for x, y in zip(base, other, strict=True))
    row = spark.range(1).select(dc.distance(F.lit([1, 2]), F.lit([3, 2])).alias("d"), dc.bag(F.lit([5, 5, 6])).alias("b")).first()
    assert row["d"] == 1 and len(set(row["b"])) == 3


def test_fingerprints_are_the_majority_of_each_bit(spark, monkeypatch):
    from pyspark.sql import functions as F

    def plain(words, more):
        bits = [sum((w >> k & 1) * 2 - 1 for w in source) > 0 for source in (words, more) for k in range(64)]
        return [int("".join(str(int(x)) for x in bits[16 * b : 16 * b + 16]), 2) for b in range(dc.BLOCKS)]

    draw = random.Random(4)
    cases = [[draw.randrange(-(2**63), 2**63) for _ in range(n)] for n in (0, 1, 2, 5, 36, 301)] + [[-1] * 7, [0] * 7, [-1, 0], [-(2**63)] * 3]
    cases += [[-1] * 32_767, [-1] * 40_000, [-1] * 32_768 + [0] * 32_768, [draw.choice((-1, 0, 1 << 47, -(2**63))) for _ in range(70_000)]]
    docs = spark.createDataFrame([(k, c) for k, c in enumerate(cases)], "k int, words array<bigint>").withColumn("more", F.transform("words", lambda w: F.xxhash64(w)))
    for lane_words in (dc.LANE_WORDS, 6):
        monkeypatch.setattr(dc, "LANE_WORDS", lane_words)
        for r in docs.withColumn("bits", dc.simhash(F.col("words"))).collect():
            assert r["bits"] == plain(r["words"], r["more"]), (lane_words, r["k"])


def test_fingerprints_need_no_pass_for_each_bit(spark):
    """A pass over the words for each bit, which hashed all of them once more, took half of the operator's time."""
    import time

    from pyspark.sql import functions as F

    def by_bit(words):
        more = F.transform(words, lambda w: F.xxhash64(w))
        votes = lambda source, k: F.aggregate(source, F.lit(0), lambda s, w: s + F.when(F.call_function("getbit", w, k) == 1, 1).otherwise(-1))
        block = lambda source, q: F.aggregate(F.sequence(F.lit(0), F.lit(15)), F.lit(0), lambda s, k: s * 2 + (votes(source, k + 16 * q) > 0).cast("int"))
        return F.array(*(block(words if b < 4 else more, b % 4) for b in range(dc.BLOCKS)))

    words = spark.range(0, 3_000, 1, 1).select(F.transform(F.sequence(F.lit(1), F.lit(36)), lambda k: F.xxhash64(k, "id")).alias("w")).cache()
    assert words.where(dc.simhash(F.col("w")) != by_bit(F.col("w"))).count() == 0

    def took(column):
        begun = time.time()
        words.select(column.alias("x")).write.format("noop").mode("overwrite").save()
        return time.time() - begun

    least = {k: min(took(f(F.col("w"))) for _ in range(4)) for k, f in (("lanes", dc.simhash), ("bits", by_bit))}
    words.unpersist()
    assert least["lanes"] < 0.6 * least["bits"], least


def test_odd_documents(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame([(1, sentence(1)), (2, ""), (None, sentence(7, 30))], "item_id long, text string")
    found = sorted(((r["doc_id"], r["item_id"]) for r in dc.contaminated(docs, items).collect()), key=repr)
    assert found == [(10, 1), (9, 1), (None, 1)]
    assert dc.contaminated(docs.where("false"), items).count() == 0 and dc.contaminated(docs, items.where("false")).count() == 0


def test_null_and_shared_item_ids(spark):
    null, shared = [(None, sentence(800 + k, 50)) for k in range(10)], [(7, sentence(900 + k, 50)) for k in range(10)]
    repeated = [(8, sentence(990, 50))] * 12
    docs = [(k, f"{sentence(3000 + k, 40)} {said} {sentence(4000 + k, 40)}") for k, (_, said) in enumerate(null + shared + repeated[:1])]
    edited = repeated[0][1].split()
    edited[3] = "changed"
    docs += [(50, " ".join(edited)), (51, null[0][1] + " " + shared[0][1])]
    want = {(k, None) for k in range(10)} | {(10 + k, 7) for k in range(10)} | {(20, 8), (50, 8), (51, None), (51, 7)}
    assert run(spark, docs, null + shared + repeated) == want
    d, b = spark.createDataFrame([(1, shared[0][1], None, None, 0)], SHAPE), spark.createDataFrame([*shared, (9, shared[0][1])], "item_id long, text string")
    assert sorted(tuple(r) for r in dc.contaminated(d, b).drop("text_hash").collect()) == [(1, 7, 0, 50, 0, 1.0), (1, 9, 0, 50, 0, 1.0)]


def test_no_python_in_the_plan(spark):
    docs = odd_documents(spark)
    plan = dc.contaminated(docs, spark.createDataFrame([(1, sentence(1))], "item_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
