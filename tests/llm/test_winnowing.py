import hashlib
import random

import pytest
import regex
import xxhash
from helpers import SHAPE, odd_documents, sentence

from lakesync.llm import winnowing as wn


def prints(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [[(x["hash"], x["pos"]) for x in r["fingerprint"]] for r in wn.fingerprints(df).orderBy("i").collect()]


def like(a, b):
    a, b = ({h for h, _ in x} for x in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def model(text, k=wn.K, w=wn.W):
    """Winnowing by definition, of a text: hash and position (from 1) of the rightmost smallest hash of each window."""
    tokens = regex.findall(wn.TOKEN.replace("Is", "").replace("&&[^", "--["), (text or "").lower(), regex.V1) or ([text] if text else [])
    hashed = [xxhash.xxh64_intdigest(t, 42) for t in tokens]
    hashes = []
    for s in range(max(1, len(hashed) - k + 1) if hashed else 0):
        value = 0
        for h in hashed[s : s + k]:
            value = ((value << 1 | value >> 63) & (2**64 - 1)) ^ h
        hashes.append(value & wn.MASK)
    out = []
    for s in range(max(1, len(hashes) - w + 1)):
        part = hashes[s : s + w]
        if part:
            best = min(part)
            at = s + max(k for k, x in enumerate(part) if x == best)
            if (best, at + 1) not in out:
                out.append((best, at + 1))
    return out


TEXTS = [None, "", "a", "!?", "a b c d e", "日本語テキスト and words", sentence(1, 200), "a b " * 40, sentence(2, 9), sentence(3, 12), sentence(4, 13), "x" * 1000, "Ab9-" * 60, "one two three four"]


def test_equals_the_definition(spark):
    assert prints(spark, *TEXTS) == [model(t) for t in TEXTS]


@pytest.mark.parametrize(("k", "w"), [(1, 1), (2, 3), (3, 7), (6, 2), (7, 11)])
def test_any_sizes_equal_the_definition(spark, k, w):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string")
    found = [[(x["hash"], x["pos"]) for x in r["fingerprint"]] for r in wn.fingerprints(df, k=k, w=w).orderBy("i").collect()]
    assert found == [model(t, k, w) for t in TEXTS]


def test_shared_runs_share_a_fingerprint(spark):
    run, draw = sentence(9, wn.K + wn.W - 1), random.Random(2)
    pairs = [(f"{sentence(k, draw.randint(0, 40))} {run} {sentence(k + 50, 20)}", f"{sentence(k + 100, 7)} {run} {sentence(k + 150, 30)}") for k in range(20)]
    for a, b in pairs:
        one, two = prints(spark, a, b)
        assert {h for h, _ in one} & {h for h, _ in two}
        break
    flat = prints(spark, *[t for p in pairs for t in p])
    assert all({h for h, _ in flat[k]} & {h for h, _ in flat[k + 1]} for k in range(0, len(flat), 2))
    assert not {h for h, _ in flat[0]} & {h for h, _ in prints(spark, sentence(999, 100))[0]}


def test_short_texts(spark):
    assert [len(x) for x in prints(spark, None, "", "a", "!?", "a b c d e", "日本語テキスト")] == [0, 0, 1, 1, 1, 1]


@pytest.mark.parametrize("partitions", ["2", "4", "16"])
def test_edited_texts(spark, partitions):
    texts = {i: ["", sentence(i, 20), sentence(3, 40), "é" * 5, "x"][i % 5] for i in random.Random(1).sample(range(10_000), 60)}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = {r["doc_id"]: r for r in wn.fingerprint_edits(spark.createDataFrame([(i, t, None, None, 0) for i, t in texts.items()], SHAPE)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    ids = sorted(texts, reverse=True)
    for k, i in enumerate(ids):
        text, after = texts[i], texts[ids[(k + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = found[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        own, changed, following = (model(t) for t in (text, edited, after))
        assert (r["fingerprint"], r["edited_fingerprint"]) == tuple(",".join(f"{h:x}:{at}" for h, at in x) for x in (own, changed))
        assert (r["near_edited"], r["near_next"]) == (like(own, changed), like(own, following))


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = wn.fingerprint_edits(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r[c] <= 1 for r in rows for c in ("near_edited", "near_next")) and sum(r["doc_id"] is None for r in rows) == 2
    assert wn.fingerprint_edits(docs.where("false")).count() == 0
    one = wn.fingerprint_edits(docs.where("doc_id = 4")).first()
    assert one["near_next"] == 1 and one["edited_sha256"] == hashlib.sha256(b"a").hexdigest()


def test_no_python_in_the_plan(spark):
    plan = wn.fingerprint_edits(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan
