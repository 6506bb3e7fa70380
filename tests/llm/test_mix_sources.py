import random
import re
from collections import defaultdict

import pytest
from helpers import SHAPE, odd_documents

from lakesync.llm import mix_sources as ms
from lakesync.llm.common import Scratch


def plain_targets(sizes, weights, share, most):
    """Round by round: those above their bound stop there, the rest is dealt by weight among the others."""
    out, left, budget = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while left:
        whole = sum(weights[i] for i in left)
        full = [i for i in left if budget * weights[i] / whole > most * sizes[i]]
        for i in full or left:
            out[i] = most * sizes[i] if full else budget * weights[i] / whole
        budget = max(budget - sum(out[i] for i in full), 0.0)
        left = left.difference(full) if full else set()
    return out


def test_targets(spark):
    assert plain_targets([100, 100, 100], [5, 2, 1], 1.5, 2) == pytest.approx([200, 500 / 3, 250 / 3])
    draw = random.Random(1)
    for n in (0, 1, 2, 40, 200):
        names = [None, *sorted(f"{chr(draw.choice([65, 97, 233, 0x65E5, 0x1F600]))}{i}" for i in range(n))][: n or 0]
        given = [(f"k{i}", s, draw.choice([0, 1, 10, 1000, 10**6])) for i, s in enumerate(names)]
        draw.shuffle(given)
        df = spark.createDataFrame(given, "key string, source string, source_size long")
        found = {r["key"]: r for r in ms.targets(df, (5, 2, 1), 1.5, 2.0, Scratch(spark, "test")).collect()}
        given.sort(key=lambda r: (r[1] is None, r[1]))
        want = plain_targets([r[2] for r in given], [(5, 2, 1)[k % 3] for k in range(n)], 1.5, 2)
        assert [found[r[0]]["target"] for r in given] == pytest.approx(want) and len(found) == n
        assert sum(want) == pytest.approx(1.5 * sum(r[2] for r in given))


def test_knapsack_is_optimal():
    draw = random.Random(2)
    for _ in range(300):
        lengths = sorted(draw.sample(range(1, 40), draw.randint(1, 6)))
        counts = [draw.randint(1, 4) for _ in lengths]
        budget = draw.randint(0, 120)
        sums = {0}
        for n, c in zip(lengths, counts, strict=True):
            sums = {s + k * n for s in sums for k in range(c + 1) if s + k * n <= budget}
        taken = ms.knapsack(lengths, counts, budget)
        assert sum(n * k for n, k in taken.items()) == max(sums) and all(taken[n] <= counts[lengths.index(n)] for n in taken)


def best_sum(lengths, counts, budget):
    sums = {0}
    for n, c in zip(lengths, counts, strict=True):
        sums = {s + k * n for s in sums for k in range(c + 1) if s + k * n <= budget}
    return max(sums)


def test_fit_is_the_best_subset(monkeypatch):
    draw = random.Random(3)
    assert ms.fit([3, 5], [2, 2], 10) == [0, 2] and ms.fit([], [], 0) == [] and ms.fit([5], [2], 10) == [2] and ms.fit([7], [3], 6) == [0]
    for case in range(1500):
        monkeypatch.setattr(ms, "FIRST_LENGTHS", 1 if case % 2 else 16)
        step = draw.choice([1, 1, 2, 7])
        lengths = sorted(step * n for n in draw.sample(range(1, 30), draw.randint(1, 7)))
        counts = [draw.choice([1, 1, 2, 5]) for _ in lengths]
        budget = draw.randint(0, sum(n * c for n, c in zip(lengths, counts, strict=True)))
        take = ms.fit(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts, strict=True))
        assert sum(n * t for n, t in zip(lengths, take, strict=True)) == best_sum(lengths, counts, budget), (lengths, counts, budget)


def test_fit_of_many_lengths_is_exact():
    draw = random.Random(3)
    for case in range(30):
        lengths = sorted(draw.sample(range(1, 20_000), 300)) + [30_000, 50_000]
        if case % 2:
            lengths = [10 * n for n in lengths] + [500_001]
        counts = [draw.choice([1, 3, 50, 10**7]) for _ in lengths]
        budget = draw.randint(0, sum(n * c for n, c in zip(lengths, counts, strict=True)))
        take = ms.fit(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts, strict=True))
        best = budget
        while case % 2 and best % 10 > min(counts[-1], 9):  # all but the last length are multiples of ten
            best -= 1
        assert sum(n * t for n, t in zip(lengths, take, strict=True)) == best


def sources(spark, n=600):
    draw = random.Random(4)
    rows = [(i, "w " * draw.choice([0, 1, 3, 3, 3, 40, 500]), None, draw.choice(["a", "a", "a", "b", "É", "z", None]), 0) for i in range(n)]
    return spark.createDataFrame(rows, SHAPE), rows


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    df, given = sources(spark)
    found = ms.mix(df).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, ms.mix(df.repartition(7)).collect())) and len(found) == len(given)
    sizes, taken, goal = defaultdict(int), defaultdict(int), {}
    for r in found:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        goal[r["source"]] = r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = plain_targets([sizes[s] for s in order], [[5, 2, 1][k % 3] for k in range(len(order))], 1.5, 2)
    assert [goal[s] for s in order] == pytest.approx(want) and all(abs(taken[s] - goal[s]) <= 1 for s in order)
    assert {r["doc_id"]: r["size"] for r in found} == {i: len(re.findall(ms.WORD, t)) for i, t, *_ in given}
    assert all(r["source_size"] == sizes[r["source"]] for r in found)


def test_odd_documents(spark, monkeypatch):
    docs = odd_documents(spark)
    found = ms.mix(docs).collect()
    assert len(found) == docs.count() and sum(r["size"] == 0 for r in found) >= 4 and all(r["taken"] <= 2 * r["size"] for r in found)
    monkeypatch.setattr(ms, "BROADCAST_SOURCES", 0)
    assert sorted(map(repr, ms.mix(docs).collect())) == sorted(map(repr, found))
    assert ms.mix(docs.where("false")).count() == 0


def test_kept_columns_and_repeated_ids(spark):
    docs = odd_documents(spark)
    found = ms.mix(docs, keep=("text", "lang", "size", "key")).collect()
    assert len(found) == docs.count() and all(r["key"] == "key" for r in found) and sorted(map(repr, (r["text"] for r in found))) == sorted(map(repr, (r["text"] for r in docs.collect())))


def test_number_of_parts_does_not_matter(spark, monkeypatch):
    df, _ = sources(spark)
    want = sorted(map(repr, ms.mix(df).collect()))
    monkeypatch.setattr(ms, "PART_ROWS", 1)
    assert sorted(map(repr, ms.mix(df).collect())) == want
