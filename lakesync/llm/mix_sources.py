"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length for each source. A source's word budget is met by whole passes over it plus a
subset of its documents for the rest, found by bounded-knapsack dynamic programming over the counts of its lengths: the
sum is the largest that any subset reaches within the budget (see fit). Which documents of a length are taken is drawn
by a seeded hash of id and text.

Defined results: a null or empty text has size 0 and is never taken; a null source is a source of its own, last in
order; null or repeated ids are separate documents of the mix, repeated rows too (which of them is taken can't be told
apart); an empty table gives an empty result; other columns are ignored unless asked for.
"""

from __future__ import annotations

from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, read_table

WORD = r"[^\x20\x09-\x0D]+"
#: Lengths that the first programme may take more or fewer documents of, beside those that make all sums possible.
FIRST_LENGTHS = 16
#: Sums times items that one programme may go through, some ten seconds and 5 bytes a sum.
MOST_WORK = 1 << 33
#: Rows that one task ranks, about: documents of one source and length are dealt by the leading bits of their draw.
PART_ROWS = 1 << 20
#: Largest number of sources whose budgets are sent to all executors; beyond it they are joined by a shuffle.
BROADCAST_SOURCES = 10_000


def knapsack(lengths: list[int], counts: list[int], budget: int) -> dict[int, int]:
    """How many of each length to take so that their sum comes as near to budget as can be, from below.

    Counts are split into powers of two. Of each sum only the item that first reached it is kept, from which the choice
    is traced back; the programme ends when the budget itself is reached.
    """
    by, reached, items = np.full(budget + 1, -1, dtype=np.int32), np.zeros(budget + 1, dtype=bool), []
    reached[0] = True
    for length, count in zip(lengths, counts, strict=True):
        count, k = min(count, budget // length), 1
        while count > 0 and not reached[budget]:
            now = min(k, count)
            new = np.flatnonzero(reached[: budget + 1 - now * length] & ~reached[now * length :]) + now * length
            by[new], reached[new] = len(items), True
            items.append((length, now))
            count, k = count - now, 2 * k
    at, taken = int(np.flatnonzero(reached)[-1]), {}
    while at:
        length, k = items[by[at]]
        at -= length * k
        taken[length] = taken.get(length, 0) + k
    return taken


def _order(lengths: list[int]) -> list[int]:
    """Places of the lengths: first those that bring the common divisor down to that of all, then from short to long."""
    divisor, first = 0, []
    for i, n in enumerate(lengths):
        if gcd(divisor, n) != divisor:
            divisor = gcd(divisor, n)
            first.append(i)
    return first + [i for i in range(len(lengths)) if i not in set(first)]


def bound(lengths: list[int], counts: list[int], budget: int) -> int:
    """A sum within budget that no subset exceeds, from what remains of subsets' sums when they are divided.

    Lengths of many documents may have a common divisor; then the remainder comes from the other lengths alone, of which
    there are few documents, so only some remainders occur. At 0 documents that is the divisor of all lengths.
    """
    seen, few = set(), 0
    while few < max(counts):
        m = gcd(*(n for n, c in zip(lengths, counts, strict=True) if c > few))
        if m > 1 and m not in seen:
            seen.add(m)
            found = np.zeros(m, dtype=bool)
            found[0] = True
            for n, c in zip(lengths, counts, strict=True):
                k = 1
                while 0 < c <= few and n % m and not found.all():
                    found |= np.roll(found, min(k, c) * n % m)
                    c, k = c - min(k, c), 2 * k
            budget -= int(((budget - np.flatnonzero(found)) % m).min())
        few = 2 * few or 1
    return budget


def fit(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each length (ascending, positive) come as near to budget as any choice can, from below.

    A share of every length, filled up from the longest, is a first choice. The dynamic programme then chooses anew among
    up to `slack` documents more or fewer of some lengths. A sum that meets `bound` can't be bettered; until then slack
    grows, then the lengths, at the end to all documents, when the programme has seen every choice. Only where that would
    take more than MOST_WORK steps (lengths with few sums, bound not reached) the best choice so far stands.
    """
    size = sum(n * c for n, c in zip(lengths, counts, strict=True))
    if budget >= size:
        return list(counts)
    budget = bound(lengths, counts, budget)
    take = [c * budget // size for c in counts]
    left = budget - sum(n * t for n, t in zip(lengths, take, strict=True))
    for i in range(len(lengths) - 1, -1, -1):
        more = min(counts[i] - take[i], left // lengths[i])
        take[i], left = take[i] + more, left - more * lengths[i]
    order, some, slack = _order(lengths), FIRST_LENGTHS, 1
    while left:
        free = sorted(order[:some])
        low = {i: max(take[i] - slack, 0) for i in free}
        high = {i: min(take[i] + slack, counts[i]) for i in free}
        rest = left + sum((take[i] - low[i]) * lengths[i] for i in free)
        work = rest * sum(min(high[i] - low[i], rest // lengths[i]).bit_length() for i in free)
        if work <= MOST_WORK:
            found = knapsack([lengths[i] for i in free], [high[i] - low[i] for i in free], rest)
            left = rest - sum(n * k for n, k in found.items())
            for i in free:
                take[i] = low[i] + found.get(lengths[i], 0)
        if work <= MOST_WORK and any(low[i] or high[i] < counts[i] for i in free):
            slack *= 4
        elif some < len(lengths):
            some, slack = 4 * some, 1
        else:
            break
    return take


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    """For one source: base passes over it and the further documents to take of each length."""
    rows = rows.sort_values("size")
    some = rows[rows["size"] > 0]
    whole, target = int((some["size"] * some["n"]).sum()), float(rows["target"].iloc[0])
    base = int(target // whole) if whole else 0
    extra = fit(some["size"].tolist(), some["n"].tolist(), min(max(round(target) - base * whole, 0), whole))
    return pd.DataFrame({"key": rows["key"], "size": rows["size"], "source_size": rows["source_size"], "target": rows["target"], "base": base, "extra": [0] * (len(rows) - len(some)) + extra})


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float, scratch: Scratch) -> DataFrame:
    """sources (key, source, source_size) with target: share of all sizes by weight, none above most times its size.

    Sources are numbered by a sort in ranges. Those at their bound are found in rounds: each deals what these leave out
    again by weight, until no further source is above its bound. The driver sees one row for each weight a round.
    """
    placed = sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    placed = scratch.table(placed.withColumn("at", F.monotonically_increasing_id()), "placed")
    ranges = placed.groupBy(F.shiftright("at", 33).alias("range")).agg(F.count(F.lit(1)).alias("n"))  # as many as partitions
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumn("range", F.shiftright("at", 33)).join(F.broadcast(ranges.select("range", before.alias("before"))), "range")
    kind = F.pmod(F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)), F.lit(len(weights))).cast("int")
    placed = scratch.table(placed.select("key", "source_size", kind.alias("kind")), "weighed")
    of = lambda c, values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), c + 1)
    counted = {r["kind"]: r for r in placed.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("source_size").alias("size")).collect()}
    budget = share * sum(r["size"] for r in counted.values())
    level, full = 0.0, {}
    while True:
        left = sum(w * (counted[k]["n"] - (full[k]["n"] if k in full else 0)) for k, w in enumerate(weights) if k in counted)
        if left <= 0:
            above = F.lit(True)
            break
        level = max((budget - most * sum(r["size"] for r in full.values())) / left, 0.0)
        above = F.lit(level) * of(F.col("kind"), weights) > F.lit(most) * F.col("source_size")
        last = sum(r["n"] for r in full.values())
        full = {r["kind"]: r for r in placed.where(above).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("source_size").alias("size")).collect()}
        if sum(r["n"] for r in full.values()) == last:
            break
    return placed.select("key", "source_size", F.when(above, F.lit(most) * F.col("source_size")).otherwise(F.lit(level) * of(F.col("kind"), weights)).alias("target"))


def mix(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", keep: tuple[str, ...] = (),
    weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 17,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words, repeats counted), and the columns keep of docs.

    weights repeat over the sources by code point, null last; together they get share times all words, none more than
    most times its own.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    whole = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")).alias("key"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("draw"), *(F.col(c).alias(f"kept_{c}") for c in keep),
    )
    rows = scratch.table(whole.drop(*(f"kept_{c}" for c in keep)), "sizes")
    bits = max((rows.count() // PART_ROWS).bit_length(), 8)
    part = F.shiftrightunsigned("draw", 64 - bits).cast("int")
    sources = scratch.table(rows.groupBy("key", "source").agg(F.sum("size").alias("source_size")), "sources")
    budgets = scratch.table(targets(sources, weights, share, most, scratch), "budgets")
    if budgets.count() <= BROADCAST_SOURCES:
        budgets = F.broadcast(budgets)
    parts = scratch.table(rows.groupBy("key", "size", part.alias("part")).agg(F.count(F.lit(1)).alias("n")), "parts")
    lengths = parts.groupBy("key", "size").agg(F.sum("n").alias("n")).join(budgets, "key")
    plan = lengths.groupBy("key").applyInPandas(_plan, "key string, size long, source_size long, target double, base long, extra long")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("key", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.withColumn("before", before).join(plan, ["key", "size"])
    need = scratch.table(parts.select("key", "size", "part", "source_size", "target", "base", (F.col("extra") - F.col("before")).alias("need")), "need")
    rank = F.row_number().over(Window.partitionBy("key", "size", "part").orderBy("draw"))
    ranked = (whole if keep else rows).withColumn("part", part).withColumn("rank", rank).drop("draw")
    taken = F.col("size") * (F.col("base") + (F.col("rank") <= F.col("need")).cast("long"))
    return ranked.join(need, ["key", "size", "part"]).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), *(F.col(f"kept_{c}").alias(c) for c in keep))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).drop("source")
