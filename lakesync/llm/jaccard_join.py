"""N-gram Jaccard join with Bayesian pruning of candidate pairs.

A text is the set of its runs of N words (lower-cased runs of letters, digits and underscores; where there are none,
of what white space separates), a text of fewer words the set of that one run. Texts with equal sets are one
representative with a weight. Representatives get HASHES MinHash values; those that agree on all values of one of
BANDS bands are candidates (a pair at similarity 0.8 shares none with probability 3e-6). MinHash values of candidates
are compared a few at a time, and a pair is dropped as soon as the posterior probability that it reaches the threshold,
from a uniform prior, falls below TOLERANCE. All others are verified on the sets themselves. The first comparison is
part of the join that makes the candidates: a mixed bit of each of SKETCH values, and the sizes of the sets, whose ratio
is a bound of their similarity. So documents that share no more than a common passage do not become rows.

Large groups of near copies are neither paired in a table nor gathered in a task: each representative follows a leader,
one of the smallest representatives of its buckets that it resembles and that most others follow, or that one's own.
Pairs with one leader are compared in memory, in blocks bounded by rows and bytes, of which only sums and roots come
out. In a bucket of several leaders those that do not follow its main one are paired with all others of other leaders;
large buckets are dealt in cells of CELL rows on either side, so that no task holds a bucket. Joins on buckets, leaders
and representatives deal the rows of hot keys over tasks (common.spread_join).

Defined results: a text without words is in a class of its own and has no links; null texts count as such; rows
with a null id count as documents and get the smallest id of their class (null if it has none); repeated rows are
documents of their own; of a class the document with the smallest id (null first), of equal ids the one with the
smallest hash of its text, leads; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table, small_batches, spread_join
from .components import components

N, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
STEP, TOLERANCE = 16, 1e-6
SKETCH = 128
#: Estimated similarity from which a representative follows a leader.
LEAD = 0.4
#: Representatives and bytes of sets of a block (about, as they are dealt by hash), and how many of a block are compared at once.
BLOCK, BLOCK_BYTES, TILE = 1024, 8 << 20, 256
#: Rows of a bucket on either side that are paired in one cell.
CELL = 4096
#: Word hashes that a worker keeps.
KEPT_WORDS = 50_000
_WORD = re.compile(r"\w+")
_ODD = np.uint64(0x9E3779B97F4A7C15)  # 2^64 divided by the golden ratio


def words(text: str | None) -> list[str]:
    text = (text or "").lower()
    return _WORD.findall(text) or text.split()


@cache
def _known() -> dict[str, int]:
    return {}


def _word_hashes(found: list[str]) -> np.ndarray:
    import xxhash

    known = _known()
    if len(known) > KEPT_WORDS:
        known.clear()
    out = []
    for word in found:
        value = known.get(word)
        if value is None:
            value = known[word] = xxhash.xxh64_intdigest(word)
        out.append(value)
    return np.array(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, n: int = N) -> np.ndarray:
    """The set of a text's n-word runs as sorted 64-bit hashes."""
    hashed = _word_hashes(words(text))
    if not len(hashed):
        return hashed
    n = min(n, len(hashed))
    out = np.full(len(hashed) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = _mixed(out * _ODD + hashed[k : len(hashed) - n + 1 + k])
    return np.unique(out)


@cache
def _functions() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(7)
    return random.integers(1, 2**32, (HASHES, 1), dtype=np.uint32) | np.uint32(1), random.integers(0, 2**32, (HASHES, 1), dtype=np.uint32)


def minhash(found: np.ndarray) -> np.ndarray:
    """HASHES MinHash values of a set."""
    a, b = _functions()
    x, out = (found >> np.uint64(32)).astype(np.uint32), np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, len(x), 1024):
        np.minimum(out, (a * x[None, k : k + 1024] + b).min(axis=1), out=out)
    return out


@cache
def least_matches(threshold: float) -> list[tuple[int, int]]:
    """(values compared, matches needed) by step: with fewer, the posterior of reaching threshold is below TOLERANCE.

    With a uniform prior the posterior after m of n matches is Beta(m + 1, n - m + 1), and its upper tail at t is the
    probability of at most m successes in n + 1 draws with chance t.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, -1
        while tail < TOLERANCE:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


@cache
def most_unequal_bits(threshold: float) -> int:
    """Of SKETCH bits of MinHash values, how many may differ before the posterior of reaching threshold is below TOLERANCE.

    Bits agree with chance (1 + similarity) / 2, so a uniform prior of similarity is one of that chance from 1/2 to 1.
    """
    above = lambda p, equal: sum(comb(SKETCH + 1, m) * p**m * (1 - p) ** (SKETCH + 1 - m) for m in range(equal + 1))
    equal = 0
    while above((1 + threshold) / 2, equal) < TOLERANCE * above(0.5, equal):
        equal += 1
    return SKETCH - equal


def survivors(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Which pairs (a[i], b[i]) of rows of left and right are still likely after each step: their indices."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), dtype=np.int64)
    for end, needed in least_matches(threshold):
        part = slice(end - STEP, end)
        matches[alive] += (left[a[alive], part] == right[b[alive], part]).sum(axis=1)
        alive = alive[matches[alive] >= needed]
    return alive


def _describe(texts: pd.Series) -> pd.DataFrame:
    import xxhash

    rows = []
    for text in texts:
        found = shingles(text)
        key = np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64) if len(found) else None
        rows.append((key, minhash(found).tobytes() if len(found) else None, len(found)))
    return pd.DataFrame({"rep": pd.array([r[0] for r in rows], dtype="Int64"), "values": pd.Series([r[1] for r in rows], dtype=object), "n": [r[2] for r in rows]})


def _sets(texts: pd.Series) -> pd.DataFrame:
    import xxhash

    found = [shingles(t) for t in texts]
    return pd.DataFrame({"key": [int(np.uint64(xxhash.xxh3_64_intdigest(x.tobytes())).astype(np.int64)) for x in found], "set": [x.tobytes() for x in found]})


def _buckets(values: pd.Series) -> pd.Series:
    signed = np.frombuffer(b"".join(values), dtype=np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64) if len(values) else np.empty((0, BANDS, ROWS), dtype=np.uint64)
    out = np.tile(np.arange(BANDS, dtype=np.uint64), (len(values), 1))
    for k in range(ROWS):
        out = _mixed(out * _ODD + signed[:, :, k])
    return pd.Series(list(out.astype(np.int64)))


def sketch(values: np.ndarray) -> np.ndarray:
    """A bit of each of SKETCH MinHash values, mixed with the value's number: the values' own bits go together in small sets."""
    return (_mixed(_mixed(values[:, :SKETCH].astype(np.uint64) * _ODD + np.arange(SKETCH, dtype=np.uint64))) >> np.uint64(63)).astype(np.uint8)


def _sketches(values: pd.Series) -> pd.DataFrame:
    bits = np.packbits(sketch(_rows(values)), axis=1).view(np.int64) if len(values) else np.empty((0, 2), dtype=np.int64)
    return pd.DataFrame({"low": bits[:, 0], "high": bits[:, 1]})


def _rows(values: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=np.uint32).reshape(-1, HASHES)


def _likely(threshold: float):
    """Pandas function of two columns of MinHash values: the estimated similarity, 0 for pairs dropped on the way."""

    def compare(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.zeros(len(a))
        if len(a):
            left, right, at = _rows(a), _rows(b), np.arange(len(a))
            alive = survivors(left, right, at, at, threshold)
            out[alive] = (left[alive] == right[alive]).mean(axis=1)
        return pd.Series(out)

    return F.pandas_udf(compare, "double")


def _exact(a: pd.Series, b: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(a, b, strict=True):
        x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        out.append(both / (len(x) + len(y) - both))
    return pd.Series(out, dtype="float64")


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of left with all of right, by products of 0/1 matrices over parts of the elements."""
    sets = [*left, *right]
    found, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = times > 1
    column = (np.cumsum(shared) - 1)[at]
    keep = shared[at]
    row, column = row[keep], column[keep]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for start in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        part = np.zeros((len(sets), 4096), dtype=np.float32)
        part[row[a:b], column[a:b] - start] = 1
        out += part[: len(left)] @ part[len(left) :].T
    return out


def _linked(x: pd.DataFrame, y: pd.DataFrame, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of x and y (of x and itself: each pair once) at THRESHOLD or more."""
    a, b = np.triu_indices(len(x), 1) if same else (g.ravel() for g in np.indices((len(x), len(y))))
    alive = survivors(_rows(x["values"]), _rows(y["values"]), a, b)
    a, b = a[alive], b[alive]
    if not len(a):
        return a, b
    left, right = ([np.frombuffer(s, dtype=np.uint64) for s in side["set"]] for side in (x, y))
    both = common(left, right)[a, b].astype(np.int64)
    nx, ny = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    linked = both >= THRESHOLD * (nx[a] + ny[b] - both) - 1e-9
    return a[linked], b[linked]


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    """Links within one block or between two blocks of representatives: for each its links' weight and the smallest it hangs together with."""
    first = rows["block"] == rows["low"]
    x, y = rows[first].reset_index(drop=True), rows[~first].reset_index(drop=True)
    same = rows["low"].iloc[0] == rows["high"].iloc[0]
    reps, weight = (np.concatenate([x[c].to_numpy(), y[c].to_numpy()]) for c in ("rep", "weight"))
    links, label = np.zeros(len(reps), dtype=np.int64), np.arange(len(reps))
    other, shift = (x, 0) if same else (y, len(x))
    for i in range(0, len(x), TILE):
        for j in range(i if same else 0, len(other), TILE):
            a, b = _linked(x.iloc[i : i + TILE], other.iloc[j : j + TILE], same and i == j)
            a, b = a + i, b + j + shift
            np.add.at(links, a, weight[b])
            np.add.at(links, b, weight[a])
            while (apart := label[a] != label[b]).any():  # all rows of the higher label take on the lower one
                lower = np.arange(len(reps))
                np.minimum.at(lower, np.maximum(label[a], label[b])[apart], np.minimum(label[a], label[b])[apart])
                label = lower[label]
    hit, least = links > 0, np.full(len(reps), np.iinfo(np.int64).max)
    np.minimum.at(least, label, reps)
    return pd.DataFrame({"rep": reps[hit], "links": links[hit], "root": least[label][hit]})


def _leaders(banded: DataFrame, full: DataFrame, values: DataFrame, scratch: Scratch) -> DataFrame:
    """rep, leader: of the smallest representatives of its buckets that it resembles, the one that most others follow, or that one's own leader."""
    met = spread_join(banded, full.select("bucket", "first", "n"), "bucket", F.col("rep"), full)
    met = met.where("rep <> first").groupBy("rep", "first").agg(F.max("n").alias("n"))
    met = scratch.table(met.join(values, "rep"), "met")
    firsts = scratch.table(met.groupBy("first").agg(F.count(F.lit(1)).alias("n")), "firsts")
    named = firsts.select("first").join(values.select(F.col("rep").alias("first"), F.col("values").alias("first_values")), "first")
    follows = spread_join(met.select("rep", "values", "first"), named, "first", F.col("rep"), firsts)
    follows = scratch.table(follows.where(_likely(LEAD)("values", "first_values") >= LEAD).select("rep", "first"), "follows")
    scratch.drop("met")
    followers = scratch.table(follows.groupBy("first").agg(F.count(F.lit(1)).alias("n")), "followers")
    best = spread_join(follows, followers, "first", F.col("rep"), followers).groupBy("rep").agg(F.max(F.struct("n", F.col("first").alias("leader"))).alias("best"))
    own = followers.select(F.col("first").alias("rep"), F.struct("n", F.col("first").alias("leader")).alias("own"))
    chosen = scratch.table(best.join(own, "rep", "left").select("rep", F.greatest("best", "own")["leader"].alias("leader")), "chosen")
    theirs = chosen.select(F.col("rep").alias("leader"), F.col("leader").alias("theirs"))
    led = spread_join(chosen, theirs, "leader", F.col("rep"), chosen.groupBy("leader").agg(F.count(F.lit(1)).alias("n")), "left")
    return scratch.table(led.select("rep", F.coalesce("theirs", "leader").alias("leader")), "leaders")


def _apart(led: DataFrame, sketches: DataFrame, full: DataFrame, scratch: Scratch) -> DataFrame:
    """a, b: representatives of different leaders that share a bucket and whose sketches and sizes let them reach the threshold."""
    counted = led.groupBy("bucket", "leader").agg(F.count(F.lit(1)).alias("n"))
    mixed = counted.groupBy("bucket").agg(F.max(F.struct("n", "leader")).alias("main"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("leaders")).where("leaders > 1")
    cells = lambda n: F.ceil(n / F.lit(CELL)).cast("int")
    mixed = scratch.table(mixed.select("bucket", F.col("main.leader").alias("main"), cells(F.col("all") - F.col("main.n")).alias("a_cells"), cells(F.col("all")).alias("b_cells")), "mixed")
    rows = scratch.table(spread_join(led, mixed, "bucket", F.col("rep"), full).join(sketches, "rep"), "mixed_rows")
    side = lambda df, name: df.select("bucket", "a_cell", "b_cell", *(F.col(c).alias(f"{name}_{c}") for c in ("rep", "leader", "n", "low", "high")), *(["main"] if name == "b" else []))
    dealt = lambda cells: F.pmod(F.xxhash64("rep"), F.col(cells)).cast("int")
    every = lambda cells: F.explode(F.sequence(F.lit(0), F.col(cells) - 1))
    a = side(rows.where("leader <> main").withColumn("a_cell", dealt("a_cells")).withColumn("b_cell", every("b_cells")), "a")
    b = side(rows.withColumn("b_cell", dealt("b_cells")).withColumn("a_cell", every("a_cells")), "b")
    unequal = sum(F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in ("low", "high"))
    similar = (F.least("a_n", "b_n") >= F.greatest("a_n", "b_n") * F.lit(THRESHOLD) - 1e-9) & (unequal <= most_unequal_bits(THRESHOLD))
    once = (F.col("b_leader") == F.col("main")) | (F.col("a_rep") < F.col("b_rep"))
    same = (a["bucket"] == b["bucket"]) & (a["a_cell"] == b["a_cell"]) & (a["b_cell"] == b["b_cell"])
    pairs = a.join(b, same & (F.col("a_leader") != F.col("b_leader")) & once & similar)
    return pairs.select(F.least("a_rep", "b_rep").alias("a"), F.greatest("a_rep", "b_rep").alias("b")).distinct()


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash, class_id (smallest id among what hangs together by links), n_links (other documents at THRESHOLD or more), leads (whether it is the first of its class)."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "jaccard")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    place = F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("place")
    describe = F.pandas_udf(_describe, "rep long, values binary, n int")
    described = scratch.table(texts.select(place, describe("text").alias("d")).select("place", "d.*"), "described")
    reps = described.where("rep is not null").groupBy("rep").agg(
        F.min("place.doc_id").alias("doc_id"), F.count(F.lit(1)).alias("weight"), F.min("place").alias("place"), F.first("values").alias("values"), F.first("n").alias("n")
    )
    reps = scratch.table(reps, "reps")
    members = scratch.table(described.select("place", "rep"), "members")
    scratch.drop("described")

    values = reps.select("rep", "values")
    banded = scratch.table(values.select("rep", F.explode(F.pandas_udf(_buckets, "array<long>")("values")).alias("bucket")), "banded")
    full = scratch.table(banded.groupBy("bucket").agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "full")
    leaders = _leaders(banded, full, values, scratch)
    led = spread_join(banded, full.select("bucket"), "bucket", F.col("rep"), full).join(leaders, "rep", "left")
    led = scratch.table(led.select("bucket", "rep", F.coalesce("leader", "rep").alias("leader")), "led")
    scratch.drop("banded")
    sketches = reps.select("rep", "n", F.pandas_udf(_sketches, "low long, high long")("values").alias("bits")).select("rep", "n", "bits.*")
    pairs = _apart(led, sketches, full, scratch)
    named = lambda name: values.select(F.col("rep").alias(name), F.col("values").alias(f"{name}_values"))
    pairs = pairs.join(named("a"), "a").join(named("b"), "b")
    pairs = scratch.table(pairs.where(_likely(THRESHOLD)("a_values", "b_values") > 0).select("a", "b"), "pairs")

    groups = scratch.table(led.select("rep", "leader").distinct().join(reps.select("rep", "n"), "rep"), "grouped")
    scratch.drop("led", "leaders", "follows", "mixed_rows")
    sizes = groups.groupBy("leader").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("elements")).where("n > 1")
    sizes = scratch.table(sizes.select("leader", "n", F.ceil(F.greatest(F.col("n") / F.lit(BLOCK), F.col("elements") * 8 / F.lit(BLOCK_BYTES))).cast("int").alias("blocks")), "sizes")
    groups = scratch.table(spread_join(groups.select("rep", "leader"), sizes.select("leader", "blocks"), "leader", F.col("rep"), sizes), "groups")
    wanted = groups.select("rep").union(pairs.select("a")).union(pairs.select("b")).distinct().join(reps.select("rep", "place"), "rep")
    asked = texts.select("text", place).join(wanted.select("rep", F.col("place").alias("wanted")), F.col("place").eqNullSafe(F.col("wanted"))).groupBy("rep").agg(F.first("text").alias("text"))
    shingled = F.pandas_udf(_sets, "key long, set binary").asNondeterministic()  # else the filter gets a call, and each task a worker, of its own
    sets = asked.select("rep", shingled("text").alias("s")).where("s.key = rep").select("rep", "s.set")
    sets = scratch.table(sets, "sets")

    blocks = groups.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    blocks = blocks.join(sets, "rep").join(reps.select("rep", "weight", "values"), "rep").select("leader", "rep", "block", "weight", "values", "set", other)
    blocks = blocks.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other")
    inside = scratch.table(blocks.groupBy("leader", "low", "high").applyInPandas(_compare, "rep long, links long, root long"), "inside")
    of = lambda name: sets.select(F.col("rep").alias(name), F.col("set").alias(f"{name}_set"))
    across = pairs.join(of("a"), "a").join(of("b"), "b").where(F.pandas_udf(_exact, "double")("a_set", "b_set") >= THRESHOLD - 1e-12).select("a", "b")
    across = scratch.table(across, "across")
    scratch.drop("sets")

    weights = reps.select("rep", "weight")
    counted = inside.select("rep", "links")
    for one, two in (("a", "b"), ("b", "a")):
        counted = counted.union(across.join(weights, across[two] == weights["rep"]).select(F.col(one).alias("rep"), F.col("weight").alias("links")))
    counted = counted.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(inside.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")).union(across), scratch)
    joined = reps.select("rep", "doc_id", "place", "weight").join(roots.withColumnRenamed("node", "rep"), "rep", "left").join(counted, "rep", "left")
    joined = scratch.table(joined.withColumns({"root": F.coalesce("root", "rep"), "links": F.col("weight") - 1 + F.coalesce("links", F.lit(0))}), "joined")
    classes = joined.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.min("place").alias("leading"), F.count(F.lit(1)).alias("n"))
    classes = scratch.table(classes, "classes")
    facts = spread_join(joined.select("rep", "root", "weight", "links"), classes.drop("n"), "root", F.col("rep"), classes)
    facts = scratch.table(facts.select("rep", "weight", "class_id", "leading", "links"), "facts")
    scratch.drop("reps", "pairs", "groups", "inside", "across", "edges", "joined")
    found = spread_join(members, facts.drop("weight"), "rep", F.col("place"), facts.select("rep", F.col("weight").alias("n")), "left")
    return found.select(
        "place.doc_id", "place.text_hash", F.when(F.col("rep").isNull(), F.col("place.doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), (F.col("rep").isNull() | F.col("place").eqNullSafe(F.col("leading"))).alias("leads"),
    )


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


OP1_SQL = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w, regexp_extract_all(lower(coalesce(text, '')), '[^\s]+') AS v FROM documents
), worded AS (
  SELECT doc_id, CASE WHEN len(w) > 0 THEN w ELSE v END AS w FROM cut
), shingled AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM worded WHERE len(w) > 0)
), sized AS (
  SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingled a JOIN shingled b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sized m ON m.doc_id = a.doc_id JOIN sized n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n HAVING count(*) >= 0.8 * (m.n + n.n - count(*)) - 1e-9
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT r.a AS doc_id, min(r.b) AS class_id, (SELECT count(*) FROM links l WHERE l.a = r.a) AS n_links FROM reach r GROUP BY r.a
"""
