"""Benchmark decontamination by SimHash windows, in DataFrame functions only.

A document's windows have the size, in words, of a benchmark item (of a shorter document, all its words). All windows
that hold one of the item's anchors, at any place, are laid: of an item's n shingles (runs of N words) the anchors are
the n - ceil(0.8 n) + 1 that the fewest items hold, one of which every window of similarity 0.8 must share. The windows'
words make a SimHash of BLOCKS blocks of 16 bits. Items are indexed by every value within NEAR bits of each of their
blocks, so that by the pigeonhole principle every window and item within RADIUS = BLOCKS * (NEAR + 1) - 1 bits meet in
a block. Pairs of one size within that radius are verified exactly: the weighted Jaccard similarity of the two bags of
shingles (weight: number of times) must reach THRESHOLD. Equal windows are fingerprinted, looked up and verified once.

Words are lower-cased runs of letters and digits. Defined results: null texts are empty; documents and items of under
N words hold and give no shingles and never match; repeated rows are one document in the result, other texts of one id
are documents of their own; a null id is a document id like others, and an item id too; items of one id are searched each by itself and are one item in
the result, of which the best window counts; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, read_table

N, THRESHOLD = 5, 0.8
BLOCKS, NEAR = 8, 3
RADIUS = BLOCKS * (NEAR + 1) - 1
WORD = r"[\p{L}\p{N}]+"
#: Texts of fewer words have their bits counted in lanes of 16 bits, four to a long; longer ones in lanes of 32.
LANE_WORDS = 1 << 15
#: Anchors (16 bytes each) that are sent to all executors at once; more are looked for block by block, a scan of the documents each.
BLOCK_ANCHORS = 1_000_000


def word_hashes(text: Column) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(words: Column) -> Column:
    """Hashes of the runs of N words of an array of word hashes, by position."""
    return F.when(F.size(words) < N, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(words) - (N - 1)), lambda i: F.xxhash64(F.slice(words, i, N)))
    )


def simhash(words: Column) -> Column:
    """Blocks of 16 bits, each bit set if more of the words' hashes have it set than not."""
    size = F.size(words)

    def counts(source: Column, lane: int) -> Column:
        """At k, how many hashes have bits k, k + lane, ... set, each number in a lane of a long."""
        ones = F.lit(sum(1 << low for low in range(0, 64, lane)))
        at = lambda w, k: F.call_function("shiftrightunsigned", w, k).bitwiseAND(ones)
        return F.transform(F.sequence(F.lit(0), F.lit(lane - 1)), lambda k: F.aggregate(source, F.lit(0).cast("long"), lambda s, w: s + at(w, k)))

    def block(counted: Column, quarter: int, lane: int) -> Column:
        first, shift = 16 * quarter % lane, 16 * quarter // lane * lane

        def bit(c: Column) -> Column:
            return (F.shiftrightunsigned(c, shift).bitwiseAND(F.lit(2**lane - 1)) * 2 > size).cast("int")

        return F.aggregate(F.slice(counted, first + 1, 16), F.lit(0), lambda s, c: s * 2 + bit(c))

    def blocks(lane: int) -> Column:
        both = F.transform(F.array(words, F.transform(words, lambda w: F.xxhash64(w))), lambda source: counts(source, lane))
        return F.transform(F.array(both), lambda c: F.array(*(block(c[b // 4], b % 4, lane) for b in range(BLOCKS))))[0]

    return F.when(size < LANE_WORDS, blocks(16)).otherwise(blocks(32))


def distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def bag(found: Column) -> Column:
    """An array as a set: equal elements are told apart by how many of them came before."""
    numbered = F.transform(found, lambda x, i: F.xxhash64(x, F.size(F.filter(F.slice(found, F.lit(1), i), lambda y: y == x))))
    return F.when(F.size(F.array_distinct(found)) == F.size(found), F.transform(found, lambda x: F.xxhash64(x, F.lit(0)))).otherwise(numbered)


def _items(items: DataFrame, text: str) -> DataFrame:
    """Distinct items, told apart by their words: item, words, item_shingles, n_words."""
    rows = items.select(word_hashes(F.col(text)).alias("words")).where(F.size("words") >= N).withColumn("item", item_key(F.col("words")))
    rows = rows.groupBy("item").agg(F.first("words").alias("words"))
    return rows.withColumn("item_shingles", shingles(F.col("words"))).withColumn("n_words", F.size("words"))


def item_key(words: Column) -> Column:
    return F.xxhash64(words)


def anchors(items: DataFrame) -> DataFrame:
    """anchor and n_words: the shingles that windows like an item can't all lack, without repeats."""
    each = items.select("item", "n_words", F.size("item_shingles").alias("n"), F.posexplode("item_shingles").alias("offset", "anchor"))
    common = each.groupBy("anchor").agg(F.count_distinct("item").alias("items"))
    rare = Window.partitionBy("item").orderBy("items", "anchor", "offset")
    needed = F.col("n") - F.ceil(F.lit(THRESHOLD) * F.col("n") - F.lit(1e-9)) + 1
    return each.join(common, "anchor").withColumn("rank", F.row_number().over(rare)).where(F.col("rank") <= needed).select("anchor", "n_words").distinct()


def starts(at: Column, n_words: Column, size: Column) -> Column:
    """Starts, each once, of the windows of n_words in a text of size words that hold one of the shingles at positions at."""
    last = F.greatest(F.lit(0), size - n_words)

    def added(sorted_at: Column, p: Column, i: Column) -> Column:
        following = F.when(i > 0, F.least(F.get(sorted_at, i - 1), last) + 1).otherwise(0)
        low, high = F.greatest(F.lit(0), p - n_words + N, following), F.least(p, last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return F.transform(F.array(F.sort_array(at)), lambda s: F.flatten(F.transform(s, lambda p, i: added(s, p, i))))[0]


def windows(docs: DataFrame, marks: DataFrame, blocks: int) -> DataFrame:
    """doc_id, text_hash, n_words, start (word, from 0), words of the windows that hold an anchor; docs has doc_id, text."""
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), word_hashes(F.col("text")).alias("words")).withColumn("found", shingles(F.col("words")))
    each = hashed.select("doc_id", "text_hash", "words", F.posexplode_outer("found").alias("pos", "anchor"))

    def laid(block: int) -> DataFrame:
        held = F.broadcast(marks.where(F.pmod(F.xxhash64("anchor"), F.lit(blocks)) == block))
        hits = each.join(held, "anchor").groupBy("doc_id", "text_hash", "n_words").agg(F.collect_set("pos").alias("at"), F.first("words").alias("words"))
        return hits.select("doc_id", "text_hash", "n_words", "words", F.explode(starts(F.col("at"), F.col("n_words"), F.size("words"))).alias("start"))

    every = reduce(DataFrame.union, map(laid, range(blocks)))
    return every.select("doc_id", "text_hash", "n_words", "start", F.slice("words", F.col("start") + 1, F.col("n_words")).alias("words"))


def contaminated(
    docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, text_hash (of the text, by which texts of one id are told apart), item_id, and of its best window start, n_words, hamming, similarity."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    named = items.select(F.col(item_id).alias("item_id"), word_hashes(F.col(item_text)).alias("words")).where(F.size("words") >= N)
    named = scratch.table(named.select("item_id", item_key(F.col("words")).alias("item")).distinct(), "named")
    items = scratch.table(_items(items, item_text), "items")
    marks = scratch.table(anchors(items), "anchors")
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = windows(docs, marks, max(-(-marks.count() // BLOCK_ANCHORS), 1)).withColumn("window", F.xxhash64("n_words", "words"))
    found = found.groupBy("doc_id", "text_hash", "window").agg(F.min("start").alias("start"), F.first("n_words").alias("n_words"), F.first("words").alias("words"))
    found = scratch.table(found, "windows")

    distinct = found.groupBy("window").agg(F.first("n_words").alias("n_words"), F.first("words").alias("words"))
    distinct = scratch.table(distinct.withColumn("bits", simhash(F.col("words"))), "fingerprints")
    indexed = scratch.table(items.withColumn("item_bits", simhash(F.col("words"))).select("item", "n_words", "item_bits", "item_shingles"), "index")
    masks = F.filter(F.sequence(F.lit(0), F.lit(65_535)), lambda m: F.bit_count(m) <= NEAR)
    values = indexed.select("item", "n_words", F.posexplode("item_bits").alias("block", "bits")).select("item", "n_words", "block", "bits", masks.alias("masks"))
    values = values.select("item", "n_words", "block", F.explode(F.transform("masks", lambda m: m.bitwiseXOR(F.col("bits")))).alias("value"))
    probes = distinct.select("window", "n_words", F.posexplode("bits").alias("block", "value"))
    # The index grows with the benchmark, and Spark would broadcast it by its size before the masks multiply it.
    pairs = probes.join(values.hint("merge"), ["n_words", "block", "value"]).select("window", "item", "n_words").distinct()
    near = pairs.join(distinct.select("window", "bits"), "window").join(indexed, ["item", "n_words"])
    near = near.withColumn("hamming", distance(F.col("bits"), F.col("item_bits"))).where(F.col("hamming") <= RADIUS).join(distinct.select("window", "words"), "window")
    bags = near.select("window", "item", "n_words", "hamming", bag(shingles(F.col("words"))).alias("a"), bag(F.col("item_shingles")).alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    checked = bags.withColumn("similarity", both / (F.size("a") + F.size("b") - both)).where(F.col("similarity") >= F.lit(THRESHOLD) - 1e-12)
    checked = scratch.table(checked.select("window", "item", "n_words", "hamming", "similarity"), "checked")
    best = F.max_by(F.struct("start", "n_words", "hamming", "similarity"), F.struct("similarity", -F.col("hamming"), -F.col("start"))).alias("best")
    found = found.select("doc_id", "text_hash", "window", "start").join(checked, "window").join(named, "item")
    return found.groupBy("doc_id", "text_hash", "item_id").agg(best).select("doc_id", "text_hash", "item_id", "best.*")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("start").cast("long").alias("start"), F.col("n_words").cast("long").alias("n_words"), "similarity")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark
), ds AS (
  SELECT doc_id, p, array_to_string(w[p + 1 : p + 5], ' ') AS s FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS p FROM d WHERE len(w) >= 5)
), its AS (
  SELECT item_id, n, array_to_string(w[p + 1 : p + 5], ' ') AS s, count(*) AS c FROM (SELECT item_id, w, len(w) AS n, unnest(range(len(w) - 4)) AS p FROM i WHERE len(w) >= 5) GROUP BY 1, 2, 3
), pairs AS (
  SELECT DISTINCT ds.doc_id, its.item_id, its.n FROM ds JOIN its ON ds.s = its.s
), windows AS (
  SELECT pairs.doc_id, item_id, n, len(w) AS words, unnest(range(greatest(len(w) - n, 0) + 1)) AS start FROM pairs JOIN d ON d.doc_id = pairs.doc_id
), counted AS (
  SELECT v.doc_id, v.item_id, v.n, v.start, least(v.n, v.words) - 4 AS size, ds.s, count(*) AS c
  FROM windows v JOIN ds ON ds.doc_id = v.doc_id AND ds.p BETWEEN v.start AND v.start + v.n - 5 GROUP BY ALL
), scored AS (
  SELECT k.doc_id, k.item_id, k.n, k.start, k.size, sum(least(k.c, its.c)) AS shared FROM counted k JOIN its ON its.item_id = k.item_id AND its.s = k.s GROUP BY ALL
), near AS (
  SELECT doc_id, item_id, n, start, shared / (size + n - 4 - shared) AS similarity FROM scored WHERE shared >= 0.8 * (size + n - 4 - shared) - 1e-9
)
SELECT doc_id, item_id, start, n AS n_words, similarity FROM near QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""
