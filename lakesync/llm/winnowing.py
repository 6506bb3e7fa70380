"""Document fingerprints by winnowing, in DataFrame functions only.

A text is lower-cased and cut into tokens (runs of letters and digits, longer ones in pieces of PIECE characters;
ideographs and kana one by one; a text without any is one token). Every run of k tokens has a rolling hash, the
exclusive or of its tokens' hashes, each rotated as often as tokens follow. Hashes roll over the whole text at once by
doubling: that of a run is rolled on from those of its two halves, so no run's tokens are read again. Minima of w
consecutive hashes double in the same way; of each w hashes the smallest is kept, the rightmost of equal ones, with its
position. Two texts that share a run of at least w + k - 1 tokens share a fingerprint, and nothing shorter than k
tokens can match.

Defined results: a null text is empty; an empty text has no fingerprint and is like only another empty one; a text
under k tokens has one fingerprint of them all, one under w + k - 1 tokens the smallest of its hashes. The next
document is by descending id (null last), equal ids by a hash of the text; after the last comes the first, and a
single document is its own next. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table

K, W, PIECE = 5, 8, 16
TOKEN = rf"[\p{{IsHan}}\p{{IsHiragana}}\p{{IsKatakana}}]|[\p{{L}}\p{{N}}&&[^\p{{IsHan}}\p{{IsHiragana}}\p{{IsKatakana}}]]{{1,{PIECE}}}"
#: Bits of a hash; the sign is left out.
MASK = (1 << 63) - 1
#: Ranges of ids for each shuffle partition.
RANGES_PER_PARTITION = 4


def _let(value: Column, then) -> Column:
    """then(value), with value computed once."""
    return F.transform(F.array(value), then)[0]


def _doubled(start: Column, length: int, join) -> Column:
    """From what each place holds alone, what each run of `length` places holds: join(of the run's first part, of its second part, places of the second).

    Runs of 1, 2, 4, … places are joined from two runs of half as many, and those that `length` is the sum of from each other.
    """

    def joined(a: Column, size_a: int, b: Column, size_b: int) -> Column:
        fits = F.size(b) - size_a
        return F.when(fits <= 0, F.slice(a, 1, 0)).otherwise(F.transform(F.slice(a, F.lit(1), fits), lambda x, i: join(x, F.get(b, i + size_a), size_b)))

    def grown(double: Column, places: int, done: Column | None, have: int) -> Column:
        """double holds runs of `places`, done those of `have` places that come after what is still to be joined."""

        def on(whole: Column, now: int) -> Column:
            if now == length:
                return whole
            return _let(joined(double, places, double, places), lambda d: grown(d, 2 * places, whole, now))

        if not length & places:
            return _let(joined(double, places, double, places), lambda d: grown(d, 2 * places, done, have))
        if done is None:
            return on(double, places)
        return _let(joined(double, places, done, have), lambda whole: on(whole, have + places))

    return _let(start, lambda d: grown(d, 1, None, 0))


def _rolled(first: Column, second: Column, places: int) -> Column:
    return F.shiftleft(first, places % 64).bitwiseOR(F.shiftrightunsigned(first, 64 - places % 64)).bitwiseXOR(second)


def gram_hashes(hashed: Column, k: int) -> Column:
    """Rolling hashes of the runs of k tokens of an array of token hashes, one of all tokens where they are fewer; none of none."""
    whole = F.aggregate(hashed, F.lit(0).cast("long"), lambda s, h: _rolled(s, h, 1))
    runs = F.when(F.size(hashed) == 0, hashed).when(F.size(hashed) <= k, F.array(whole)).otherwise(_doubled(hashed, k, _rolled))
    return F.transform(runs, lambda x: x.bitwiseAND(F.lit(MASK)))


def minima(hashes: Column, w: int) -> Column:
    """Places (from 0) of the smallest of each w consecutive hashes, the rightmost of equal ones, each place once and in order."""
    better = lambda a, b: F.when(F.get(hashes, b) <= F.get(hashes, a), b).otherwise(a)
    places = F.transform(hashes, lambda _, i: i)
    few = F.array(F.aggregate(places, F.lit(0), lambda a, b: better(a, b)))
    return F.when(F.size(hashes) == 0, places).when(F.size(hashes) <= w, few).otherwise(F.array_distinct(_doubled(places, w, lambda a, b, _: better(a, b))))


def winnow(text: Column, k: int = K, w: int = W) -> Column:
    """The fingerprint of a text: array<struct<hash: long, pos: int>> by position, the number of the run's first token (from 1)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    tokens = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    tokens = _let(tokens, lambda t: F.when((F.size(t) == 0) & (text != ""), F.array(text)).otherwise(t))
    kept = lambda g: F.transform(minima(g, w), lambda i: F.struct(F.get(g, i).alias("hash"), (i + 1).alias("pos")))
    return _let(_let(F.transform(tokens, lambda t: F.xxhash64(t)), lambda h: gram_hashes(h, k)), kept)


def hashes(fingerprint: Column) -> Column:
    return F.array_distinct(fingerprint["hash"])


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes, 1 for two empty ones."""
    both = lambda n: F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(n / (F.size(a) + F.size(b) - n))
    return _let(F.size(F.array_intersect(a, b)), both)


def written(fingerprint: Column) -> Column:
    """The fingerprint as text: hash in hexadecimal digits, colon and position, joined by commas."""
    return F.array_join(F.transform(fingerprint, lambda x: F.concat(F.lower(F.hex(x["hash"])), F.lit(":"), x["pos"].cast("string"))), ",")


def fingerprints(docs: DataFrame, *, text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """docs with a column fingerprint: array of struct(hash, pos)."""
    return docs.withColumn("fingerprint", winnow(F.col(text), k, w))


def _ranges(docs: DataFrame, bounds: list[int]) -> Column:
    """The range of an id, ascending as ids descend; rows without an id follow, dealt by their text's hash.

    Which range an id is in is looked up in two steps, among every width-th bound and then among those between.
    """
    if not bounds:
        inside = F.lit(0)
    else:
        width = max(1, round(len(bounds) ** 0.5))
        coarse, every = F.array(*[F.lit(b) for b in bounds[width - 1 :: width]]) if len(bounds) >= width else F.array(), F.array(*[F.lit(b) for b in bounds])
        above = lambda bs: F.size(F.filter(bs, lambda b: b > F.col("doc_id")))
        inside = _let(above(coarse) * F.lit(width), lambda start: start + above(F.slice(every, start + 1, width)))
    return F.when(F.col("doc_id").isNull(), F.shiftright("text_hash", 60).cast("int") + F.lit(len(bounds) + 9)).otherwise(inside)


def with_next(docs: DataFrame, extra: dict[str, Column]) -> DataFrame:
    """doc_id, text, next_start (as much of the next document as half of this one is long), own columns extra and next_<name> of each.

    Ids are cut into ranges of about equal numbers of rows; a range's last document finds its next among the ranges'
    first ones, of which the driver holds the ids.
    """
    spark = docs.sparkSession
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    n = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)]).alias("cuts")).first()["cuts"]
    docs = docs.withColumn("range", _ranges(docs, sorted(set(cuts or []), reverse=True)))
    firsts = docs.groupBy("range").agg(F.max(F.struct("doc_id", F.bitwise_not("text_hash").alias("order"))).alias("first")).orderBy("range").collect()
    heads = [(firsts[i - 1]["range"], r["first"]["doc_id"], ~r["first"]["order"]) for i, r in enumerate(firsts)]
    heads = spark.createDataFrame(heads, "head_range int, head_id long, head_hash long")
    head = (
        docs.select("doc_id", "text", "text_hash").join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("text_hash") == F.col("head_hash")))
        .groupBy("head_range").agg(F.first("text").alias("text"))
    )
    head = head.select("head_range", F.col("text").alias("head_text"), *(column.alias(f"head_{name}") for name, column in extra.items()))
    order = Window.partitionBy("range").orderBy(F.col("doc_id").desc_nulls_last(), "text_hash", "text")
    half = F.floor(F.length("text") / 2).cast("int")
    rows = docs.withColumn("next", F.lead(F.struct("text")).over(order)).withColumns({"last": F.col("next").isNull(), "next_start": F.substring(F.col("next.text"), F.lit(1), half)}).drop("next")
    rows = rows.withColumns(extra)
    rows = rows.withColumns({f"next_{name}": F.lead(name).over(order) for name in extra})
    rows = rows.join(head, F.col("range") == F.col("head_range"))
    return rows.select(
        "doc_id", "text", F.when(F.col("last"), F.substring("head_text", F.lit(1), half)).otherwise(F.col("next_start")).alias("next_start"), *extra,
        *(F.when(F.col("last"), F.col(f"head_{name}")).otherwise(F.col(f"next_{name}")).alias(f"next_{name}") for name in extra),
    )


def fingerprint_edits(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of each text and of its edited text, whose second half is the start of the next document.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = with_next(docs, {"own": winnow(F.col("text"), k, w)})
    n = F.length("text")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - F.floor(n / 2).cast("int")), "next_start"))
    rows = rows.withColumn("edited_own", winnow(F.col("edited"), k, w)).withColumn("hashes", hashes(F.col("own")))
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("own")).alias("fingerprint"), written(F.col("edited_own")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), hashes(F.col("edited_own"))).alias("near_edited"), likeness(F.col("hashes"), hashes(F.col("next_own"))).alias("near_next"),
    )


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(read_table(spark, sf_dir, "documents"))
