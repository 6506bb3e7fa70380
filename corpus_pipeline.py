"""A training corpus from raw documents: five stages over the operators of lakesync.llm.

Every stage takes (spark, docs, sf_dir), where docs has the columns of documents, and works on all rows of docs. All
but the last return the columns of documents. Documents without an id get a negative one from a hash of their text, so
that all stages can refer to them; a document is its id and its text, so several texts of one id are judged each by
itself; empty tables pass through as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync.llm import decontaminate, jaccard_join, language_id, mix_sources, secret_scan
from lakesync.llm.common import Scratch, read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text is in a language if its score is at least this share of what prose of its length has, less chance.
LEAST_SHARE = 0.6
#: Prose of n n-grams has a cosine of about sqrt(n / (n + SPREAD)) with its language, as measured; of D dimensions
#: chance has a standard deviation of 1 / sqrt(D), four of which are allowed for.
SPREAD, CHANCE = 190.0, 4 / language_id.DIMENSIONS**0.5


def _identified(docs: DataFrame) -> DataFrame:
    own = -F.abs(F.xxhash64("text") % F.lit(2**62)) - 1
    return docs.select(*COLUMNS).withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), own))


def _hashed(docs: DataFrame) -> DataFrame:
    return _identified(docs).withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: texts without letters go, and those that are less like any than prose of their length."""
    docs = _identified(docs)
    found = language_id.predict(docs, language_id.train(docs))
    usual = F.sqrt(F.col("language.grams") / (F.col("language.grams") + F.lit(SPREAD)))
    like = F.col("language.score") >= F.lit(LEAST_SHARE) * usual - F.lit(CHANCE)
    return found.where((F.col("language.lang") != language_id.UNKNOWN) & like).select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id, once."""
    docs = _hashed(docs)
    kept = jaccard_join.near_duplicates(docs).where("leads").select("doc_id", "text_hash").distinct()
    return docs.join(kept, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"]).select(*COLUMNS)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    docs = _hashed(docs)
    leaks = decontaminate.contaminated(docs, read_table(spark, sf_dir, "benchmark"))
    return docs.join(leaks.select("doc_id", "text_hash").distinct(), ["doc_id", "text_hash"], "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by marks."""
    return secret_scan.redact_secrets(_identified(docs)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with size, source_size, target, taken (words) and copies."""
    mixed = mix_sources.mix(_identified(docs), keep=("text", "lang", "n_chars")).where("taken > 0")
    return mixed.select(*COLUMNS, "size", "source_size", "target", "taken", F.expr("taken div size").alias("copies"))


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", keep_one_of_near_copies),
    ("decontaminate", remove_benchmark_leaks),
    ("secret_scan", redact_secrets),
    ("mix_sources", mix),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    scratch, docs = Scratch(spark, "pipeline"), read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.table(docs, name)
    return docs
