"""Quality classifier with hierarchical empirical-Bayes priors of hosts and paths.

A logistic classifier over shape features of the text (shares of character classes, repeated words and lines, word
lengths) gives each document's evidence: its log odds less the log odds of the labelled sample. Expected good documents
are summed by path, host and over all (a label counts as what it says, any other document as its classifier
probability). Each host's rate is shrunk to the global one and each path's to its host's; how far is estimated by
moments from how much the rates differ beyond chance. A document's quality is its evidence on top of the log odds of
its path without itself.

The classifier is fitted on at most SAMPLE labelled documents, those with the smallest hashes of their id; all else covers all rows.
Defined results: a null text is empty; null hosts and paths are a host and a path of their own; several labels of one
id count by their mean, null labels not at all; without labels of both kinds evidence is 0 and quality the prior 0.5;
repeated rows are documents of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read_table, small_batches, spread_join

SAMPLE = 20_000
FEATURES = ("log_chars", "lower", "upper", "digit", "space", "symbol", "word_length", "distinct_words", "top_word", "same_word_again", "distinct_lines", "words_with_symbol_end")
RIDGE, STEPS = 1.0, 30
#: A prior counts at most as many documents, at least as many.
LIGHTEST, HEAVIEST = 1.0, 1e6


@cache
def _classes() -> np.ndarray:
    """Of each code point: 0 lower-case or uncased letter, 1 upper-case letter, 2 digit, 3 white space, 4 other."""
    kind = lambda c: 1 if c.isupper() else 0 if c.isalpha() else 2 if c.isnumeric() else 3 if c.isspace() else 4
    return np.array([kind(chr(c)) for c in range(0x110000)], dtype=np.int8)


def features(text: str | None) -> list[float]:
    text = text or ""
    shares = np.bincount(_classes()[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)], minlength=5) / max(len(text), 1)
    words, lines = text.split(), [line for line in text.split("\n") if line.strip()]
    n = max(len(words), 1)
    return [
        float(np.log1p(len(text))), *shares.tolist(), sum(map(len, words)) / n, len(set(words)) / n, max(Counter(words).values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, len(set(lines)) / max(len(lines), 1), sum(not w[-1].isalnum() for w in words) / n,
    ]


def _features(texts: pd.Series) -> pd.Series:
    return pd.Series([features(t) for t in texts], dtype=object)


class Logistic:
    """Ridge logistic regression on standardised features, by Newton's steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        z = np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale])
        w, ridge = np.zeros(z.shape[1]), np.diag([0.0] + [RIDGE] * x.shape[1])
        for _ in range(STEPS):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            slope = z.T @ (y - p) - ridge @ w
            w = w + np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge + 1e-6 * np.eye(len(w)), slope)
        self.weights = w

    def evidence(self, x: np.ndarray, base: float) -> np.ndarray:
        """Log odds less those of the sample, within 30 either way."""
        return np.clip(self.weights[0] + (x - self.mean) / self.scale @ self.weights[1:] - base, -30, 30)


def logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def strength(groups: DataFrame, n: Column, k: Column, rate: Column) -> Column:
    """How many documents the prior of groups (n documents, k good ones, expected at rate) is worth, by moments: an aggregate."""
    noise = rate * (1 - rate)
    excess = F.sum(n * F.pow(k / n - rate, F.lit(2))) - F.sum(noise) * (1 - 1 / F.greatest(F.count(F.lit(1)), F.lit(1)))
    spread = excess / F.greatest(F.sum(n) - F.sum(n * n) / F.greatest(F.sum(n), F.lit(1.0)), F.lit(1e-9))
    return F.when(spread > 0, F.least(F.greatest(F.avg(noise) / spread - 1, F.lit(LIGHTEST)), F.lit(HEAVIEST))).otherwise(F.lit(HEAVIEST))


def classify(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", host: Column, path: Column, label: str = "quality") -> DataFrame:
    """One row per document: doc_id, host, path, evidence, host_rate, path_rate, quality (0 to 1), keep (quality of 0.5 or more)."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "quality")
    name = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), name(host).alias("h"), name(path).alias("p"), F.pandas_udf(_features, "array<double>")(F.col(text).cast("string")).alias("x"))
    said = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("y")).dropna().groupBy("doc_id").agg(F.avg("y").alias("y"))
    rows = scratch.table(rows.join(said, "doc_id", "left"), "features")
    drawn = rows.where("y is not null").select(F.xxhash64("doc_id").alias("draw"), F.col("doc_id").cast("string").alias("id"), "x", "y")
    sample = drawn.orderBy("draw", "id", "x").limit(SAMPLE).collect()
    x, y = np.array([r["x"] for r in sample]), np.array([r["y"] for r in sample])
    if len(y) and 0 < y.mean() < 1:
        base = float(np.log(y.mean() / (1 - y.mean())))
        model = Logistic(x, y)
        weigh = F.pandas_udf(lambda xs: pd.Series(model.evidence(np.stack(xs.to_list()), base) if len(xs) else [], dtype="float64"), "double")
        rows = rows.withColumn("evidence", weigh("x"))
    else:
        base, rows = 0.0, rows.withColumn("evidence", F.lit(0.0))
    rows = rows.withColumn("good", F.coalesce("y", sigmoid(F.col("evidence") + F.lit(base)))).drop("x", "y")
    rows = scratch.table(rows, "evidence")
    scratch.drop("features")

    paths = rows.groupBy("h", "p").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("good").alias("k"))
    paths = scratch.table(paths, "paths")
    hosts = paths.groupBy("h").agg(F.sum("n").alias("host_n"), F.sum("k").alias("host_k"))
    whole = hosts.agg((F.sum("host_k") / F.sum("host_n")).alias("rate")).first()["rate"]
    rate = F.lit(float(whole if whole is not None else 0.5))
    a = F.lit(float(hosts.agg(strength(hosts, F.col("host_n"), F.col("host_k"), rate).alias("a")).first()["a"]))
    hosts = scratch.table(hosts.withColumn("host_rate", (F.col("host_k") + a * rate) / (F.col("host_n") + a)), "hosts")
    paths = paths.join(hosts, "h")
    b = F.lit(float(paths.agg(strength(paths, F.col("n"), F.col("k"), F.col("host_rate")).alias("b")).first()["b"]))
    sites = scratch.table(paths.withColumn("path_rate", (F.col("k") + b * F.col("host_rate")) / (F.col("n") + b)), "sites")

    others_host = (F.col("host_k") - F.col("good") + a * rate) / (F.col("host_n") - 1 + a)
    others = (F.col("k") - F.col("good") + b * others_host) / (F.col("n") - 1 + b)
    site = F.struct("h", "p").alias("site")
    held = sites.select(site, "k", "n", "host_k", "host_n", "host_rate", "path_rate")
    joined = spread_join(rows.withColumn("site", site).drop("h", "p"), held, "site", F.col("doc_id"), sites.select(site, F.col("n").cast("long").alias("n")))
    scored = joined.withColumn("quality", sigmoid(F.col("evidence") + logit(others)))
    return scored.select("doc_id", "host", "path", "evidence", "host_rate", "path_rate", "quality", (F.col("quality") >= 0.5).alias("keep"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source (host) and language within it (path)."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return classify(docs, labels, host=F.col("source"), path=F.concat_ws("/", "source", "lang")).drop("host", "path")
