"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn by its code point. The vector of an n-gram binds (multiplies) the
vectors of its letters, each permuted (rotated) as often as letters follow. A text's vector bundles (adds) those of
its n-grams, a language's prototype those of its training texts. The language of a text is the one whose prototype
has the highest cosine with the text's vector.

Texts are lower-cased; anything but letters counts as a single space. Prototypes are sums of whole numbers, so reruns
agree. Defined results: a null text, one without letters, and any text when nothing was learned is `und` with score
0; equal cosines go to the smaller language name; rows without id or language are not learned from; repeated rows are
repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, small_batches

DIMENSIONS, N, SEED = 1024, 3, 20_240_101
#: Documents whose vectors are made together, distinct n-grams of them in one matrix product, and n-gram vectors kept by a worker (1 KB each).
TOGETHER, GRAMS, KEPT = 64, 4096, 100_000
UNKNOWN = "und"
_SPACE = 32


@cache
def _is_letter() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@cache
def letter_vector(code: int) -> np.ndarray:
    return np.random.default_rng([SEED, code]).choice(np.array([-1, 1], dtype=np.int8), DIMENSIONS)


def gram_vector(gram: int) -> np.ndarray:
    """The vector of an n-gram, whose code points are the number's digits to base 2^21."""
    out = np.ones(DIMENSIONS, dtype=np.int8)
    for k in range(N):
        out = out * np.roll(letter_vector(gram >> 21 * k & 0x1FFFFF), k)
    return out


class GramVectors:
    """Vectors of n-grams, kept up to a bound and then started anew."""

    def __init__(self) -> None:
        self.rows: dict[int, int] = {}
        self.table = np.empty((1024, DIMENSIONS), dtype=np.int8)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        if len(self.rows) > KEPT:
            self.rows.clear()
        out = []
        for gram in grams.tolist():
            row = self.rows.get(gram)
            if row is None:
                row = self.rows[gram] = len(self.rows)
                if row == len(self.table):
                    self.table = np.concatenate([self.table, np.empty_like(self.table)])
                self.table[row] = gram_vector(gram)
            out.append(row)
        return self.table[out]


_vectors = cache(GramVectors)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text and how often each occurs; none for a text without letters."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _is_letter()[codes]
    if not letter.any():
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    codes = np.where(letter, codes, _SPACE)
    codes = codes[letter | np.append(True, letter[:-1])]
    codes = np.concatenate([[_SPACE] * (N - 2), codes, [_SPACE] * (N - 1)]).astype(np.int64)
    out = np.zeros(len(codes) - N + 1, dtype=np.int64)
    for k in range(N):
        out = out << 21 | codes[k : len(codes) - N + 1 + k]
    return np.unique(out, return_counts=True)


def _together(counted: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of some texts and, sorted by n-gram, each occurrence's place among them, text and number."""
    every = np.concatenate([g for g, _ in counted])
    text, times = np.repeat(np.arange(len(counted)), [len(g) for g, _ in counted]), np.concatenate([n for _, n in counted])
    found, at = np.unique(every, return_inverse=True)
    order = np.argsort(at, kind="stable")
    return found, at[order], text[order], times[order]


def bundle(counted: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The vectors of some texts, from their n-grams: one row each. At most GRAMS n-grams' vectors are in memory at once."""
    found, at, text, times = _together(counted)
    out = np.zeros((len(counted), DIMENSIONS), dtype=np.float64)
    for start in range(0, len(found), GRAMS):
        a, b = np.searchsorted(at, [start, start + GRAMS])
        counts = np.zeros((len(counted), min(GRAMS, len(found) - start)), dtype=np.float32)
        counts[text[a:b], at[a:b] - start] = times[a:b]
        out += counts @ _vectors()(found[start : start + GRAMS]).astype(np.float32)
    return out


def _add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each language the sum of this task's text vectors."""
    sums: dict[str, np.ndarray] = {}
    for rows in batches:
        for lang, texts in rows.groupby("lang")["text"]:
            total = sums.setdefault(lang, np.zeros(DIMENSIONS, dtype=np.int64))
            for k in range(0, len(texts), TOGETHER):
                found, at, _, times = _together([grams(t) for t in texts.iloc[k : k + TOGETHER]])
                n = np.bincount(at, times, len(found)).astype(np.int64)
                for start in range(0, len(found), GRAMS):
                    total += n[start : start + GRAMS] @ _vectors()(found[start : start + GRAMS]).astype(np.int64)
    if sums:
        yield pd.DataFrame({"lang": list(sums), "vector": [v.tolist() for v in sums.values()]})


def _sum(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"lang": rows["lang"].iloc[:1], "vector": [np.sum(np.stack(rows["vector"].to_list()), axis=0)]})


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Prototypes by language, from all rows with a text and a language. The driver gets one vector of each language."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    shape = "lang string, vector array<bigint>"
    some = rows.mapInPandas(_add, shape).withColumn("part", F.spark_partition_id() % 64).groupBy("lang", "part").applyInPandas(_sum, shape)
    sums = some.groupBy("lang").applyInPandas(_sum, shape).collect()
    return {r["lang"]: np.array(r["vector"], dtype=np.float64) for r in sorted(sums, key=lambda r: r["lang"]) if any(r["vector"])}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], *, text: str = "text") -> DataFrame:
    """docs with a column language: struct(lang, score, grams), score being the cosine (0 if it is negative), grams the text's number of n-grams."""
    small_batches(docs.sparkSession)
    names = list(prototypes)
    unit = np.stack([v / np.linalg.norm(v) for v in prototypes.values()]).astype(np.float32) if names else None

    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            langs, scores, sizes = [], [], []
            for k in range(0, len(texts), TOGETHER):
                counted = [grams(t) for t in texts.iloc[k : k + TOGETHER]]
                if unit is None:
                    best, cosines = [0] * len(counted), [0.0] * len(counted)
                else:
                    vectors = bundle(counted)
                    near = vectors @ unit.T / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
                    best, cosines = near.argmax(axis=1), near.max(axis=1)
                for (found, times), b, c in zip(counted, best, cosines, strict=True):
                    sizes.append(int(times.sum()))
                    known = len(found) > 0 and names
                    langs.append(names[b] if known else UNKNOWN)
                    scores.append(min(max(float(c), 0.0), 1.0) if known else 0.0)
            yield pd.DataFrame({"lang": langs, "score": scores, "grams": sizes})

    return docs.withColumn("language", F.pandas_udf(guess, "lang string, score double, grams long")(F.col(text).cast("string")))


def fold(doc_id: Column) -> Column:
    """crc32 of an id as text, modulo 4; documents of fold 2 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    prototypes = train(docs.where(fold(F.col("doc_id")) != 2))
    found = predict(docs.select("doc_id", "text"), prototypes)
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))
