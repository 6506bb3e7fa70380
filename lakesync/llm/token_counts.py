"""Token counts that follow edits.

A text is cut into pre-tokens by the tokenizer's pattern and each is encoded on its own, so a text's count is a sum.
A document keeps a tree over its pre-tokens: blocks of their lengths and token counts, under a binary tree of sums. An
edit re-encodes from the last pre-token that can't see it (CONTEXT characters back) to the first old boundary behind
it, where the cuts of old and new text meet again; only the blocks in between and the sums above them change.

Defined results: a null text is empty and has no tokens; edits apply in order, positions are code points of the text
as the earlier edits left it and are clipped to it, a null start is the text's start, a null end the edit's start (so
that nothing goes), a null replacement deletes, a null edit is none; repeated rows are repeated results; an
empty table gives an empty result; other columns are ignored. Tokens are those of ordinary text: strings that look
like special tokens count as text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, small_batches

#: Fixed value: the pattern that cuts text for the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How far before its end + CONTEXT a match of the pattern may look: a contraction looks at two characters after an apostrophe, white space at one.
CONTEXT = 3
BLOCK = 64
KEPT_COUNTS = 500_000


class Counter:
    """Pre-tokens of a text and their token counts, with counts of pre-tokens kept up to a bound."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        import regex
        import tiktoken

        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.pattern, self.known = regex.compile(pattern), {}

    def counts(self, pieces: list[str]) -> list[int]:
        known, out = self.known, []
        if len(known) > KEPT_COUNTS:
            known.clear()
        for piece in pieces:
            n = known.get(piece)
            if n is None:
                n = known[piece] = len(self.encoding.encode_ordinary(piece))
            out.append(n)
        return out


@cache
def counter(ranks: bytes) -> Counter:
    return Counter(ranks)


class TokenTree:
    """The pre-tokens of one text: blocks of (lengths, counts), and sums of both over a binary tree of the blocks."""

    def __init__(self, by: Counter, text: str):
        pieces = by.pattern.findall(text)
        self.by, self.text, self.encoded = by, text, len(pieces)
        self._build(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)), np.array(by.counts(pieces), dtype=np.int64))

    @classmethod
    def restore(cls, by: Counter, text: str, state: bytes) -> TokenTree:
        tree = cls.__new__(cls)
        tree.by, tree.text, tree.encoded = by, text, 0
        lengths, counts = np.frombuffer(state, dtype=np.int32).astype(np.int64).reshape(2, -1)
        tree._build(lengths, counts)
        return tree

    def state(self) -> bytes:
        """The pre-tokens' lengths and counts, from which the tree can be restored beside its text."""
        return np.concatenate([np.concatenate([b[k] for b in self.blocks]) for k in (0, 1)]).astype(np.int32).tobytes()

    def _build(self, lengths: np.ndarray, counts: np.ndarray) -> None:
        self.blocks = [(lengths[k : k + BLOCK], counts[k : k + BLOCK]) for k in range(0, max(len(lengths), 1), BLOCK)]
        self._sum()

    def _sum(self) -> None:
        size = 1
        while size < len(self.blocks):
            size *= 2
        self.size, self.sums = size, np.zeros((2 * size, 2), dtype=np.int64)
        self.sums[size : size + len(self.blocks)] = [(b[0].sum(), b[1].sum()) for b in self.blocks]
        level = size
        while level > 1:
            level //= 2
            self.sums[level : 2 * level] = self.sums[2 * level : 4 * level : 2] + self.sums[2 * level + 1 : 4 * level : 2]

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def pieces(self) -> int:
        return sum(len(b[0]) for b in self.blocks)

    def _find(self, char: int) -> tuple[int, int]:
        """The block that holds a character (the last one for the end), and where the block starts."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if char - start >= self.sums[node, 0] and self.sums[node + 1, 0] > 0:
                start += int(self.sums[node, 0])
                node += 1
        return min(node - self.size, len(self.blocks) - 1), start

    def _replace(self, first: int, last: int, lengths: np.ndarray, counts: np.ndarray) -> None:
        """Put new pre-tokens into blocks first to last; sums above them are updated, the tree is laid out anew only if blocks overflow."""
        room = last - first + 1
        if len(lengths) > 2 * BLOCK * room:
            self.blocks[first : last + 1] = [(lengths[k : k + BLOCK], counts[k : k + BLOCK]) for k in range(0, len(lengths), BLOCK)]
            self._sum()
            return
        for k, (a, b) in enumerate(zip(np.array_split(lengths, room), np.array_split(counts, room), strict=True), first):
            self.blocks[k] = (a, b)
            node = k + self.size
            self.sums[node] = a.sum(), b.sum()
            while node > 1:
                node //= 2
                self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace the characters from start to end (exclusive)."""
        start = min(max(start, 0), len(self.text))
        end = min(max(end, start), len(self.text))
        self.text = self.text[:start] + replacement + self.text[end:]
        shift, clear = start + len(replacement) - end, start + len(replacement)
        first, at = self._find(max(start - CONTEXT, 0))
        if first and at > start - CONTEXT:  # an empty block: look from the one before
            first -= 1
            at -= int(self.sums[self.size + first, 0])
        kept = 0
        for n in self.blocks[first][0].tolist():
            if at + n + CONTEXT > start:
                break
            at, kept = at + n, kept + 1
        last, piece, old = first, kept, at  # old: a boundary of the old text, before piece number `piece` of block `last`
        fresh, new = [], at
        matches = self.by.pattern.finditer(self.text, new)
        while True:
            while old + shift < new or old < end:
                if piece < len(self.blocks[last][0]):
                    old, piece = old + int(self.blocks[last][0][piece]), piece + 1
                elif last + 1 < len(self.blocks):
                    last, piece = last + 1, 0
                else:
                    break
            if new >= clear and old >= end and old + shift == new:
                break
            match = next(matches, None)
            if match is None:
                break
            fresh.append(match[0])
            new = match.end()
        if new == len(self.text):
            last, piece = len(self.blocks) - 1, len(self.blocks[-1][0])
        self.encoded += len(fresh)
        parts = [[self.blocks[first][k][:kept], new_part, self.blocks[last][k][piece:]] for k, new_part in enumerate((np.fromiter(map(len, fresh), dtype=np.int64, count=len(fresh)), np.array(self.by.counts(fresh), dtype=np.int64)))]
        self._replace(first, last, *map(np.concatenate, parts))


EDITS = "array<struct<start:int,end:int,text:string>>"


def read_ranks(path: str = RANKS) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def count_tokens(docs: DataFrame, *, text: str = "text", ranks: str = RANKS, edits: str | None = None, state: str | None = None) -> DataFrame:
    """docs with a column counted: struct(n_tokens, n_pieces, edited_tokens, edited_pieces, encoded, edited_text, tree).

    edits names a column of type EDITS, applied in order; encoded is the number of pre-tokens that they made anew. state
    names a column with the tree of an earlier run over the same text, which is then not encoded again. The vocabulary
    is read on the driver and sent to the executors once (its size is fixed, under 1 MB).
    """
    spark = docs.sparkSession
    small_batches(spark)
    vocabulary = spark.sparkContext.broadcast(read_ranks(ranks))

    def count(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        by = counter(vocabulary.value)
        for texts, changes, states in batches:
            rows = []
            for one, todo, held in zip(texts, changes, states, strict=True):
                one = one or ""
                tree = TokenTree(by, one) if held is None else TokenTree.restore(by, one, held)
                tokens, pieces, tree.encoded = tree.tokens, tree.pieces, 0
                for change in todo if todo is not None else ():
                    tree.edit(int(change["at"]), int(change["until"]), change["new"])
                rows.append((tokens, pieces, tree.tokens, tree.pieces, tree.encoded, tree.text, tree.state()))
            yield pd.DataFrame(rows, columns=["n_tokens", "n_pieces", "edited_tokens", "edited_pieces", "encoded", "edited_text", "tree"])

    shape = "n_tokens long, n_pieces long, edited_tokens long, edited_pieces long, encoded long, edited_text string, tree binary"
    start = lambda e: F.coalesce(e["start"], F.lit(0))
    known = lambda e: F.struct(start(e).alias("at"), F.coalesce(e["end"], start(e)).alias("until"), F.coalesce(e["text"], F.lit("")).alias("new"))
    changes = F.transform(F.filter(F.col(edits).cast(EDITS) if edits else F.lit(None).cast(EDITS), lambda e: e.isNotNull()), known)
    held = F.col(state) if state else F.lit(None).cast("binary")
    return docs.withColumn("counted", F.pandas_udf(count, shape)(F.col(text).cast("string"), changes, held))


def sample_edits(text: str = "text"):
    """Three edits for every text: an insertion after a third, a deletion of up to 20 characters at half, a replacement of the last 7."""
    n = F.coalesce(F.length(text), F.lit(0))
    third, half = F.floor(n / 3).cast("int"), F.floor(n / 2).cast("int") + 8
    edit = lambda a, b, new: F.struct(a.alias("start"), b.alias("end"), F.lit(new).alias("text"))
    return F.array(edit(third, third, " it's 42"), edit(half, half + 20, ""), edit(n - 19, n - 12, "..\n\n  end")).cast(EDITS)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("edits", sample_edits())
    counted = count_tokens(docs, edits="edits")
    return counted.select("doc_id", *(F.col(f"counted.{name}").alias(name) for name in ("n_tokens", "n_pieces", "edited_tokens", "edited_pieces", "encoded")))
