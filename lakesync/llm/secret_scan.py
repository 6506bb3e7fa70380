"""Secret scans: an Aho-Corasick pass finds keywords, regular expressions are anchored at their hits, checksums decide.

Kinds assign, access and hex follow fixed grammars (see GRAMMAR); matches of one kind are leftmost and do not overlap,
and one that fails its length test is dropped after it has used up its characters. Further kinds have a checksum or
structure of their own inside the token: github and npm tokens end in a CRC-32 in base 62, and a jwt's first part decodes
to a JSON object with an "alg" (one nested deeper than the parser goes is none). A hexadecimal run has no keyword to
look for; its expression matches whole runs only. Every character is looked at a bounded number of times, whatever the text.

Defined results: a null text counts as empty and has no spans; positions are code points, end exclusive; every row
gives one row, repeated ones too; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, small_batches

# The grammars of the base kinds, the keywords that begin them, and prefixes of tokens with a checksum.
GRAMMAR = {
    "assign": r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KINDS = ("assign", "access", "hex", "github", "npm", "jwt")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24

_ASSIGN = re.compile(GRAMMAR["assign"], re.I | re.A)
_ACCESS = re.compile(GRAMMAR["access"])
_HEX = re.compile(rf"[0-9a-f]{{{MIN_HEX},}}")
_CHECKED = re.compile(r"(gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
_JWT_RUN = re.compile(r"[A-Za-z0-9_-]+")


@cache
def _keywords():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word in ASSIGN_WORDS:
        found.add_word(word, ("assign", len(word)))
    found.add_word("akia", ("access", 4))
    found.add_word("eyj", ("jwt", 3))
    for word in CHECKED_PREFIXES:
        found.add_word(word, ("checked", len(word)))
    found.make_automaton()
    return found


def base62(number: int, width: int) -> str:
    """A number in base 62, padded with zeros."""
    digits = ""
    while number:
        number, rest = divmod(number, 62)
        digits = BASE62[rest] + digits
    return digits.rjust(width, "0")


def _decodes(header: str) -> bool:
    try:
        found = json.loads(base64.urlsafe_b64decode(header + "=" * (-len(header) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return False
    return isinstance(found, dict) and "alg" in found


def scan(text: str | None) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) of one text, by start and then kind in the order of KINDS."""
    if not text:
        return []
    spans, ends = [], {"assign": 0, "access": 0, "jwt": 0, "checked": 0}
    plain = text.encode("ascii", "replace").decode("ascii").lower()  # one character for each code point
    hits = sorted((at - size + 1, kind) for at, (kind, size) in _keywords().iter(plain))
    for start, kind in hits:
        if start < ends[kind]:
            continue
        if kind == "assign" and (m := _ASSIGN.match(text, start)):
            ends[kind] = m.end()
            if m.end(2) - m.start(2) >= MIN_ASSIGNED:
                spans.append((start, m.end(), kind))
        elif kind == "access" and (m := _ACCESS.match(text, start)):
            ends[kind] = m.end()
            if m.end() - start >= MIN_ACCESS:
                spans.append((start, m.end(), kind))
        elif kind == "checked" and (m := _CHECKED.match(text, start)):
            ends[kind] = m.end()
            if base62(zlib.crc32(m[2].encode()), 6) == m[3]:
                spans.append((start, m.end(), "npm" if m[1] == "npm" else "github"))
        elif kind == "jwt" and text.startswith("eyJ", start):
            m = _JWT.match(text, start)
            ends[kind] = m.end() if m else _JWT_RUN.match(text, start).end()  # where one fails, all others in its first part do
            if m and _decodes(m[1]):
                spans.append((start, m.end(), kind))
    spans += ((m.start(), m.end(), "hex") for m in _HEX.finditer(text))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _scan_all(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([[{"start": a, "end": b, "kind": k} for a, b, k in scan(t)] for t in texts])


_SPANS = "array<struct<start:int,end:int,kind:string>>"


def scan_secrets(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """docs with a column secrets: array of struct(start, end, kind)."""
    small_batches(docs.sparkSession)
    return docs.withColumn("secrets", F.pandas_udf(_scan_all, _SPANS)(F.col(text).cast("string")))


def _redact_all(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for texts, marks in batches:
        out = []
        for text in texts:
            end, pieces = 0, []
            for a, b, kind in scan(text):
                if b > end:
                    if a >= end:
                        pieces += [text[end:a], marks.iloc[0].replace("{kind}", kind)]
                    end = b
            out.append("".join([*pieces, text[end:]]) if text is not None else None)
        yield pd.Series(out, dtype=object)


def redact_secrets(docs: DataFrame, *, text: str = "text", mark: str = "[redacted {kind}]") -> DataFrame:
    """docs with every span in the text replaced by a mark (which no grammar matches); overlapping spans get one mark, a null text stays null."""
    small_batches(docs.sparkSession)
    return docs.withColumn(text, F.pandas_udf(_redact_all, "string")(F.col(text).cast("string"), F.lit(mark)))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    return docs.select(
        "doc_id", *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in GRAMMAR),
        F.sha2(named(of(*GRAMMAR)).cast("binary"), 256).alias("base_sha256"), named(F.col("secrets")).alias("spans"),
    )


_ANY_CASE = {"assign": "(" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in ("password", "passwd", "secret", "token", "api_?key")) + ")" + GRAMMAR["assign"].partition(")")[2]}
_FOUND = {
    **GRAMMAR, **_ANY_CASE, "hex": _HEX.pattern, "checked": r"(?:gh[pousr]|npm)_[A-Za-z0-9]+", "jwt": _JWT.pattern,
}


def _matches(kind: str) -> str:
    """SQL for the matches of a kind's pattern: the text between them says where they are."""
    pattern = _FOUND[kind].replace("'", "''")
    return f"""
  SELECT doc_id, '{kind}' AS kind, m, len(m) AS size, list_sum(list_transform(gaps[1:i], lambda g: len(g))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda g: len(g))), 0) AS start
  FROM (SELECT doc_id, gaps, found, unnest(found) AS m, unnest(range(1, len(found) + 1)) AS i
    FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}', 0) AS found FROM d))"""


OP2_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), found AS ({" UNION ALL ".join(_matches(kind) for kind in _FOUND)}
), crc AS (
  SELECT *, CASE WHEN kind = 'checked' THEN xor(4294967295, list_reduce(list_transform(range(30), lambda k: ascii(substr(m, size - 35 + k, 1))::BIGINT),
    lambda c, b: list_reduce(range(8), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), 4294967295::BIGINT)) END AS crc
  FROM found WHERE kind <> 'checked' OR size = position('_' in m) + 36
), kept AS (
  SELECT doc_id, start, start + size AS finish, CASE WHEN kind = 'checked' THEN (CASE WHEN starts_with(m, 'npm') THEN 'npm' ELSE 'github' END) ELSE kind END AS kind
  FROM crc WHERE CASE kind
    WHEN 'assign' THEN len(regexp_extract(m, '{_FOUND["assign"].replace("'", "''")}', 2)) >= {MIN_ASSIGNED} WHEN 'access' THEN size >= {MIN_ACCESS} WHEN 'hex' THEN size >= {MIN_HEX}
    WHEN 'checked' THEN right(m, 6) = array_to_string(list_transform([5, 4, 3, 2, 1, 0], lambda k: substr('{BASE62}', ((crc // (62 ** k)::BIGINT) % 62)::INT + 1, 1)), '')
    ELSE coalesce(TRY(json_exists(decode(from_base64(rpad(translate(split_part(m, '.', 1), '-_', '+/'), ((len(split_part(m, '.', 1)) + 3) // 4 * 4)::INT, '='))), '$.alg')), false) END
), listed AS (
  SELECT doc_id, kind, start, kind || ':' || start || ':' || finish AS span, list_position({list(KINDS)}, kind) AS rank FROM kept
)
SELECT d.doc_id, count(start) FILTER (kind = 'assign') AS n_assign, count(start) FILTER (kind = 'access') AS n_access, count(start) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank <= {len(GRAMMAR)}), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY start, rank), '') AS spans
FROM d LEFT JOIN listed ON listed.doc_id = d.doc_id GROUP BY d.doc_id
"""
