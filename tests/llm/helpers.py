"""Small documents with nulls, empty and long texts, ties, repeated rows and extra columns."""

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the quick brown fox jumps over a lazy dog while seven wizards quietly brew strong coffee near an old stone bridge at dawn".split()
#: Names that operators use inside; as extra columns they must not disturb them.
CLASHING = ("size", "rank", "key", "part", "words", "values", "rep", "range", "next", "last", "own", "edited", "h", "p", "x", "y", "good", "hash", "n", "language", "secrets", "digest", "row", "window", "start", "text_hash", "class_id")


def sentence(seed: int, n: int = 60) -> str:
    import random

    draw = random.Random(seed)
    return " ".join(f"{draw.choice(PROSE)}{draw.randint(0, 99)}" for _ in range(n))


def odd_documents(spark, extra: bool = True):
    """About 20 rows of awkward documents; no clean answer is expected, only a defined one."""
    texts = [None, "", " ", "\n\t", "a", "word", "!!! ???", "日本語 テキスト", "x" * 60_000, sentence(1), sentence(1), sentence(2, 5000), "ßİ\U0001f600 é", "a b c d e", "a b c d e"]
    rows = [(i, t, ["en", None, "de"][i % 3], [None, "s1", "s2"][i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, sentence(1), None, None, None), (None, None, None, None, None), (9, sentence(1), "en", "s1", 1), (9, sentence(1), "en", "s1", 1)]
    df = spark.createDataFrame(rows, SHAPE)
    if extra:
        for name in CLASHING:
            df = df.selectExpr("*", f"'{name}' AS `{name}`")
    return df
