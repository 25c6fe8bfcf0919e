"""Rows that every operator must cope with, and columns whose names clash with operators' own."""

from pyspark.sql import functions as F

PARAGRAPH = "The quick brown fox jumps over the lazy dog and runs to the river. It was a good day for all of them!\n"
LONG = " ".join(f"word{i % 997} and the other{i}" for i in range(30_000))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ROWS = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b\x0c\r ", "en", None, 7),
    (4, "one", None, "b", 3),
    (5, LONG, "en", "b", len(LONG)),
    (6, PARAGRAPH * 8, "en", "a", 0),
    (6, PARAGRAPH * 8, "en", "a", 0),
    (7, PARAGRAPH * 8, "xx", "c", 0),
    (None, PARAGRAPH + "a null id", "en", "c", 0),
    (8, "Ünïcödé ▁ 🎉 \x00 \u0301x <|endoftext|>\n\nReleased under the MIT License.\n", "de", "", 0),
    (9, "a\n\n\nb\n", None, None, None),
]
CLASHES = ["id", "fp", "w", "key", "share", "text_hash", "component", "part", "size", "chunk", "word", "copies", "quality",
           "conv", "msg", "up", "listed", "host", "fit", "token_ids_", "q_words", "kept_id", "mix_copy", "leaf", "level"]


def edge_docs(spark, clashing=False):
    df = spark.createDataFrame(ROWS, SCHEMA)
    if clashing:
        df = df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHES)])
    return df


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_rows(df):
    """Rows as tuples in a stable order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
