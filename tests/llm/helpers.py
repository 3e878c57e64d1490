"""Small tables with everything that operators must take: nulls, empty and long texts, ties, repeats, clashing names."""

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, n string, bitmap string, shard int, taken long"

AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (2, "the QUICK brown fox jumps over the lazy dog near the old river bank today"),
    (3, "the quick brown fox jumps over the lazy dog near the old river bank today again"),
    (4, None),
    (5, ""),
    (6, " \t\n "),
    (7, "one"),
    (8, "one"),
    (8, "one"),
    (9, "two words\x0bthree x   Äpfel \U0001f600 <s> \x00"),
    (None, "one"),
    (None, None),
    (10, "word " * 3000 + "end"),
    (11, "a" * 20000),
    (12, "completely different text that shares nothing with the others, not even five words in a row"),
]


def docs(spark: SparkSession, rows=None) -> DataFrame:
    """Rows of (doc_id, text[, source]) with columns of clashing names beside them."""
    rows = AWKWARD if rows is None else rows
    made = [(r[0], r[1], "en", (r[2] if len(r) > 2 else ("a" if (r[0] or 0) % 3 else None)), 1, 2, "n", "b", 3, 4) for r in rows]
    return spark.createDataFrame(made, DOCS)
