"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark, extra: bool = True):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    long_text = "alpha beta gamma delta epsilon " * 4000
    rows = [
        (1, "the cat sat on the mat and looked at the dog", "en", "a"), (2, "the cat sat on the mat and looked at the dog", "en", "b"),
        (3, None, "en", "a"), (4, "", None, "a"), (5, "   \n\t ", "de", None), (6, long_text, None, "b"),
        (7, "x" * 50_000, "en", "a"), (None, "no id here at all", "en", "a"), (8, "1234 5678 !!", "en", None),
        (8, "1234 5678 !!", "en", None), (9, "Ünïcödé wörds ähnlich 漢字 \u0000 end", "de", "c"),
    ]
    df = spark.createDataFrame([(i, t, la, s, None if t is None else len(t)) for i, t, la, s in rows], DOCS)
    if extra:
        from pyspark.sql import functions as F

        for name in ("size", "copies", "digest", "fp", "shard", "spans", "score", "target", "_key", "bin", "count", "held_out", "component_id"):
            df = df.withColumn(name, F.lit("other"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)
