"""Small frames for the corpus operators."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, extra: dict | None = None):
    """Documents from (doc_id, text) pairs; ``extra`` adds constant columns of any name."""
    rows = [(i, t, "en", None if t is None else f"src{(i or 0) % 3}", None if t is None else len(t)) for i, t in texts]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        for name, value in extra.items():
            df = df.withColumn(name, F.lit(value))
    return df


def words(rng, n: int, vocabulary: int = 2000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
