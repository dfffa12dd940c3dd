"""Small tables with the odd rows that every operator must take."""

import random

from pyspark.sql import SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, score double, shard string, block int"


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls, empty, blank, short, long, equal and repeated texts, repeated rows, null ids and sources."""
    long_text = words(1, 60_000, 5000)
    texts = [None, "", "  \n\t ", "one", "one two three four", words(2, 80), words(2, 80), words(3, 300), long_text, "x" * 70_000, "É́🙂 ß İ   ü"]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [(5, words(2, 80), "en", "s2"), (5, words(2, 80), "en", "s2"), (None, words(4, 60), None, None), (None, None, None, None)]
    return [(*r, None, 1, 0.5, "z", 2) for r in rows]


def documents(spark: SparkSession, rows: list[tuple] | None = None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)
