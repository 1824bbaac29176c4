"""Small documents with every awkward case, and helpers shared by the tests."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows() -> list[tuple]:
    words = [a + b for a in ("ka", "lo", "mi", "ru", "se") for b in ("ban", "dor", "fil", "gat", "hum")]
    draw = random.Random(5)
    prose = [" ".join(draw.choice(words) for _ in range(n)) + "." for n in (3, 8, 40, 120, 400)]
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \n\t ", None, "b", 3),
        (4, "one", "en", None, 3),
        (5, "One two\u0085three four\x0bfive\x0csix\x1cseven", "en", "b", 10),
        (6, "<|endoftext|> It's <|ENDOFTEXT|>  déjà vu, 12.5 日本 語\n\nx \U0001f600y", "fr", "c", 10),
        (7, "x" * 5000, "en", "c", 5000),
        (None, "no number here", None, None, None),
        (None, None, None, None, None),
    ]
    rows += [(10 + i, text, "en", "abc"[i % 3], len(text)) for i, text in enumerate(prose)]
    rows += [(20 + i, prose[3], "de", "b", 1) for i in range(12)]  # copies
    rows += [(40 + i, prose[4] + f" kaban{i}", "de", "a", 1) for i in range(6)]  # near copies
    rows += [(13, prose[3], "en", "a", 7)] * 3  # repeated rows and a doc_id that comes twice
    rows += [(60, " ".join(draw.choice(words) for _ in range(30_000)), "es", "a", 1)]
    return rows


def odd_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def as_set(rows) -> list[tuple]:
    """Rows as a sorted list, whatever their nulls."""
    return sorted((tuple(r) for r in rows), key=repr)
