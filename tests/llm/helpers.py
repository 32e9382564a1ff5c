"""Fixtures of the corpus tests: small rows with the awkward cases every operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts, first: int = 0, source="s", ids=None) -> DataFrame:
    rows = [
        (first + i if ids is None else ids[i], t, "en", source, None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


def awkward(spark: SparkSession) -> DataFrame:
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing column names."""
    rows = [
        (1, "one two three four five six", "en", "a", 27, 1, "x", "k"),
        (1, "one two three four five six", "en", "a", 27, 1, "x", "k"),
        (2, "", None, None, None, None, None, None),
        (3, None, "en", None, 0, 3, "y", "l"),
        (None, "a row without id", None, "a", None, 4, "z", None),
        (None, None, None, None, None, None, None, None),
        (4, "long words " * 40_000, "en", "b", 440_000, 5, "x", "k"),
        (5, " \t\n \x0b ", "en", "b", 6, 6, "x", "k"),
        (6, "É́ ǅ ﬁn x <|endoftext|> 🙂 z", "fr", "c", 20, 7, "x", "k"),
    ]
    return spark.createDataFrame(
        rows, DOCUMENTS + ", size long, start string, key string"
    ).repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCUMENTS)
