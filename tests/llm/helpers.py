"""Small tables for the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Texts that no operator may trip over.
ODD_TEXTS = [None, "", " \t\n", "a", "a a a", "Ünï ☃ \U0001f600", "x" * 5000, "one two " * 3000, "same text here", "same text here", "Same  Text\there"]


def docs(spark: SparkSession, texts: list, first: int = 0) -> DataFrame:
    rows = [(first + k, t, None, None, None) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df: DataFrame) -> DataFrame:
    """The same rows with more columns, named like those the operators use inside."""
    from pyspark.sql import functions as F

    names = ["id", "norm", "digest", "fp", "rep", "key", "part", "spans", "items", "row", "base", "near", "label", "held_out", "score", "ok", "group_size", "keep_id", "start", "end", "n", "first", "learnable", "u", "v"]
    return df.select("*", *(F.lit(None).cast("string").alias(n) for n in names))
