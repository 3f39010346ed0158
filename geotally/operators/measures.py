"""Measures of a step, taken while its rows are written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

MEASURES = StructType(
    [
        StructField("step_name", StringType()),
        StructField("n_rows", LongType()),
        StructField("n_files", LongType()),
        StructField("column_name", StringType()),
        StructField("n_nulls", LongType()),
    ]
)


def observed(df: DataFrame, name: str, file_column: str | None = None) -> tuple[DataFrame, Observation]:
    """``df`` and what its next action will have seen: rows, nulls of each column, and input files.

    The counting is part of that action's plan; no job of its own runs. Only names of input files are held, each once.
    """
    watch = Observation(name)
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls {c}") for c in df.columns]
    files = F.size(F.collect_set(file_column)) if file_column else F.lit(0) * F.count(F.lit(1))
    return df.observe(watch, F.count(F.lit(1)).alias("n_rows"), files.cast("bigint").alias("n_files"), *nulls), watch


def write_observed(df: DataFrame, name: str, write: Callable[[DataFrame], object], file_column: str | None = None) -> DataFrame:
    """Write ``df`` and return its measures, a row for each column."""
    watched, watch = observed(df, name, file_column)
    write(watched)
    got = watch.get
    rows = [(name, got["n_rows"], got["n_files"], c, got[f"nulls {c}"]) for c in df.columns]
    return df.sparkSession.createDataFrame(rows, MEASURES)
