"""Means that are kept up to date: sums and counts by key and bucket, into which new rows alone are folded."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotally.fixed_values import DAY_PHASES, WEEKDAYS
from geotally.functions.calendar import weekday_number

BUCKET, TOTAL, VALUES, ROWS = "bucket", "total", "n_values", "n_rows"


def phases(hour: str) -> dict[str, Column]:
    return {name: F.col(hour).between(first, last) for first, last, _, name in DAY_PHASES}


def weekdays(date: str) -> dict[str, Column]:
    return {f"{day.lower()}_avg": weekday_number(date) == i for i, day in enumerate(WEEKDAYS, 1)}


def mean_state(df: DataFrame, keys: Sequence[str], value: str, buckets: Mapping[str, Column]) -> DataFrame:
    """(keys, bucket, total, n_values, n_rows) of ``df``; rows outside all buckets do not count, buckets do not overlap."""
    name = F.coalesce(*[F.when(inside, F.lit(b)) for b, inside in buckets.items()])
    inside = df.select(*keys, name.alias(BUCKET), F.col(value).cast("double").alias("_value")).where(F.col(BUCKET).isNotNull())
    sums = [F.coalesce(F.sum("_value"), F.lit(0.0)).alias(TOTAL), F.count("_value").alias(VALUES), F.count(F.lit(1)).alias(ROWS)]
    return inside.groupBy(*keys, BUCKET).agg(*sums)


def folded(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state of several of the same keys: sums add up, so old rows need not be read again."""
    return states.groupBy(*keys, BUCKET).agg(*[F.sum(c).alias(c) for c in (TOTAL, VALUES, ROWS)])


def means_of(state: DataFrame, keys: Sequence[str], buckets: Sequence[str], precision: int = 10, scale: int = 2) -> DataFrame:
    """The wide means of a state, by the rules of means from scratch: keys seen in every bucket, to 15 digits before rounding."""
    mean = F.when(F.col(VALUES) > 0, F.col(TOTAL) / F.col(VALUES))
    settled = F.when(mean.isNotNull(), F.format_string("%.14e", mean)).cast(f"decimal({precision},{scale})")
    wide = [F.max(F.when(F.col(BUCKET) == b, settled)).alias(b) for b in buckets]
    seen = [F.max((F.col(BUCKET) == b).cast("int")).alias(f"_seen_{b}") for b in buckets]
    grouped = state.groupBy(*keys).agg(*wide, *seen)
    for b in buckets:
        grouped = grouped.where(F.col(f"_seen_{b}") == 1)
    return grouped.select(*keys, *buckets)
