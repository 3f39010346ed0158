"""Means by phase, weekday and station, and other grouped values.

Every aggregate here is partial first: each task reduces its rows to one per key before the
exchange, so a hot key costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotally.fixed_values import DAY_PHASES, WEEKDAYS
from geotally.functions.calendar import weekday_name, weekday_number
from geotally.functions.numbers import mean_decimal, rounded, settled_mean


def means_by_bucket(df: DataFrame, keys: Sequence[str], value: str, buckets: Mapping[str, Column]) -> DataFrame:
    """One row per key with the mean of ``value`` in each bucket, for keys seen in every bucket.

    A bucket whose values are all null has a null mean but still counts as seen. One scan and one
    exchange, where a join of one aggregate per bucket would take one of each per bucket.
    """
    means = [mean_decimal(F.when(inside, F.col(value))).alias(name) for name, inside in buckets.items()]
    seen = [F.count_if(inside).alias(f"_seen_{name}") for name, inside in buckets.items()]
    grouped = df.groupBy(*keys).agg(*means, *seen)
    for name in buckets:
        grouped = grouped.where(F.col(f"_seen_{name}") > 0)
    return grouped.select(*keys, *buckets)


def phase_avg_wide(df: DataFrame, keys: Sequence[str], hour: str, value: str) -> DataFrame:
    """Mean per key for each of the four day phases."""
    buckets = {name: F.col(hour).between(first, last) for first, last, _, name in DAY_PHASES}
    return means_by_bucket(df, keys, value, buckets)


def weekday_avg_wide(df: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """Mean per key for each weekday."""
    number = weekday_number(date)
    buckets = {f"{day.lower()}_avg": number == i for i, day in enumerate(WEEKDAYS, 1)}
    return means_by_bucket(df, keys, value, buckets)


def station_avg(df: DataFrame, keys: Sequence[str], value: str, name: str = "station_avg") -> DataFrame:
    """Mean per key of the non-null values."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(mean_decimal(value).alias(name))


def weekday_volume_avg(
    df: DataFrame, keys: Sequence[str], date: str, value: str, name: str = "volume_avg", padded: bool = False
) -> DataFrame:
    """Mean per key and weekday, to the nearest integer (halves to even)."""
    # Grouping by the number keeps text out of the exchange; the name is added to the few result rows.
    grouped = df.groupBy(*keys, weekday_number(date).alias("_day")).agg(rounded(settled_mean(value)).alias(name))
    # 2024-01-01 was a Monday.
    any_such_day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("_day") - 1)
    return grouped.select(*keys, weekday_name(any_such_day, padded).alias("weekday"), name)


def bbox_center(df: DataFrame, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    """Bounding box and mean position of all points, in one row."""
    return df.agg(
        F.min(longitude).alias("min_longitude"),
        F.min(latitude).alias("min_latitude"),
        F.max(longitude).alias("max_longitude"),
        F.max(latitude).alias("max_latitude"),
        F.avg(latitude).alias("center_latitude"),
        F.avg(longitude).alias("center_longitude"),
    )


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def first_attr_per_key(
    df: DataFrame, keys: Sequence[str], attributes: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Attributes of the first row of each key in ``order`` (ties go to the smaller attributes)."""
    first = F.min_by(F.struct(*attributes), F.struct(*order, *attributes)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, *[F.col("_first")[a].alias(a) for a in attributes])


def stations_with_many_positions(
    df: DataFrame, key: str = "cgndb_id", latitude: str = "latitude", longitude: str = "longitude"
) -> DataFrame:
    """Keys that occur at more than one position; empty when every station has one."""
    place = F.struct(F.col(latitude).alias("latitude"), F.col(longitude).alias("longitude"))
    spread = df.groupBy(key).agg(F.min(place).alias("first_position"), F.max(place).alias("last_position"))
    return spread.where(F.col("first_position") != F.col("last_position"))


def least_column(df: DataFrame, columns: Sequence[str], name: str = "fastest") -> DataFrame:
    """Name of the column with the smallest value in each row; the first one wins ties."""
    smallest = F.least(*columns)
    winner = F.coalesce(*[F.when(F.col(c) == smallest, F.lit(c)) for c in columns])
    return df.withColumn(name, winner)
