"""Dimension join and the enriched reading tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotally.functions import calendar as cal
from geotally.operators.clean import insertion_stamp
from geotally.operators.dedupe import FORECAST_KEYS, READING_KEYS, dedupe_readings, latest_per_key, tie_order

# Decide between versions of a place with the same decision date.
PLACE_TIES = ("src_filename", "toponymic_feature_id", "geographical_name", "location", "latitude", "longitude")

DIMENSION_COLUMNS = (
    "cgndb_id",
    "latitude",
    "longitude",
    "province_territory",
    "location",
    "decision_date",
    "concise_code",
    "generic_category",
    "generic_term",
    "geographical_name",
)


def join_ignoring_case(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    salts: int = 1,
    salt_on: Sequence[str] | None = None,
) -> DataFrame:
    """Inner join on keys that may differ in case; both sides keep their columns.

    There is no broadcast hint: Spark broadcasts the dimension when its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (checked from file sizes, and again at run time from
    the shuffled bytes), and otherwise shuffles both sides and splits hot keys (AQE skew join).
    For a key known to be hot, ``salts`` above 1 spreads its fact rows over that many tasks and
    repeats each dimension row that often; ``salt_on`` names fact columns that tell rows apart.
    """
    left = fact.withColumn("_fact_key", F.upper(F.col(fact_key)))
    right = dimension.withColumn("_dimension_key", F.upper(F.col(dimension_key)))
    on = F.col("_fact_key") == F.col("_dimension_key")
    helpers = ["_fact_key", "_dimension_key"]
    if salts > 1:
        spread = [F.col(c) for c in (salt_on or fact.columns)]
        left = left.withColumn("_fact_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
        right = right.withColumn("_dimension_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = on & (F.col("_fact_salt") == F.col("_dimension_salt"))
        helpers += ["_fact_salt", "_dimension_salt"]
    return left.join(right, on, "inner").drop(*helpers)


def add_calendar(df: DataFrame, date: str = "the_date", padded: bool = False) -> DataFrame:
    """Year, month, month name, weekday name and ISO week of ``date``."""
    return df.withColumns(
        {
            "year": F.year(date),
            "month": F.month(date),
            "the_month": cal.month_name(date, padded),
            "weekday": cal.weekday_name(date, padded),
            "week_number": F.weekofyear(date),
        }
    )


def newest_places(places: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Gazetteer with the newest row per station id; a row without decision date counts as newest."""
    return insertion_stamp(latest_per_key(places, ["cgndb_id"], ["decision_date"], PLACE_TIES), as_of)


def combined_readings(
    readings: DataFrame,
    places: DataFrame,
    as_of: datetime | Column,
    keys: Sequence[str] | None = READING_KEYS,
    padded: bool = False,
    salts: int = 1,
    places_are_newest: bool = False,
) -> DataFrame:
    """Readings with place, calendar, day phase and staging latency.

    ``readings`` has the_date, hours_utc, cgndb_id, air_quality_value and lineage columns.
    Without ``keys`` they have been deduplicated already. ``places_are_newest`` says that ``places`` already went through :func:`newest_places`.
    """
    newest = places if places_are_newest else newest_places(places, as_of)
    dimension = newest.select(
        *DIMENSION_COLUMNS,
        cal.seconds_field("last_inserted", "last_updated").alias("geo_names_second_from_extraction"),
    ).withColumnRenamed("cgndb_id", "_place_id")
    fact = readings.select(
        "the_date", "hours_utc", "cgndb_id", "air_quality_value", "src_filename", "last_updated"
    )
    fact = insertion_stamp(dedupe_readings(fact, keys) if keys else fact, as_of)
    joined = join_ignoring_case(
        fact, dimension, "cgndb_id", "_place_id", salts, ["the_date", "hours_utc", "air_quality_value", "last_updated"]
    )
    dated = add_calendar(joined.withColumn("the_date", F.to_date("the_date")), padded=padded)
    return dated.select(
        F.upper("_place_id").alias("cgndb_id"),
        *DIMENSION_COLUMNS[1:],
        "geo_names_second_from_extraction",
        "the_date",
        "year",
        "month",
        "the_month",
        "weekday",
        "week_number",
        "hours_utc",
        cal.day_phase("hours_utc").alias("phase_hour_utc"),
        "air_quality_value",
        cal.seconds_field("last_inserted", "last_updated").alias("air_data_seconds_from_extraction"),
        "last_updated",
        "last_inserted",
        "src_filename",
    )


def forecasts_as_readings(forecasts: DataFrame) -> DataFrame:
    """Staged forecasts under the column names of readings, the hour taken from the time text."""
    return forecasts.select(
        F.col("validity_date").alias("the_date"),
        cal.hour_of_text("validity_time_utc").alias("hours_utc"),
        F.col("cgndb_code").alias("cgndb_id"),
        F.col("value").alias("air_quality_value"),
        "download_link",
        "src_filename",
        "last_updated",
    )


def newest_forecasts(forecasts: DataFrame, keys: Sequence[str] = FORECAST_KEYS) -> DataFrame:
    """Newest forecast of each date, time text and station.

    The key is the whole time text, not the hour taken from it later, so forecasts for times within
    one hour all stay. ``FORECAST_KEYS_PER_TIME`` keeps one station per time, like the published table.
    """
    return latest_per_key(forecasts, keys, ["last_updated"], tie_order(forecasts.columns, [*keys, "last_updated"]))


def combined_forecasts(
    forecasts: DataFrame,
    places: DataFrame,
    as_of: datetime | Column,
    keys: Sequence[str] = FORECAST_KEYS,
    **options,
) -> DataFrame:
    """:func:`combined_readings` over staged forecasts, the newest of each key."""
    newest = forecasts_as_readings(newest_forecasts(forecasts, keys))
    return combined_readings(newest, places, as_of, keys=None, **options)
