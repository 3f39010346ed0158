"""Staging of the five landed datasets.

``conform_*`` turns a raw frame into its staged form and works on any source, batch or stream;
``stage_*`` reads landed files and conforms them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geotally import schemas
from geotally.functions.calendar import any_date
from geotally.operators.clean import first_matching, lineage_stamp, normalize_columns
from geotally.sources import files

Stamp = datetime | Column


def _link(raw: DataFrame, base: str | Column) -> Column:
    """Download address of a row: the address of the listing followed by the file's name."""
    base = base if isinstance(base, Column) else F.lit(base)
    return F.concat(base, F.substring_index(files.FILE_NAME, "/", -1))


def _as_dates(df: DataFrame, *columns: str) -> DataFrame:
    """Columns as dates: text is parsed, dates and timestamps are only cast."""
    text = {c for c, kind in df.dtypes if kind == "string"}
    return df.withColumns({c: any_date(c) if c in text else F.to_date(c) for c in columns})


def conform_air_wide(raw: DataFrame, as_of: Stamp, base: str | Column = "") -> DataFrame:
    """One column per station, the two id columns renamed."""
    staged = raw.withColumnsRenamed(schemas.AIR_WIDE_RENAMES)
    staged = _as_dates(staged, "the_date").withColumn("hours_utc", F.col("hours_utc").cast("bigint"))
    return lineage_stamp(staged, as_of, _link(raw, base), F.col(files.FILE_NAME))


def conform_forecasts(raw: DataFrame, as_of: Stamp, base: str | Column = "") -> DataFrame:
    staged = raw.withColumnsRenamed(schemas.FORECAST_RENAMES)
    staged = _as_dates(staged, "validity_date")
    return lineage_stamp(staged, as_of, _link(raw, base), F.col(files.FILE_NAME))


def conform_traffic_volume(raw: DataFrame, as_of: Stamp, link: str | Column = "") -> DataFrame:
    return lineage_stamp(raw, as_of, link, F.col(files.FILE_NAME))


def conform_geo_names(raw: DataFrame, as_of: Stamp, link: str | Column = "") -> DataFrame:
    staged = _as_dates(normalize_columns(raw, schemas.GEO_NAMES_RENAMES), "decision_date")
    return lineage_stamp(staged, as_of, link, F.col(files.FILE_NAME))


def conform_intersection_counts(raw: DataFrame, as_of: Stamp, link: str | Column = "") -> DataFrame:
    staged = _as_dates(normalize_columns(raw), "activation_date", "count_date")
    return lineage_stamp(staged, as_of, link, F.col(files.FILE_NAME))


def stage_air_wide(spark: SparkSession, path: str, as_of: Stamp, base: str = "") -> DataFrame:
    """Monthly station files; stations may differ from file to file."""
    return conform_air_wide(files.read_drifting(spark, path, schemas.AIR_WIDE_IDS), as_of, base)


def stage_forecasts(spark: SparkSession, path: str, as_of: Stamp, base: str = "") -> DataFrame:
    return conform_forecasts(files.read_delimited(spark, path, schemas.FORECASTS), as_of, base)


def stage_traffic_volume(spark: SparkSession, path: str, as_of: Stamp, link: str = "") -> DataFrame:
    return conform_traffic_volume(files.read_delimited(spark, path, schemas.TRAFFIC_VOLUME), as_of, link)


def stage_geo_names(spark: SparkSession, path: str, as_of: Stamp, link: str = "") -> DataFrame:
    """Gazetteer as landed: zip archives of one delimited file."""
    return conform_geo_names(files.read_zipped_csv(spark, path, schemas.GEO_NAMES), as_of, link)


def stage_intersection_counts(
    spark: SparkSession, path: str, as_of: Stamp, link: str = "", sep: str = ","
) -> DataFrame:
    return conform_intersection_counts(
        files.read_delimited(spark, path, schemas.INTERSECTION_COUNTS, sep=sep), as_of, link
    )


def first_csv_resource(catalog: DataFrame, position: str = "position", kind: str = "format") -> DataFrame:
    """First entry of a resource catalogue that is a CSV file."""
    return first_matching(catalog, F.lower(kind).isin("csv"), position)
