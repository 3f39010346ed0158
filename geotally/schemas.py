"""Explicit schemas of the landed files and of the logs."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def table(*columns: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns])


TEXT, NUMBER, WHOLE, MOMENT = StringType(), DoubleType(), LongType(), TimestampNTZType()

# Dates of landed files are read as text and converted when the rows are conformed.

# Columns shared by all station files; the other columns are stations.
AIR_WIDE_IDS = table(("Date", TEXT), ("Hour (UTC)", WHOLE))
AIR_WIDE_RENAMES = {"Date": "the_date", "Hour (UTC)": "hours_utc"}

FORECASTS = table(
    ("cgndb code", TEXT),
    ("community name", TEXT),
    ("validity date", TEXT),
    ("validity time (UTC)", TEXT),
    ("period", WHOLE),
    ("value", WHOLE),
    ("amended?", WHOLE),
)
FORECAST_RENAMES = {
    "cgndb code": "cgndb_code",
    "community name": "community_name",
    "validity date": "validity_date",
    "validity time (UTC)": "validity_time_utc",
    "amended?": "amended",
}

TRAFFIC_VOLUME = table(
    ("X_id", WHOLE),
    ("location_id", WHOLE),
    ("location", TEXT),
    ("lng", NUMBER),
    ("lat", NUMBER),
    ("centreline_type", NUMBER),
    ("centreline_id", NUMBER),
    ("px", NUMBER),
    ("count_date", TEXT),
)

GEO_NAMES = table(
    ("CGNDB ID", TEXT),
    ("Geographical Name", TEXT),
    ("Language", TEXT),
    ("Syllabic Form", TEXT),
    ("Generic Term", TEXT),
    ("Generic Category", TEXT),
    ("Concise Code", TEXT),
    ("Toponymic Feature ID", TEXT),
    ("Latitude", NUMBER),
    ("Longitude", NUMBER),
    ("Location", TEXT),
    ("Province - Territory", TEXT),
    ("Relevance at Scale", WHOLE),
    ("Decision Date", TEXT),
    ("Source", TEXT),
)
GEO_NAMES_RENAMES = {"province_-_territory": "province_territory"}

INTERSECTION_COUNTS = table(
    ("OBJECTID", WHOLE),
    ("TCS__", NUMBER),
    ("MAIN", TEXT),
    ("MIDBLOCK_ROUTE", TEXT),
    ("SIDE_1_ROUTE", TEXT),
    ("SIDE_2_ROUTE", TEXT),
    ("ACTIVATION_DATE", TEXT),
    ("LATITUDE", NUMBER),
    ("LONGITUDE", NUMBER),
    ("COUNT_DATE", TEXT),
    ("F8HR_VEHICLE_VOLUME", NUMBER),
    ("F8HR_PEDESTRIAN_VOLUME", NUMBER),
)

RUN_LOG = table(
    ("phase", TEXT),
    ("step_name", TEXT),
    ("duration_seconds", NUMBER),
    ("start_time", MOMENT),
    ("end_time", MOMENT),
    ("files_processed", NUMBER),
)
