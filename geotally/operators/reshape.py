"""Wide to long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotally.fixed_values import WEEKDAYS

READING_IDS = ("the_date", "hours_utc", "download_link", "src_filename", "last_updated")


def unpivot_stations(
    df: DataFrame,
    ids: Sequence[str] = READING_IDS,
    stations: Sequence[str] | None = None,
    station_name: str = "cgndb_id",
    value_name: str = "air_quality_value",
) -> DataFrame:
    """One row per station column and input row, without null cells.

    Stations are all columns that are not ids. Rows with a null id yield nothing, and leave
    before the rows multiply.
    """
    ids = list(ids)
    stations = list(stations) if stations else [c for c in df.columns if c not in ids]
    whole = df.na.drop("any", subset=ids)
    return whole.unpivot(ids, stations, station_name, value_name).na.drop("any", subset=[value_name])


def weekday_wide_to_long(
    df: DataFrame, ids: Sequence[str], name: str = "weekday", value: str = "weekday_avg"
) -> DataFrame:
    """Seven rows per station from its seven weekday means, with the day's place in the week."""
    columns = [f"{day.lower()}_avg" for day in WEEKDAYS]
    long = df.unpivot(list(ids), columns, "_mean", value)
    day = F.initcap(F.substring_index("_mean", "_", 1))
    number = F.array_position(F.array(*map(F.lit, columns)), F.col("_mean")).cast("int")
    return long.select(*ids, number.alias("weekday_number"), day.alias(name), value)
