"""Column names, lineage, row filters and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotally.functions.calendar import est_stamp, instant
from geotally.functions.text import column_name


def normalize_columns(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Lower-case names without blanks, then the given renames."""
    return df.toDF(*map(column_name, df.columns)).withColumnsRenamed(dict(renames or {}))


def lineage_stamp(
    df: DataFrame, as_of: datetime | Column, download_link: str | Column, src_filename: str | Column
) -> DataFrame:
    """Add when and from where rows were staged; text arguments are literals."""
    text = {"download_link": download_link, "src_filename": src_filename}
    stamps = {name: v if isinstance(v, Column) else F.lit(v) for name, v in text.items()}
    return df.withColumns({"last_updated": instant(as_of), **stamps})


def insertion_stamp(df: DataFrame, as_of: datetime | Column) -> DataFrame:
    return df.withColumn("last_inserted", est_stamp(as_of))


def drop_any_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any of ``columns``, by default in any column."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def keep_stations(df: DataFrame, column: str, stations: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose ``column`` is one of ``stations`` in any case.

    A list becomes an IN predicate. A DataFrame (its first column) becomes a left-semi join, for
    which Spark chooses broadcast or shuffle by measured size.
    """
    if isinstance(stations, DataFrame):
        wanted = stations.select(F.upper(F.col(stations.columns[0])).alias("_wanted"))
        return df.join(wanted, F.upper(F.col(column)) == F.col("_wanted"), "left_semi")
    return df.where(F.upper(F.col(column)).isin([s.upper() for s in stations]))


def filter_names(
    df: DataFrame, column: str, not_like: Sequence[str] = (), not_in: Sequence[str] = ()
) -> DataFrame:
    """Rows whose name matches none of the patterns and is none of the names."""
    name = F.col(column)
    for pattern in not_like:
        df = df.where(~name.like(pattern))
    return df.where(~name.isin(list(not_in))) if not_in else df


def first_matching(df: DataFrame, condition: Column, position: str | Sequence[str | Column]) -> DataFrame:
    """First row in position order that satisfies ``condition``."""
    order = [position] if isinstance(position, str) else list(position)
    return df.where(condition).orderBy(*order).limit(1)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
