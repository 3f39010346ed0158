"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

READING_KEYS = ("the_date", "hours_utc", "cgndb_id")
READING_KEYS_PER_HOUR = ("the_date", "hours_utc")
FORECAST_KEYS = ("validity_date", "validity_time_utc", "cgndb_code")
FORECAST_KEYS_PER_TIME = ("validity_date", "validity_time_utc")

# Of rows staged at the same moment the later file wins, then an amended value and the later period of
# issue. The measured value decides only between rows that are the same in all else.
FIRST_TIES = ("src_filename", "amended", "period")
LAST_TIES = ("air_quality_value", "value")


def _newest_first(c: str | Column) -> Column:
    return F.col(c).desc_nulls_first() if isinstance(c, str) else c


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    tiebreak: Sequence[str | Column],
) -> DataFrame:
    """One row per key: the first by ``order``, then by ``tiebreak``.

    Plain names sort descending with nulls first; pass a sort expression for anything else. The
    tiebreak is required because without it equal rows would survive at random. Keeping only rank 1
    lets Spark cut every key to one row per input partition before the exchange, so a key that
    holds much of the table does not pile up in one task.
    """
    if not tiebreak:
        raise ValueError("latest_per_key needs a tiebreak")
    ranking = Window.partitionBy(*keys).orderBy(*map(_newest_first, [*order, *tiebreak]))
    return df.withColumn("rn", F.row_number().over(ranking)).where("rn = 1").drop("rn")


def tie_order(columns: Sequence[str], but: Sequence[str | Column] = ()) -> list[str]:
    """``columns`` in the order in which they decide between rows of one stamp, without those of ``but``."""
    names = [c for c in columns if c not in [b for b in but if isinstance(b, str)]]
    middle = [c for c in names if c not in FIRST_TIES and c not in LAST_TIES]
    return [*(c for c in FIRST_TIES if c in names), *middle, *(c for c in LAST_TIES if c in names)]


def dedupe_readings(
    df: DataFrame,
    keys: Sequence[str] = READING_KEYS,
    order: Sequence[str | Column] = ("last_updated",),
    tiebreak: Sequence[str | Column] | None = None,
) -> DataFrame:
    """One reading per key, the last one staged.

    By default each station keeps its reading of the hour. ``READING_KEYS_PER_HOUR`` gives the
    published tables' rule, which keeps a single station per hour. Without a tiebreak argument
    the remaining columns decide, the file first and the value last (:func:`tie_order`), so the
    choice is the same on every run.
    """
    if tiebreak is None:
        tiebreak = tie_order(df.columns, [*keys, *order])
    return latest_per_key(df, keys, order, tiebreak)
