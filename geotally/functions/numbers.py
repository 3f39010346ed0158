"""Rounding and typed means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geotally.functions.calendar import ColumnOrName, as_column


def rounded(value: ColumnOrName, to: str = "int") -> Column:
    """Nearest integer, halves to the even neighbour."""
    return F.rint(as_column(value)).cast(to)


def truncated(value: ColumnOrName, to: str = "bigint") -> Column:
    """Integer part."""
    return as_column(value).cast(to)


def settled_mean(value: ColumnOrName, to: str = "double") -> Column:
    """Mean of doubles to 15 significant digits.

    The last digits of a sum of doubles depend on the order the rows arrive in, which differs from
    run to run. Dropping them before any rounding makes a mean such as 72.425 round the same way
    every time; it is also what the published tables' cast to a decimal does.
    """
    mean = F.avg(as_column(value).cast("double"))
    return F.when(mean.isNotNull(), F.format_string("%.14e", mean)).cast(to)


def mean_decimal(value: ColumnOrName, precision: int = 10, scale: int = 2) -> Column:
    """Mean of doubles with a fixed number of decimals, halves away from zero."""
    return settled_mean(value, f"decimal({precision},{scale})")
