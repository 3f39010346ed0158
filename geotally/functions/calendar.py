"""Dates, day phases, periods and time differences."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from geotally.fixed_values import DAY_PHASES, EST_OFFSET_HOURS, FREQUENCY_WORDS, PADDED_NAME_WIDTH, UNKNOWN_PHASE

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant(as_of: datetime | Column) -> Column:
    """``as_of`` as a UTC wall-clock column without zone; naive datetimes are taken as UTC."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def est_stamp(as_of: datetime | Column) -> Column:
    """Wall clock at UTC-5 all year round (no daylight saving)."""
    return instant(as_of) - F.expr(f"INTERVAL '{EST_OFFSET_HOURS}' HOUR")


def _name(date: ColumnOrName, pattern: str, padded: bool) -> Column:
    name = F.date_format(as_column(date), pattern)
    return F.rpad(name, PADDED_NAME_WIDTH, " ") if padded else name


def month_name(date: ColumnOrName, padded: bool = False) -> Column:
    return _name(date, "MMMM", padded)


def weekday_name(date: ColumnOrName, padded: bool = False) -> Column:
    return _name(date, "EEEE", padded)


def weekday_number(date: ColumnOrName) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(as_column(date)) + 1


def hour_of_text(time_text: ColumnOrName, pattern: str = "HH:mm:ss") -> Column:
    """Hour of a time of day written as text."""
    return F.hour(F.to_timestamp_ntz(as_column(time_text), F.lit(pattern))).cast("bigint")


_MONTH_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})"


def any_date(value: ColumnOrName) -> Column:
    """Date of a date, a timestamp, or text with the year or the month first; a time after it is ignored.

    Text that is no date stops the job rather than becoming null; empty text is null.
    """
    written = F.nullif(F.trim(as_column(value).cast("string")), F.lit(""))
    part = [F.regexp_extract(written, _MONTH_FIRST, i).try_cast("int") for i in (1, 2, 3)]
    month_first = F.make_date(part[2], part[0], part[1])
    year_first = F.replace(F.substring_index(written, " ", 1), F.lit("/"), F.lit("-")).cast("date")
    return F.when(written.rlike(_MONTH_FIRST), month_first).otherwise(year_first)


def date_of_millis(millis: ColumnOrName) -> Column:
    """UTC date of a number of milliseconds since 1970."""
    days = F.floor(as_column(millis) / F.lit(86_400_000)).cast("int")
    return F.date_from_unix_date(days)


def day_phase(hour: ColumnOrName) -> Column:
    """Phase label of an hour; hours outside 0 to 23 and null hours are ``Unknown``."""
    hour = as_column(hour)
    first, last, label, _ = DAY_PHASES[0]
    phase = F.when(hour.between(first, last), label)
    for first, last, label, _ in DAY_PHASES[1:]:
        phase = phase.when(hour.between(first, last), label)
    return phase.otherwise(UNKNOWN_PHASE)


def seconds_field(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Seconds part (below 60, signed) of a difference, as the published latency columns hold it."""
    return F.extract(F.lit("SECOND"), as_column(later) - as_column(earlier)).cast("double")


def elapsed_seconds(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Whole difference in seconds."""
    gap = as_column(later) - as_column(earlier)
    return gap.cast("interval second").cast("decimal(18,6)").cast("double")


def parse_frequency(text: str) -> tuple[str, str]:
    """(period code, label) of a frequency word such as ``Daily`` or ``Quarter``."""
    wanted = text.upper()
    for word, code, label in FREQUENCY_WORDS:
        if word in wanted:
            return code, label
    raise ValueError(f"forecast frequency must name hours, days, months, quarters or years, not {text!r}")


_PERIOD_TRUNC = {"MS": "month", "QS": "quarter", "YS": "year"}
_PERIOD_MONTHS = {"MS": 1, "QS": 3, "YS": 12}


def first_period(start: ColumnOrName, code: str) -> Column:
    """First date of the series: calendar periods begin at the next period start on or after ``start``."""
    start = as_column(start)
    if code not in _PERIOD_TRUNC:
        return start
    begin = F.trunc(start, _PERIOD_TRUNC[code])
    return F.when(begin == start, begin).otherwise(F.add_months(begin, _PERIOD_MONTHS[code]))


def date_series(start: ColumnOrName, code: str, periods: int) -> Column:
    """Array of ``periods`` consecutive dates (timestamps without zone when hourly) from ``start``."""
    if periods < 1:
        raise ValueError("a date series needs at least one period")
    steps = periods - 1
    start = as_column(start)
    if code == "h":
        begin = start.cast("timestamp_ntz")
        return F.sequence(begin, begin + F.expr(f"INTERVAL '{steps}' HOUR"), F.expr("INTERVAL '1' HOUR"))
    begin = first_period(start.cast("date"), code)
    if code == "D":
        return F.sequence(begin, F.date_add(begin, steps), F.expr("INTERVAL '1' DAY"))
    months = _PERIOD_MONTHS[code]
    return F.sequence(begin, F.add_months(begin, steps * months), F.expr(f"INTERVAL '{months}' MONTH"))
