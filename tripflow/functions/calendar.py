"""Calendar columns: day, hour band, season, week day, month start."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.constants import SEASON_MONTHS, SEASON_OTHER, TIME_OF_DAY_BANDS, TIME_OF_DAY_OTHER


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(ts: str | Column) -> Column:
    """Calendar day of a timestamp (DATE(ts))."""
    return F.to_date(_col(ts))


def time_of_day(ts: str | Column) -> Column:
    """Hour band label: Morning / Afternoon / Evening, else Night."""
    hour = F.hour(_col(ts))
    expr = None
    for label, lo, hi in TIME_OF_DAY_BANDS:
        cond = hour.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(TIME_OF_DAY_OTHER)


def season(d: str | Column) -> Column:
    """Meteorological season of a date or timestamp."""
    month = F.month(_col(d))
    expr = None
    for label, months in SEASON_MONTHS:
        cond = month.isin(*months)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(SEASON_OTHER)


def day_of_week(d: str | Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_col(d))


def month_start(d: str | Column) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(F.to_date(_col(d)), "month")


def day_start(year: str | Column, month: str | Column, day: str | Column) -> Column:
    """Midnight of a day given as text parts; null when the parts do not form a date."""
    return F.try_make_timestamp_ntz(
        _col(year).try_cast("int"),
        _col(month).try_cast("int"),
        _col(day).try_cast("int"),
        F.lit(0),
        F.lit(0),
        F.lit(0),
    )


def year_range(ts: str | Column, first_year: int, last_year: int) -> Column:
    """``year(ts) BETWEEN first AND last`` written as a timestamp range.

    A range on the raw column reaches the Parquet scan as pushed filters; a
    ``year(ts) IN (...)`` predicate does not.
    """
    c = _col(ts)
    lo = F.lit(f"{first_year:04d}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{last_year + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (c >= lo) & (c < hi)
