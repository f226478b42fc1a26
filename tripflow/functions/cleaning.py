"""Column-level cleaning: text times, textual nulls, sentinels, safe casts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.constants import (
    FRACTION_PATTERN,
    ISO_LAYOUT,
    TEXTUAL_NULLS,
    US_LAYOUT,
    US_LAYOUT_NO_SECONDS,
)

# Tried in order; the first layout that parses wins. Seconds-less US times are
# parsed by their own layout instead of guessing from the text length.
DEFAULT_TIME_LAYOUTS = (US_LAYOUT, US_LAYOUT_NO_SECONDS, ISO_LAYOUT)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_fraction(text: str | Column) -> Column:
    """Drop fractional seconds (``.123``) from time text."""
    return F.regexp_replace(_col(text), FRACTION_PATTERN, "")


def parse_time(text: str | Column, layouts: Sequence[str] = DEFAULT_TIME_LAYOUTS) -> Column:
    """Parse trip time text in any of ``layouts`` to TIMESTAMP_NTZ; null when none fits.

    The text carries no zone, so the result is the wall-clock time it shows, whatever
    the session's zone: it is parsed as a time at offset zero (null instead of an
    error), and its distance from the epoch is added to a zone-free epoch.
    """
    cleaned = F.concat(F.trim(strip_fraction(text)), F.lit(" +00:00"))
    parsed = F.coalesce(*(F.try_to_timestamp(cleaned, F.lit(f"{fmt} XXX")) for fmt in layouts))
    seconds = (F.unix_micros(parsed) / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def textual_null(text: str | Column, markers: Sequence[str] = TEXTUAL_NULLS) -> Column:
    """Text turned into a real null when it is blank or a textual null marker."""
    c = _col(text)
    normal = F.lower(F.trim(c))
    return F.when(c.isNull() | (normal == "") | normal.isin(*markers), F.lit(None)).otherwise(c)


def without_sentinel(value: str | Column, sentinel) -> Column:
    """``IF(value = sentinel, NULL, value)``."""
    return F.nullif(_col(value), F.lit(sentinel))


def to_double(value: str | Column) -> Column:
    """Text or number to double; null instead of an error on bad text."""
    return _col(value).cast("string").try_cast("double")


def to_whole_number(value: str | Column) -> Column:
    """Coerce to a nullable integer like ``to_numeric(errors='coerce')``.

    ``'12'`` and ``'12.0'`` give 12, ``'x'`` gives null, a fractional number
    keeps its integer part.
    """
    return to_double(value).try_cast("bigint")
