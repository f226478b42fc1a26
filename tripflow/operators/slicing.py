"""Dashboard slicers as composable ``where`` clauses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.metrics import rain_condition


def _among(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    return df if values is None else df.where(F.col(column).isin(*values))


def slice_trips(
    trip_mart: DataFrame,
    *,
    date_range: tuple[str, str] | None = None,
    seasons: Sequence[str] | None = None,
    times_of_day: Sequence[str] | None = None,
    usertypes: Sequence[str] | None = None,
    start_boroughs: Sequence[str] | None = None,
    start_neighborhoods: Sequence[str] | None = None,
    end_boroughs: Sequence[str] | None = None,
    end_neighborhoods: Sequence[str] | None = None,
    rain: Sequence[str] | None = None,
) -> DataFrame:
    """Keep trip-mart rows matching every given criterion (None = no filter).

    ``rain`` takes labels of :func:`rain_condition` ('Rain', 'No rain',
    'Unknown'), derived from the day's precipitation.
    """
    df = trip_mart
    if date_range is not None:
        lo, hi = (F.lit(d).cast("date") for d in date_range)
        df = df.where(F.col("start_date").between(lo, hi))
    df = _among(df, "season", seasons)
    df = _among(df, "time_of_day", times_of_day)
    df = _among(df, "usertype", usertypes)
    df = _among(df, "start_borough", start_boroughs)
    df = _among(df, "start_neighborhood", start_neighborhoods)
    df = _among(df, "end_borough", end_boroughs)
    df = _among(df, "end_neighborhood", end_neighborhoods)
    if rain is not None:
        df = df.where(rain_condition("precipitation").isin(*rain))
    return df


def slice_station_days(
    station_day: DataFrame,
    *,
    date_range: tuple[str, str] | None = None,
    times_of_day: Sequence[str] | None = None,
    boroughs: Sequence[str] | None = None,
    neighborhoods: Sequence[str] | None = None,
) -> DataFrame:
    """Keep station-day rows matching every given criterion; ``times_of_day`` needs rows by time of day."""
    df = station_day
    if date_range is not None:
        lo, hi = (F.lit(d).cast("date") for d in date_range)
        df = df.where(F.col("trip_date").between(lo, hi))
    df = _among(df, "time_of_day", times_of_day)
    df = _among(df, "borough", boroughs)
    return _among(df, "neighborhood", neighborhoods)
