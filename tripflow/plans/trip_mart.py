"""Denormalised trip mart: each trip with areas, calendar, weather, distance, speed.

Plan shape: trips are filtered by a timestamp range (pushed to the scan), then
get three lookups: start station, end station (both by 3-decimal coordinate
cell) and, where asked for, the day's weather. The planner broadcasts the lookup
sides that its statistics show to be small, which leaves one map-only stage over
the trips, and shuffles beyond that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.constants import MART_YEARS
from tripflow.functions import calendar as C
from tripflow.functions import metrics as M
from tripflow.functions.geo import haversine_m, point_text
from tripflow.operators.joins import match_stations, one_row_each

MART_WEATHER = ("temperature", "visibility", "wind_speed", "precipitation")


def trip_mart(
    trips: DataFrame,
    stations: DataFrame,
    weather: DataFrame | None,
    years: Sequence[int] | None = MART_YEARS,
    match: str = "cell",
    weather_columns: Sequence[str] = MART_WEATHER,
    max_distance_m: float | None = None,
) -> DataFrame:
    """One row per trip and matched station pair; ``weather_columns`` join in when ``weather`` is given.

    ``years``: start years kept, as one contiguous span (None keeps all).
    ``match``: ``"cell"`` (3-decimal agreement, the reference rule) or
    ``"nearest"`` (closest station within ``max_distance_m``). ``weather`` has one row per
    day; a repeated day fails the query.
    """
    t = trips
    if years is not None:
        t = t.where(C.year_range("starttime", min(years), max(years)))
        if sorted(years) != list(range(min(years), max(years) + 1)):
            t = t.where(F.year("starttime").isin(*years))
    t = t.select(
        "usertype",
        "start_station_name",
        "end_station_name",
        "starttime",
        "tripduration",
        F.col("start_station_latitude").cast("double").alias("start_lat"),
        F.col("start_station_longitude").cast("double").alias("start_lon"),
        F.col("end_station_latitude").cast("double").alias("end_lat"),
        F.col("end_station_longitude").cast("double").alias("end_lon"),
    )
    area = ["borough", "neighborhood"]
    t = match_stations(t, stations, "start_lat", "start_lon", "start_", area, how=match, max_distance_m=max_distance_m)
    t = match_stations(t, stations, "end_lat", "end_lon", "end_", area, how=match, max_distance_m=max_distance_m)

    t = t.withColumns(
        {
            "start_date": C.day_of("starttime"),
            "time_of_day": C.time_of_day("starttime"),
            "trip_minute": M.trip_minutes("tripduration"),
        }
    )
    if weather is not None:
        w = weather.select(F.to_date("timestamp").alias("_wday"), *weather_columns)
        if years is not None:
            w = w.where(C.year_range(F.col("_wday").cast("timestamp_ntz"), min(years), max(years)))
        w = one_row_each(w, "_wday")
        t = t.join(w, t["start_date"] == w["_wday"], "left").drop("_wday")
        wcols = list(weather_columns)
    else:
        wcols = []
    km = haversine_m("start_lat", "start_lon", "end_lat", "end_lon") / F.lit(1000.0)
    t = t.withColumn("trip_distance_km", km)
    return t.select(
        "usertype",
        "start_station_name",
        "end_station_name",
        "start_date",
        "time_of_day",
        "trip_minute",
        point_text("start_lat", "start_lon").alias("start_point"),
        point_text("end_lat", "end_lon").alias("end_point"),
        "start_borough",
        "start_neighborhood",
        "end_borough",
        "end_neighborhood",
        C.day_of_week("start_date").alias("day_of_week"),
        F.month("start_date").alias("month"),
        F.year("start_date").alias("year"),
        C.season("start_date").alias("season"),
        *wcols,
        "start_lat",
        "start_lon",
        "end_lat",
        "end_lon",
        "trip_distance_km",
        M.avg_speed_kmh("trip_distance_km", "trip_minute").alias("trip_avg_speed_kmh"),
    )
