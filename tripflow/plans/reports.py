"""Dashboard report datasets (metric tiles, rankings, series, maps, tables).

Inputs: the trip mart (``tm``), the cleaned trips, the station-day mart
(``sd``) and the daily weather. Every report is an aggregate with partial
(map-side) combining; rankings use ``orderBy().limit()`` (per-partition top-k,
then a merge of k rows per partition) instead of a global window, and a window
only ever runs over already-aggregated, bounded groups.

Averages of fixed-decimal measures use :func:`fixed_point_mean`, which is
exact and order independent. Averages of ratios (trips per dock, flow stress)
and correlations are floating sums whose last bits depend on summation order;
they are rounded to ``RATIO_DECIMALS`` places so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions import metrics as M
from tripflow.functions.calendar import month_start
from tripflow.functions.geo import snap
from tripflow.operators.joins import one_row_each

RATIO_DECIMALS = 6


def _ratio_mean(col: str) -> F.Column:
    return F.round(F.avg(col), RATIO_DECIMALS)


def route_label(start: str = "start_station_name", end: str = "end_station_name") -> F.Column:
    return F.concat_ws(" -> ", F.col(start), F.col(end))


# --- R1-R4 -------------------------------------------------------------------


def total_trips(tm: DataFrame) -> DataFrame:
    """R1: number of trips in the (sliced) mart."""
    return tm.agg(F.count(F.lit(1)).alias("total_trips"))


def active_stations(trips: DataFrame) -> DataFrame:
    """R2: stations with at least one start or end (one scan, no union)."""
    names = trips.select(F.explode(F.array("start_station_name", "end_station_name")).alias("station_name"))
    return names.agg(F.count_distinct("station_name").alias("active_stations"))


def kpi_tiles(tm: DataFrame, sd: DataFrame) -> DataFrame:
    """R1-R4 as (metric, value) rows: total trips, active stations,
    utilisation rate (mean trips per dock), average net flow.

    ``tm`` needs no weather; ``sd`` is the station-day mart of the same days, and
    gives the last three tiles in one aggregate.
    """
    r1 = total_trips(tm).select(F.lit("total_trips").alias("metric"), F.col("total_trips").cast("double").alias("value"))
    rest = sd.agg(
        F.count_distinct("station_name").cast("double").alias("active_stations"),
        _ratio_mean("trips_per_dock").alias("utilization_rate"),
        F.avg("net_flow").alias("avg_net_flow"),
    )
    tiles = ", ".join(f"'{c}', {c}" for c in rest.columns)
    return r1.unionByName(rest.select(F.expr(f"stack({len(rest.columns)}, {tiles}) AS (metric, value)")))


def unmatched_trips(trips: DataFrame, stations: DataFrame, decimals: int = 3) -> DataFrame:
    """How many trips the coordinate match of the trip mart keeps and loses."""
    cells = stations.select(snap("latitude", decimals).alias("_lat"), snap("longitude", decimals).alias("_lon")).distinct()
    for side in ("start", "end"):
        here = cells.toDF(f"_{side}_lat", f"_{side}_lon").withColumn(f"_{side}", F.lit(1))
        lat, lon = snap(f"{side}_station_latitude", decimals), snap(f"{side}_station_longitude", decimals)
        trips = trips.join(here, (lat == here[f"_{side}_lat"]) & (lon == here[f"_{side}_lon"]), "left")
    start, end = F.col("_start").isNotNull(), F.col("_end").isNotNull()
    return trips.agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(start & end).alias("matched"),
        F.count_if(~start).alias("start_unmatched"),
        F.count_if(~end).alias("end_unmatched"),
    )


# --- R5-R12 on the trip mart -----------------------------------------------------


def _route_months(tm: DataFrame) -> DataFrame:
    return tm.groupBy(
        "start_station_name", "end_station_name", month_start("start_date").alias("trip_month")
    ).agg(F.count(F.lit(1)).alias("trips"))


def route_busiest_month(tm: DataFrame) -> DataFrame:
    """R5a: for each route, the month with the most trips (latest month on a tie).

    Arg-max as ``max(struct(trips, month))``: an ordinary aggregate, so it is
    combined map-side and needs no window over the route's rows.
    """
    best = _route_months(tm).groupBy("start_station_name", "end_station_name").agg(
        F.max(F.struct("trips", "trip_month")).alias("_best")
    )
    return best.select(
        "start_station_name",
        "end_station_name",
        route_label().alias("route"),
        F.col("_best.trip_month").alias("busiest_month"),
        F.col("_best.trips").alias("trips_in_month"),
    )


def latest_month_top_routes(tm: DataFrame, k: int = 10) -> DataFrame:
    """R5b: the k routes with most trips in the latest month present.

    One pass over the route-months: the first k by month, then by trips. Where the
    latest month has fewer than k routes, earlier ones follow it and are left out.
    """
    first = (
        _route_months(tm)
        .orderBy(F.col("trip_month").desc(), F.col("trips").desc(), "start_station_name", "end_station_name")
        .limit(k)
    )
    of_first = F.max("trip_month").over(Window.partitionBy(F.lit(0)))  # over at most k rows
    top = first.withColumn("_latest", of_first).where(F.col("trip_month") == F.col("_latest"))
    return top.select(
        F.col("trip_month").alias("latest_month"),
        "start_station_name",
        "end_station_name",
        route_label().alias("route"),
        F.col("trips").alias("trips_in_month"),
    )


def monthly_by_usertype(tm: DataFrame) -> DataFrame:
    """R6: trips per month and user type."""
    return tm.groupBy(month_start("start_date").alias("trip_month"), "usertype").agg(
        F.count(F.lit(1)).alias("trips")
    )


def trips_by_time_of_day(tm: DataFrame) -> DataFrame:
    """R7."""
    return tm.groupBy("time_of_day").agg(F.count(F.lit(1)).alias("trips"))


def trips_by_season(tm: DataFrame) -> DataFrame:
    """R8."""
    return tm.groupBy("season").agg(F.count(F.lit(1)).alias("trips"))


def start_station_map(tm: DataFrame, stations: DataFrame) -> DataFrame:
    """R9: trips per start station with the station's position."""
    counts = tm.groupBy("start_station_name").agg(F.count(F.lit(1)).alias("trips"))
    dim = stations.select(F.col("name").alias("start_station_name"), "latitude", "longitude", "borough", "neighborhood")
    return counts.join(dim, "start_station_name", "left")


def start_area_summary(tm: DataFrame, usertypes: Sequence[str]) -> DataFrame:
    """R10: per start borough and neighbourhood, trips and mean trip minutes
    for each listed user type as columns (``trips_<type>``, ``avg_minute_<type>``).
    ``trips`` counts all rows, also those of types that are not listed."""
    out = []
    for u in usertypes:
        key = u.lower().replace(" ", "_")
        own = F.col("usertype") == u
        out.append(F.count_if(own).alias(f"trips_{key}"))
        out.append(M.fixed_point_mean(F.when(own, F.col("trip_minute")), 2).alias(f"avg_minute_{key}"))
    return tm.groupBy("start_borough", "start_neighborhood").agg(*out, F.count(F.lit(1)).alias("trips"))


def top_destinations(tm: DataFrame, k: int = 10) -> DataFrame:
    """R11: destination neighbourhoods ranked by trips (top k)."""
    counts = tm.groupBy("end_borough", "end_neighborhood").agg(F.count(F.lit(1)).alias("trips"))
    top = counts.orderBy(F.col("trips").desc(), "end_borough", "end_neighborhood").limit(k)
    # rank over the k selected rows only
    w = Window.orderBy(F.col("trips").desc(), "end_borough", "end_neighborhood")
    return top.withColumn("rank", F.row_number().over(w))


def station_flows(tm: DataFrame) -> DataFrame:
    """R12: route, area pair, trips and mean speed (km/h, a congestion sign)."""
    return tm.groupBy("start_station_name", "end_station_name", "start_neighborhood", "end_neighborhood").agg(
        F.count(F.lit(1)).alias("trips"),
        M.fixed_point_mean("trip_avg_speed_kmh", 2).alias("avg_speed_kmh"),
    )


# --- R13-R17 on the station-day mart ---------------------------------------------


def utilization_by_month(sd: DataFrame) -> DataFrame:
    """R13: network mean trips per dock by month."""
    return sd.groupBy(month_start("trip_date").alias("trip_month")).agg(
        _ratio_mean("trips_per_dock").alias("utilization_rate")
    )


def net_flow_map(sd: DataFrame) -> DataFrame:
    """R14 + R16: per station mean net flow, trip count, position and flow class."""
    agg = sd.groupBy("station_name", "latitude", "longitude").agg(
        F.avg("net_flow").alias("avg_net_flow"),
        F.sum(F.col("trips_started") + F.col("trips_ended")).cast("bigint").alias("trip_count"),
    )
    return agg.withColumn("flow_class", M.flow_class("avg_net_flow"))


def station_metrics(sd: DataFrame) -> DataFrame:
    """R15: borough, neighbourhood, station, mean utilisation, mean net flow, mean stress."""
    return sd.groupBy("borough", "neighborhood", "station_name").agg(
        _ratio_mean("trips_per_dock").alias("utilization_rate"),
        F.avg("net_flow").alias("avg_net_flow"),
        _ratio_mean("flow_stress_score").alias("flow_stress_score"),
    )


def _daily_usage(sd: DataFrame, weather: DataFrame) -> DataFrame:
    daily = sd.groupBy("trip_date").agg(F.sum("trips_started").cast("bigint").alias("daily_trips"))
    w = weather.select(F.to_date("timestamp").alias("trip_date"), "temperature", "precipitation", "wind_speed")
    w = one_row_each(w, "trip_date")
    return daily.join(w, "trip_date", "left")


def weather_usage(sd: DataFrame, weather: DataFrame) -> DataFrame:
    """R17: usage by rain condition — days, mean daily trips, mean temperature."""
    d = _daily_usage(sd, weather).withColumn("rain_condition", M.rain_condition("precipitation"))
    return d.groupBy("rain_condition").agg(
        F.count(F.lit(1)).alias("days"),
        F.avg("daily_trips").alias("avg_daily_trips"),
        _ratio_mean("temperature").alias("avg_temperature"),
    )


def weather_correlation(sd: DataFrame, weather: DataFrame) -> DataFrame:
    """R17: correlation of daily trips with temperature, precipitation, wind."""
    d = _daily_usage(sd, weather)
    return d.agg(
        F.round(F.corr("daily_trips", "temperature"), RATIO_DECIMALS).alias("corr_temperature"),
        F.round(F.corr("daily_trips", "precipitation"), RATIO_DECIMALS).alias("corr_precipitation"),
        F.round(F.corr("daily_trips", "wind_speed"), RATIO_DECIMALS).alias("corr_wind_speed"),
        F.count(F.lit(1)).alias("days"),
    )


def bike_usage(trips: DataFrame) -> DataFrame:
    """Trips, seconds and days of use of each bike; over a table dealt into buckets by bike, without an exchange."""
    return trips.groupBy("bikeid").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("tripduration").alias("seconds"), F.size(F.collect_set("start_day")).cast("long").alias("days")
    )
