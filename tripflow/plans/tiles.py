"""The dashboard's tiles for any slice, from a store that is made once.

The store has one row per station, day, time of day and user type with the trips that started and ended there. Those
are counts, so any slice of these (and of the stations' areas) adds up from it, and the trips
are not read again: it grows with stations and days, not with trips.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions import metrics as M
from tripflow.operators.flow import station_day_flow
from tripflow.operators.joins import one_row_each
from tripflow.plans.reports import RATIO_DECIMALS


@dataclass(frozen=True)
class Slice:
    """What a dashboard's slicers let through; None lets everything through."""

    date_range: tuple[str, str] | None = None
    times_of_day: Sequence[str] | None = None
    usertypes: Sequence[str] | None = None
    boroughs: Sequence[str] | None = None
    neighborhoods: Sequence[str] | None = None

    def condition(self) -> Column:
        out = F.lit(True)
        if self.date_range is not None:
            out = out & F.col("trip_date").between(*(F.lit(d).cast("date") for d in self.date_range))
        for column, values in (
            ("time_of_day", self.times_of_day),
            ("usertype", self.usertypes),
            ("borough", self.boroughs),
            ("neighborhood", self.neighborhoods),
        ):
            if values is not None:
                out = out & F.col(column).isin(*values)
        return out


def tile_store(trips: DataFrame) -> DataFrame:
    """station_name, trip_date, time_of_day, usertype, trips_started, trips_ended; one scan and one shuffle of the trips."""
    return station_day_flow(trips, by_time_of_day=True, also=["usertype"]).drop("net_flow")


def tiles(store: DataFrame, stations: DataFrame, slices: Mapping[str, Slice]) -> DataFrame:
    """One row per slice that holds anything: ``slice``, total_trips (started), active_stations, utilization_rate (mean of trips per dock over
    station-days) and avg_net_flow. All slices are read in one pass over the store. Stations without a borough are left
    out, a repeated station name fails the query."""
    places = one_row_each(stations.where(F.col("borough").isNotNull()).select(F.col("name").alias("station_name"), "borough", "neighborhood", "capacity"), "station_name")
    of = F.array_compact(F.array(*(F.when(s.condition(), F.lit(name)) for name, s in slices.items())))
    rows = store.join(places, "station_name").withColumn("slice", F.explode(of))
    days = rows.groupBy("slice", "station_name", "trip_date", "capacity").agg(F.sum("trips_started").alias("s"), F.sum("trips_ended").alias("e"))
    return days.groupBy("slice").agg(
        F.sum("s").alias("total_trips"),
        F.count_distinct("station_name").alias("active_stations"),
        F.round(F.avg(M.trips_per_dock("s", "e", "capacity")), RATIO_DECIMALS).alias("utilization_rate"),
        F.avg(M.net_flow("e", "s")).alias("avg_net_flow"),
    )
