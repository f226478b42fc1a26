"""Station-day congestion mart: flow per station and day, with capacity metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.constants import STATION_DAY_RANGE
from tripflow.functions import metrics as M
from tripflow.operators.flow import station_day_flow
from tripflow.operators.joins import one_row_each


def station_day(
    trips: DataFrame,
    stations: DataFrame,
    date_range: tuple[str, str] | None = STATION_DAY_RANGE,
    method: str = "single_pass",
    unknown_label: str | None = None,
    sort: bool = False,
    check_unique_names: bool = True,
    by_time_of_day: bool = False,
) -> DataFrame:
    """One row per (station, day) with a known borough, inside ``date_range``; with
    ``by_time_of_day`` one per (station, day, time of day), rates and labels included.

    Stations are matched by name, so station names must be unique in ``stations``:
    a repeated name fails the query unless ``check_unique_names`` is off. The date filter is
    applied to the trips before aggregation, on both day columns, so it prunes
    the scan; a trip whose start and stop straddle the range boundary counts
    only on its in-range side, as with a filter after the join.
    """
    if date_range is not None:
        # day range as a timestamp range on the raw columns: reaches the scan as pushed filters
        lo = F.lit(date_range[0]).cast("date").cast("timestamp_ntz")
        hi = F.date_add(F.lit(date_range[1]).cast("date"), 1).cast("timestamp_ntz")
        start_in = (F.col("starttime") >= lo) & (F.col("starttime") < hi)
        stop_in = (F.col("stoptime") >= lo) & (F.col("stoptime") < hi)
        trips = trips.where(start_in | stop_in).select(
            F.when(start_in, F.col("start_station_name")).alias("start_station_name"),
            F.when(stop_in, F.col("end_station_name")).alias("end_station_name"),
            "starttime",
            "stoptime",
        )
    flow = station_day_flow(trips, method=method, by_time_of_day=by_time_of_day)
    dim = stations.where(F.col("borough").isNotNull()).select(
        F.col("name").alias("station_name"), "borough", "neighborhood", "latitude", "longitude", "capacity"
    )
    if check_unique_names:
        dim = one_row_each(dim, "station_name")
    joined = flow.join(dim, "station_name")
    rate = M.trips_per_dock("trips_started", "trips_ended", "capacity")
    out = joined.select(
        "trip_date",
        *(["time_of_day"] if by_time_of_day else []),
        "station_name",
        "borough",
        "neighborhood",
        "latitude",
        "longitude",
        "capacity",
        "trips_started",
        "trips_ended",
        "net_flow",
        rate.alias("trips_per_dock"),
        M.flow_stress("net_flow", "capacity").alias("flow_stress_score"),
        M.utilization_status(rate, unknown_label).alias("utilization_status"),
    )
    return out.orderBy("trip_date", "station_name") if sort else out
