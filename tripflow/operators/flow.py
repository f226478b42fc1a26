"""Station-day trip counts: started, ended, net flow.

Two plans give the same rows:

* ``single_pass`` (default): each trip is turned into two rows, (start station,
  start day, 1, 0) and (end station, stop day, 0, 1), by ``inline`` inside the
  scan stage, then one ``groupBy``. One scan of the trips, one shuffle, and the
  partial (map-side) aggregate collapses a hot station before the shuffle.
* ``full_outer``: the textbook form, two aggregates joined by a full outer join
  on (station, day): two scans, two aggregate shuffles, a sort-merge join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.calendar import time_of_day
from tripflow.functions.metrics import net_flow


def station_day_flow(
    trips: DataFrame,
    method: str = "single_pass",
    start_station: str = "start_station_name",
    end_station: str = "end_station_name",
    start_time: str = "starttime",
    stop_time: str = "stoptime",
    by_time_of_day: bool = False,
    also: Sequence[str] = (),
) -> DataFrame:
    """Rows: station_name, trip_date, trips_started, trips_ended, net_flow; with
    ``by_time_of_day`` (single pass) one for each time of day, which comes as a column,
    and likewise for each value of the trip columns ``also``.

    A trip with a null station name or time contributes nothing on that side,
    in both methods (a null key never matches in the outer join, so it is
    removed up front rather than kept as an unmatched row).
    """
    key = ["station_name", "trip_date", *(["time_of_day"] if by_time_of_day else []), *also]
    band = lambda t: [time_of_day(t).alias("time_of_day")] if by_time_of_day else []
    if method == "single_pass":
        sides = trips.select(
            F.inline(
                F.array(
                    F.struct(
                        F.col(start_station).alias("station_name"),
                        F.to_date(F.col(start_time)).alias("trip_date"),
                        *band(start_time),
                        *also,
                        F.lit(1).alias("s"),
                        F.lit(0).alias("e"),
                    ),
                    F.struct(
                        F.col(end_station).alias("station_name"),
                        F.to_date(F.col(stop_time)).alias("trip_date"),
                        *band(stop_time),
                        *also,
                        F.lit(0).alias("s"),
                        F.lit(1).alias("e"),
                    ),
                )
            )
        ).where(F.col("station_name").isNotNull() & F.col("trip_date").isNotNull())
        counted = sides.groupBy(*key).agg(
            F.sum("s").cast("bigint").alias("trips_started"),
            F.sum("e").cast("bigint").alias("trips_ended"),
        )
    elif method == "full_outer" and not by_time_of_day and not also:
        started = (
            trips.where(F.col(start_station).isNotNull() & F.col(start_time).isNotNull())
            .groupBy(F.col(start_station).alias("station_name"), F.to_date(F.col(start_time)).alias("trip_date"))
            .agg(F.count(F.lit(1)).alias("trips_started"))
        )
        ended = (
            trips.where(F.col(end_station).isNotNull() & F.col(stop_time).isNotNull())
            .groupBy(F.col(end_station).alias("station_name"), F.to_date(F.col(stop_time)).alias("trip_date"))
            .agg(F.count(F.lit(1)).alias("trips_ended"))
        )
        counted = started.join(ended, ["station_name", "trip_date"], "full").select(
            "station_name",
            "trip_date",
            F.coalesce("trips_started", F.lit(0)).cast("bigint").alias("trips_started"),
            F.coalesce("trips_ended", F.lit(0)).cast("bigint").alias("trips_ended"),
        )
    else:
        raise ValueError(f"unknown method {method!r}")
    return counted.select(
        *key,
        "trips_started",
        "trips_ended",
        net_flow("trips_ended", "trips_started").alias("net_flow"),
    )
