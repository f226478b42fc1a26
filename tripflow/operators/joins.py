"""Dimension joins by coordinates. The planner chooses the join from the tables' sizes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.constants import EARTH_RADIUS_M
from tripflow.functions.geo import haversine_m, snap, valid_point


def one_row_each(df: DataFrame, key: str) -> DataFrame:
    """``df`` with a check, made while the rows are read, that ``key`` does not repeat.

    A repeated key fails the query instead of multiplying the rows joined to it. Rows without a key
    match nothing and are left out.
    """
    rest = [c for c in df.columns if c != key]
    grouped = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row"))
    message = F.concat(F.lit(f"{key} repeats: "), F.col(key).cast("string"))
    checked = F.when(F.col("_n") == 1, F.col("_row")).otherwise(F.raise_error(message))
    return grouped.select(key, checked.alias("_row")).select(key, "_row.*")


def match_stations(
    trips: DataFrame,
    stations: DataFrame,
    lat: str,
    lon: str,
    out_prefix: str,
    keep: list[str],
    how: str = "cell",
    decimals: int = 3,
    max_distance_m: float | None = None,
    join_type: str = "inner",
) -> DataFrame:
    """Attach station attributes ``keep`` to each trip by its coordinates.

    ``how="cell"``: station whose coordinates agree with the trip's at
    ``decimals`` places (several stations in a cell give several rows, none
    drops the trip under an inner join).

    ``how="nearest"``: the closest station within ``max_distance_m``, which is
    required; of equally close ones the first by ``keep``. Trips without valid
    coordinates have none.
    """
    if how == "cell":
        st = stations.select(
            snap(F.col("latitude"), decimals).alias("_slat"),
            snap(F.col("longitude"), decimals).alias("_slon"),
            *[F.col(c).alias(f"{out_prefix}{c}") for c in keep],
        )
        keyed = trips.withColumn("_tlat", snap(F.col(lat), decimals)).withColumn("_tlon", snap(F.col(lon), decimals))
        out = keyed.join(st, (keyed["_tlat"] == st["_slat"]) & (keyed["_tlon"] == st["_slon"]), join_type)
        return out.drop("_tlat", "_tlon", "_slat", "_slon")
    if how != "nearest":
        raise ValueError(f"unknown how {how!r}")
    if max_distance_m is None or max_distance_m <= 0:
        raise ValueError("nearest needs max_distance_m: it decides how far to look")
    return _nearest(trips, stations, lat, lon, out_prefix, keep, max_distance_m, join_type)


def _nearest(trips, stations, lat, lon, out_prefix, keep, max_distance_m, join_type) -> DataFrame:
    """Every station offers itself to all grid cells that a point within reach of it can lie in.

    A cell is as high as the reach. Meridians close up with latitude, so a station
    reaches over more cells sideways; columns count around the globe. Each trip meets
    its cell's stations as one array, so the trips are joined once, on the cell.
    """
    reach = math.degrees(max_distance_m / EARTH_RADIUS_M) * (1 + 1e-9)  # rounding must not shorten it
    around = max(1, math.floor(360 / reach))  # columns of the grid; each at least as wide as the reach
    width = 360 / around
    row = lambda c: F.floor(c / F.lit(reach)).cast("long")
    column = lambda c: F.pmod(F.floor((c + F.lit(180.0)) / F.lit(width)), F.lit(around)).cast("long")
    # the widest difference of longitude within reach, from the sine of the reach and the latitude's cosine
    ratio = F.lit(math.sin(math.radians(min(reach, 90.0)))) / F.cos(F.radians(F.col("latitude")))
    sideways = F.when((F.abs(F.col("latitude")) + reach >= 90) | (ratio >= 1), F.lit(180.0)).otherwise(F.degrees(F.asin(ratio)))
    steps = F.least(F.ceil(sideways / F.lit(width)), F.lit(around // 2 + 1)).cast("long")
    cells = (
        stations.where(valid_point("latitude", "longitude"))
        .withColumn("_cx", F.explode(F.sequence(row(F.col("latitude")) - 1, row(F.col("latitude")) + 1)))
        .withColumn("_cy", F.explode(F.array_distinct(F.transform(F.sequence(-steps, steps), lambda s: F.pmod(column(F.col("longitude")) + s, F.lit(around))))))
        .groupBy("_cx", "_cy")
        .agg(F.collect_list(F.struct("latitude", "longitude", F.struct(*keep).alias("row"))).alias("_near"))
    )
    # a null cell matches nothing, whether coordinates are missing or out of range
    here = valid_point(lat, lon)
    keyed = trips.withColumn("_cx", F.when(here, row(F.col(lat).cast("double")))).withColumn("_cy", F.when(here, column(F.col(lon).cast("double"))))
    distances = F.transform(
        "_near", lambda s: F.struct(haversine_m(F.col(lat), F.col(lon), s["latitude"], s["longitude"]).alias("d"), s["row"].alias("row"))
    )
    best = F.array_min(F.filter(distances, lambda s: s["d"] <= max_distance_m))
    out = keyed.join(cells, ["_cx", "_cy"], "left").withColumn("_best", best)
    if join_type == "inner":
        out = out.where(F.col("_best").isNotNull())
    elif join_type != "left":
        raise ValueError(f"nearest joins are inner or left, not {join_type!r}")
    return out.select(*trips.columns, *[F.col(f"_best.row.{c}").alias(f"{out_prefix}{c}") for c in keep])
