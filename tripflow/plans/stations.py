"""Station dimension: live station feeds placed into neighbourhood areas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tripflow.functions.cleaning import textual_null, to_whole_number
from tripflow.operators.spatial import points_in_areas
from tripflow.sinks.writers import save_with_schema
from tripflow.sources.feeds import read_area_features, read_station_feed

# The columns of the station table
STATION_SCHEMA = StructType(
    [
        StructField("station_id", StringType()),
        StructField("name", StringType()),
        StructField("short_name", StringType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("region_id", LongType()),
        StructField("capacity", LongType()),
        StructField("borough", StringType()),
        StructField("neighborhood", StringType()),
    ]
)
REQUIRED = tuple(f.name for f in STATION_SCHEMA.fields)


def station_dimension(
    information: DataFrame,
    status: DataFrame,
    areas: DataFrame,
    cell_size: float = 0.01,
    required: Sequence[str] = REQUIRED,
    status_join: str = "semi",
) -> DataFrame:
    """Typed station table (``STATION_SCHEMA``).

    * only stations that appear in ``status`` are kept; with ``status_join="semi"`` status only
      filters, so a repeated status id does not repeat the station (its keys are
      de-duplicated map-side before the semi join); with ``"inner"`` a station appears once
      for each of its status rows, which are counted before the join;
    * ``lat``/``lon`` become ``latitude``/``longitude``;
    * borough and neighbourhood come from the area containing the station
      (``areas``: ``area_id``, ``borough``, ``neighborhood``, ``geometry``);
      a station in several areas appears once per area;
    * ``region_id`` and ``capacity`` are coerced to integers (bad text -> null);
    * rows with a null (or textual-null area name) in ``required`` are dropped.
    """
    if status_join not in ("semi", "inner"):
        raise ValueError(f"status is joined semi or inner, not {status_join!r}")
    ids = status.select(F.col("station_id").cast("string").alias("station_id"))
    if status_join == "semi":
        met = information.join(ids.distinct(), "station_id", "left_semi")
    else:
        times = ids.groupBy("station_id").agg(F.count(F.lit(1)).cast("int").alias("_times"))
        met = information.join(times, "station_id").withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    s = met.select(
        F.col("station_id").cast("string").alias("station_id"),
        "name",
        "short_name",
        F.col("lat").cast("double").alias("latitude"),
        F.col("lon").cast("double").alias("longitude"),
        "region_id",
        "capacity",
    )
    placed = points_in_areas(
        s, areas.select("area_id", "borough", "neighborhood", "geometry"), cell_size, ["borough", "neighborhood"]
    ).drop("area_id")
    typed = placed.select(
        "station_id",
        "name",
        "short_name",
        "latitude",
        "longitude",
        to_whole_number("region_id").alias("region_id"),
        to_whole_number("capacity").alias("capacity"),
        textual_null("borough").alias("borough"),
        textual_null("neighborhood").alias("neighborhood"),
    )
    return typed.dropna(subset=list(required)).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in STATION_SCHEMA.fields]
    )


def load_stations(spark: SparkSession, feeds: str, table: str, cell_size: float = 0.01) -> DataFrame:
    """Station job: the feeds ``information``, ``status`` and ``areas`` under one folder, to the
    saved table with the declared schema, which is returned."""
    stations = station_dimension(
        read_station_feed(spark, f"{feeds}/information"),
        read_station_feed(spark, f"{feeds}/status"),
        read_area_features(spark, f"{feeds}/areas"),
        cell_size=cell_size,
    )
    save_with_schema(stations, table, STATION_SCHEMA)
    return spark.table(table)
