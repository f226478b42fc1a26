"""Declared schemas of the canonical tables."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Trip file columns in canonical order, with their target types. Coordinates
# are double: a float32 reading rounds into a different 3-decimal cell than the
# same reading widened to double.
TRIP_FIELDS = [
    StructField("tripduration", IntegerType()),
    StructField("starttime", TimestampNTZType()),
    StructField("stoptime", TimestampNTZType()),
    StructField("start_station_id", IntegerType()),
    StructField("start_station_name", StringType()),
    StructField("start_station_latitude", DoubleType()),
    StructField("start_station_longitude", DoubleType()),
    StructField("end_station_id", IntegerType()),
    StructField("end_station_name", StringType()),
    StructField("end_station_latitude", DoubleType()),
    StructField("end_station_longitude", DoubleType()),
    StructField("bikeid", IntegerType()),
    StructField("usertype", StringType()),
    StructField("birth_year", IntegerType()),
    StructField("gender", StringType()),
]
