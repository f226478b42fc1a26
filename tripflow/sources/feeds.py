"""JSON feeds (station information/status) and GeoJSON area files, read by Spark."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, MapType, StringType, StructField, StructType

POLYGON = ArrayType(ArrayType(ArrayType(DoubleType())))
MULTIPOLYGON = ArrayType(POLYGON)

# A FeatureCollection; coordinates kept as JSON text until the geometry type is known
_FEATURES = StructType(
    [
        StructField(
            "features",
            ArrayType(
                StructType(
                    [
                        StructField("properties", MapType(StringType(), StringType())),
                        StructField(
                            "geometry",
                            StructType([StructField("type", StringType()), StructField("coordinates", StringType())]),
                        ),
                    ]
                )
            ),
        )
    ]
)


def read_station_feed(spark: SparkSession, path: str) -> DataFrame:
    """Records of a ``{"data": {"stations": [...]}}`` feed file (or folder of them); a task reads a file."""
    doc = spark.read.option("multiLine", True).json(path)
    return doc.select(F.explode("data.stations").alias("s")).select("s.*")


def read_area_features(
    spark: SparkSession,
    path: str,
    names: Mapping[str, str] = {"boroname": "borough", "ntaname": "neighborhood"},
    id_property: str | None = None,
) -> DataFrame:
    """GeoJSON features -> (area_id, <renamed name properties>, geometry as MultiPolygon).

    A Polygon is wrapped as a one-part MultiPolygon; other geometry types are
    dropped. ``area_id`` is the ``id_property`` value when given, else the file's
    path and the feature's place in it: two features of equal geometry differ. A
    multi-line JSON document is read by one task, as its format has no split points.
    """
    doc = spark.read.schema(_FEATURES).option("multiLine", True).json(path)
    f = doc.select(F.col("_metadata.file_path").alias("file"), F.posexplode("features").alias("place", "f")).select(
        "file", "place", "f.properties", "f.geometry"
    )
    gtype = F.col("geometry.type")
    coords = F.col("geometry.coordinates")
    geometry = (
        F.when(gtype == "MultiPolygon", F.from_json(coords, MULTIPOLYGON))
        .when(gtype == "Polygon", F.array(F.from_json(coords, POLYGON)))
    )
    area_id = F.col("properties")[id_property] if id_property else F.concat_ws("#", "file", "place")
    return f.where(gtype.isin("Polygon", "MultiPolygon")).select(
        area_id.alias("area_id"),
        *[F.col("properties")[k].alias(v) for k, v in names.items()],
        geometry.alias("geometry"),
    )
