"""Writers for the trip store and the marts.

* ``write_partitioned``: Parquet partitioned by a tag column with *dynamic*
  overwrite, so reloading one month replaces exactly that month's folder and
  leaves the others (no stale part files, idempotent on retry).
* ``write_by_day``: the layout the trip table is meant to have: one folder
  per start day, rows clustered by bike inside each file. Rows are rebalanced by
  day, so the number of tasks follows the data and a busy day is split over several.
* ``register_table``: a catalog table over written files (re-created, and
  partitions discovered).
* ``save_table`` / ``save_with_schema``: managed tables, optionally cast to a
  declared schema by column name.
* ``publish_if_rows``: publish a staged write only if it has rows, which are counted
  during the write itself (``observe``); ``write_if_rows``: the same for any writer, with a probe.

``sinks.publish`` has the loads that readers see whole or not at all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripflow.sinks.publish import home_of, home_of_path, remove, stage


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("year_month",), fmt: str = "parquet", gather: bool = True
) -> int:
    """Returns the rows written, counted while they are; an empty input touches no folder. ``gather=False`` moves no rows: for an
    input whose tasks hold few partition values each, as each writes a file for every value that it has."""
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("n"))
    (
        # rows of a partition value go to one task (AQE splits a heavy one), so
        # each folder gets a few files instead of one per input task
        (df.hint("rebalance", *partition_by) if gather else df)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .save(path)
    )
    return int(seen.get["n"])


def write_by_day(df: DataFrame, path: str, day: str = "start_day", cluster_by: str = "bikeid") -> None:
    (
        df.hint("rebalance", day)
        .sortWithinPartitions(day, cluster_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def save_bucketed(df: DataFrame, name: str, by: str, buckets: int, path: str | None = None) -> None:
    """A table whose rows are dealt into ``buckets`` files by a hash of ``by``, each sorted by it.

    Aggregates and joins on ``by`` need no exchange, joins to another table of as many buckets neither, and a
    lookup of one value opens one file. A file is written by one task: choose ``buckets`` so that one holds what a task can sort.
    """
    writer = df.repartition(buckets, by).write.mode("overwrite").bucketBy(buckets, by).sortBy(by)
    (writer if path is None else writer.option("path", path)).saveAsTable(name)


def register_table(spark: SparkSession, name: str, path: str, partitioned: bool = True, fmt: str = "parquet") -> None:
    """A table over written files. One that lies there already only learns of new partitions; it is never away."""
    if not spark.catalog.tableExists(name) or home_of(spark, name) != home_of_path(spark, path):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{path}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def save_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    df.write.format(fmt).mode(mode).saveAsTable(name)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its order, cast by name; missing ones are null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def save_with_schema(df: DataFrame, name: str, schema: StructType) -> None:
    """Drop and recreate ``name`` with the declared schema, then load ``df``."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    conform(df, schema).write.mode("overwrite").saveAsTable(name)


def publish_if_rows(df: DataFrame, root: str, publish: Callable[[str], None], partition_by: Sequence[str] = (), fmt: str = "parquet") -> int:
    """Writes ``df`` once to a fresh folder under ``root`` and calls ``publish`` with it if it has rows; a folder without rows is
    removed. Returns the number of rows.

    The count comes from the write itself: the input is read once, and not probed before.
    """
    folder, n = stage(df, root, partition_by, fmt)
    if n:
        publish(folder)
    else:
        remove(df.sparkSession, folder)
    return n


def write_if_rows(df: DataFrame, write: Callable[[DataFrame], None], name: str = "rows") -> int:
    """Run ``write``, which writes where it likes, unless ``df`` is empty; returns the number of rows written.

    Nothing is staged, so emptiness is probed first (``isEmpty``, which stops at the first row);
    where a fresh folder will do, ``publish_if_rows`` reads the input only once.
    """
    if df.isEmpty():
        return 0
    obs = Observation(name)
    write(df.observe(obs, F.count(F.lit(1)).alias("n")))
    return int(obs.get["n"])
