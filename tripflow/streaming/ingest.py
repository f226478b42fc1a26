"""Incremental trip ingest with Structured Streaming.

The year-by-year batch loop becomes a file stream: each run picks up the files
landed since the last run (the checkpoint remembers which were done). The months
they belong to are ingested anew from all their landed files by the batch job, so
stream and batch keep one store, with the same rows whichever ran last, and a
batch that is retried replaces its own output. ``trigger(availableNow=True)``
processes what is there and stops, so the same job serves scheduled runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripflow.plans.ingest import ingest_trip_files
from tripflow.sources.trip_files import CSV_GLOB, month_column

_FILE = "path string, modificationTime timestamp, length long, content binary"


def start_trip_stream(
    spark: SparkSession, landing: str, store: str, checkpoint: str, available_now: bool = True, month_from_folder: bool = False, **how
) -> StreamingQuery:
    """``how`` goes to :func:`ingest_trip_files`."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("pathGlobFilter", CSV_GLOB)
        .option("recursiveFileLookup", True)
        .load(landing)
        .select("path")  # contents are not read
    )

    def ingest(batch: DataFrame, _: int) -> None:
        # one row per month
        months = {r[0] for r in batch.select(month_column(F.col("path"), month_from_folder)).distinct().collect()} - {None}
        if months:
            ingest_trip_files(batch.sparkSession, landing, store, months=months, month_from_folder=month_from_folder, **how)

    writer = files.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_trip_stream_once(spark: SparkSession, landing: str, store: str, checkpoint: str, **how) -> None:
    """Ingest everything landed since the last run, then return."""
    start_trip_stream(spark, landing, store, checkpoint, available_now=True, **how).awaitTermination()
