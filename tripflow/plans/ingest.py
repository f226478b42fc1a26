"""Trip ingest job: landed text files -> typed, month-partitioned Parquet store."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripflow.operators.cleaning import MART_REQUIRED, clean_trips
from tripflow.sinks.publish import publish_partitions
from tripflow.sinks.writers import register_table, write_partitioned
from tripflow.sources.schemas import TRIP_FIELDS
from tripflow.sources.trip_files import EXTRA_CELLS, in_small_files, read_files, trip_files


@dataclass(frozen=True)
class IngestReport:
    """What an ingest did: rows stored; rows read and rejected, by cause (see ``clean_trips``); files by status."""

    rows: int
    counts: dict[str, int]
    files: dict[str, int]

    def frame(self, spark: SparkSession) -> DataFrame:
        """The report as rows (``measure``, ``n``)."""
        rows = {"rows_stored": self.rows, **self.counts, **{f"files: {k}": n for k, n in self.files.items()}}
        return spark.createDataFrame(sorted(rows.items()), "measure string, n long")


def ingest_report(
    spark: SparkSession,
    landing: str,
    store: str,
    required: Sequence[str] | str = MART_REQUIRED,
    table: str | None = None,
    *,
    publish: str | None = None,
    month_from_folder: bool = False,
    on_unknown: str = "raise",
    months: Collection[str] | None = None,
) -> IngestReport:
    """Reads every trip file under ``landing`` (of ``months``, where given), cleans it and stores it by ``year_month``. Months
    present in the input replace those stored; other months stay. Without rows nothing is touched. One pass over
    the lines: all counts come from the write itself. A file holds rows of one month, so no row is moved, unless months
    lie in many small files.

    With ``publish``, a table's name, each load is a new folder under ``store``, and each of its months is published in one
    step: readers of the table see the old or the new month. Else ``store`` is the store itself, where
    a month's folder is overwritten while it may be read; ``table`` is then a table over it.
    """
    files = trip_files(spark, landing, month_from_folder=month_from_folder)
    raw = read_files(spark, landing, files, month_from_folder=month_from_folder, on_unknown=on_unknown, months=months)
    seen = Observation()
    trips = clean_trips(raw, required, seen, EXTRA_CELLS)
    gather = in_small_files(files, months)
    if publish is not None:
        n = publish_partitions(trips, publish, store, gather=gather)
    else:
        n = write_partitioned(trips, store, gather=gather)
        if table is not None and n:
            register_table(spark, table, store)
    wanted = files if months is None else files.where(F.col("year_month").isin(*months))
    by_status = wanted.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()
    return IngestReport(n, {k: int(v) for k, v in seen.get.items()}, {r["status"]: r["n"] for r in by_status})


def ingest_trip_files(spark: SparkSession, landing: str, store: str, *args, **how) -> int:
    """:func:`ingest_report`, of which it returns the number of rows stored (0 = nothing touched)."""
    return ingest_report(spark, landing, store, *args, **how).rows


# --- rendering trips back to text, as monthly landed files -----------------------------


def title_header(name: str) -> str:
    """The title-case header of a column, e.g. ``Start Station ID``."""
    split = {"tripduration": "trip_duration", "starttime": "start_time", "stoptime": "stop_time", "bikeid": "bike_id", "usertype": "user_type"}
    return split.get(name, name).replace("_", " ").title().replace(" Id", " ID")


def land_as_text(trips: DataFrame, landing: str) -> None:
    """Write trips as monthly CSV folders in two layouts: even months with
    lower-case headers and ISO times carrying fractional seconds, odd months
    with title-case headers, the columns in reverse order and US times without
    seconds. Folder names carry the month (``month=YYYYMM-x``). One write, so the
    trips are computed once for each layout's files only. Rows that have a ``month`` (``YYYYMM``) are
    dealt by it already; others are dealt here, before they are text."""
    if "month" not in trips.columns:
        # one task per month folder (AQE splits a heavy month), not every task into every folder
        trips = trips.withColumn("month", F.date_format("starttime", "yyyyMM")).hint("rebalance", "month")
    even = F.month("starttime") % 2 == 0
    iso = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit(".250"))
    us = lambda c: F.date_format(c, "M/d/yyyy H:mm")
    names = [f.name for f in TRIP_FIELDS]
    text = lambda c, time: time(c) if c in ("starttime", "stoptime") else F.col(c).cast("string")
    lower = [text(c, iso).alias(c) for c in names]
    title = [text(c, us).alias(title_header(c)) for c in reversed(names)]
    for part, own, suffix, columns in (("lower", even, "-a", lower), ("title", ~even, "-b", title)):
        # the writer wants rows by folder; sorting them before they are text takes less memory
        df = trips.where(own).withColumn("month", F.concat("month", F.lit(suffix))).sortWithinPartitions("month")
        df.select(*columns, "month").write.mode("overwrite").option("header", True).partitionBy("month").csv(f"{landing}/{part}")


def header_examples(orders: DataFrame, landing: str) -> None:
    """Orders rendered as trip files of three layouts: lower-case headers; title-case headers in
    another order, in a folder whose name has a space; and some columns only, with one that has
    no canonical name. Cells are null, blank, quoted with commas and not numbers."""
    key = F.col("o_orderkey")
    time = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    cells = {
        "tripduration": F.when(key % 5 == 0, F.lit("bad")).otherwise((key % 3600).cast("string")),
        "starttime": time,
        "start_station_name": F.concat(F.lit("St "), (key % 7).cast("string"), F.lit(", North")),
        "bikeid": F.when(key % 4 != 0, F.col("o_custkey").cast("string")),
        "usertype": F.col("o_orderpriority"),
    }
    month = F.date_format("o_orderdate", "yyyyMM").alias("month")
    layouts = {
        "lower": [cells[c].alias(c) for c in cells],
        "with space": [cells[c].alias(title_header(c)) for c in reversed(cells)],
        "extra": [cells["bikeid"].alias("Bike ID"), F.lit("red").alias("Color"), time.alias("Start Time")],
    }
    for n, (folder, columns) in enumerate(layouts.items()):
        part = orders.where(key % 3 == n).select(*columns, month)
        part.hint("rebalance", "month").write.option("header", True).partitionBy("month").csv(f"{landing}/{folder}")


def name_by_month(spark: SparkSession, folders: str, landing: str) -> None:
    """Files under ``month=<YYYYMM>`` folders get names that begin with the month, in one folder; a name each, on the driver."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folders).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(landing))
    for folder in files.listStatus(path(folders)):
        month = folder.getPath().getName().rpartition("=")[2]
        parts = [f.getPath() for f in files.listStatus(folder.getPath()) if f.getPath().getName().endswith(".csv")] if folder.isDirectory() else []
        for n, part in enumerate(parts):
            files.rename(part, path(f"{landing}/{month}trips [{n}].csv"))


def flawed_examples(orders: DataFrame, landing: str) -> None:
    """Orders rendered as trip files that carry the month in their names, which hold brackets and spaces: cells that are
    null or not of their column's type, and a column without a canonical name. Beside them lie a
    file with an unknown header and one without a month."""
    key = F.col("o_orderkey")
    cells = {
        "Trip Duration": F.when(key % 5 == 0, "bad").when(key % 7 != 0, F.concat((key % 3600).cast("string"), F.when(key % 3 == 0, ".0").otherwise(""))),
        "Start Time": F.when(key % 11 == 0, "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
        "Colour": F.when(key % 2 == 0, "red"),
        "Bike ID": F.when(key % 4 != 0, F.col("o_custkey").cast("string")),
        "User Type": F.col("o_orderpriority"),
        "Birth Year": F.when(key % 13 == 0, "19x0").otherwise((1940 + key % 60).cast("string")),
    }
    spark = orders.sparkSession
    months = orders.select(*(c.alias(n) for n, c in cells.items()), F.date_format("o_orderdate", "yyyyMM").alias("month"))
    months.hint("rebalance", "month").write.option("header", True).partitionBy("month").csv(f"{landing}-folders")
    name_by_month(spark, f"{landing}-folders", landing)
    levels = orders.groupBy(F.col("o_orderpriority").alias("level")).agg(F.count(F.lit(1)).alias("orders"))
    for name in ("month=190001", "month=notes"):
        levels.coalesce(1).write.option("header", True).csv(f"{landing}-levels/{name}")
    name_by_month(spark, f"{landing}-levels", landing)
