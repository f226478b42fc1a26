"""Monthly trip text files with drifting headers -> one canonical trip table.

Reading all files in one ``spark.read.csv`` call takes the header of one file
for every file, so columns land in the wrong place when layouts differ. Here:

1. tasks read the first line of each file, a file a task, normalise its header (lower
   case, blanks -> ``_``) and map it to canonical names; this gives a small written table, a row per file;
2. the driver sees one row per *layout*, not per file: it decides whether an unknown header
   stops the job, and how many cells the widest layout has;
3. all files are read in one scan as lines. Each line meets its file's row (an equi-join on the
   path; the planner broadcasts the small side), is split into cells, and every canonical
   column takes the cell where that file's layout has it (none: null).

So no list of paths goes through the driver, and any file name will do.
The year-month tag comes from the file name (``YYYYMM...``), or, where asked for,
from the folder; files of other months are left out when Spark lists the files. ``file_report`` says of every file
whether it is read and why not, and which columns have no canonical name; a file whose header is unknown
stops the reading unless ``on_unknown="skip"``. Spark's file listing already
skips ``_``/``.``-prefixed folders, and files of no bytes.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator, Mapping
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.constants import FILE_MONTH_PATTERN, HEADER_SYNONYMS
from tripflow.session import scratch_path, ship_package
from tripflow.sources.schemas import TRIP_FIELDS

CSV_GLOB = "*.{csv,CSV}"

# a folder named YYYYMM..., or key=YYYYMM... as Spark's partitioned writers name them
_FOLDER_MONTH = r"^(?:[^=]*=)?(\d{4})(\d{2})"

# one row per file; ``file`` is the path as Spark writes it in a row's metadata
_FILE = pa.schema(
    [("file", pa.string()), ("path", pa.string()), ("year_month", pa.string()), ("status", pa.string()), ("header", pa.string())]
    + [("extras", pa.list_(pa.string())), ("places", pa.list_(pa.int32())), ("extra_places", pa.list_(pa.int32())), ("width", pa.int32())]
    + [("size", pa.int64())]
)
_FILE_DDL = (
    "file string, path string, year_month string, status string, header string, extras array<string>, "
    "places array<int>, extra_places array<int>, width int, size long"
)
EXTRA_CELLS = "extra_cells"
FEW_FILES, LARGE_FILE = 4, 32 << 20  # so few files of a month, or files of so many bytes, are stored one by one
READ_ON = 16  # batches of a file that are passed over before its task stops


def normalise_header(name: str) -> str:
    return name.strip().strip('"').strip().lower().replace(" ", "_")


def month_of(path: str, from_folder: bool = False) -> str | None:
    """``YYYY_MM`` from a file name starting with ``YYYYMM``; with ``from_folder`` else from its folder's name."""
    *_, folder, name = ["", *path.split("/")]
    found = re.match(FILE_MONTH_PATTERN, name) or (re.match(_FOLDER_MONTH, folder) if from_folder else None)
    return f"{found[1]}_{found[2]}" if found else None


def month_column(path: Column, from_folder: bool = False) -> Column:
    """:func:`month_of` as a column expression."""
    parts = F.split(path, "/")
    found = []
    for place, pattern in ((-1, FILE_MONTH_PATTERN), (-2, _FOLDER_MONTH))[: 2 if from_folder else 1]:
        year, month = (F.regexp_extract(F.element_at(parts, place), pattern, n) for n in (1, 2))
        found.append(F.when(year != "", F.concat_ws("_", year, month)))
    return F.coalesce(*found)


def canonical_names(header: str, synonyms: Mapping[str, str] = HEADER_SYNONYMS) -> tuple[list[str], list[str]]:
    """(column names to read the file with, unknown extra columns).

    Raises when two headers of one file map to the same canonical name.
    """
    names, extras, seen = [], [], set()
    for i, raw in enumerate(header.split(",")):
        n = normalise_header(raw)
        c = synonyms.get(n)
        if c is None:
            extras.append(n)
            names.append(f"_extra_{i}_{n}")
            continue
        if c in seen:
            raise ValueError(f"two headers map to {c!r} in layout {header!r}")
        seen.add(c)
        names.append(c)
    return names, extras


def look_at(file: str, header: str, synonyms: Mapping[str, str], month_from_folder: bool) -> dict:
    """What a file's name and first line say about it: a row of ``trip_files``."""
    path, month = unquote(file), month_of(unquote(file), month_from_folder)
    row = {"file": file, "path": path, "year_month": month, "header": header, "extras": [], "places": [], "extra_places": [], "width": 0}
    if month is None:
        return {**row, "status": "no month"}
    try:
        names, extras = canonical_names(header, synonyms)
    except ValueError:
        return {**row, "status": "ambiguous header"}
    status = "empty" if not header.strip() else "unknown header" if len(extras) * 2 > len(names) else "read"
    place = {name: n for n, name in enumerate(names)}
    places = [place.get(f.name, -1) for f in TRIP_FIELDS]
    extra_places = [n for n, name in enumerate(names) if name.startswith("_extra_")]
    return {**row, "status": status, "extras": extras, "places": places, "extra_places": extra_places, "width": len(names)}


def _lines(spark: SparkSession, root: str) -> DataFrame:
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", CSV_GLOB).text(root)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))


def trip_files(
    spark: SparkSession, root: str, synonyms: Mapping[str, str] = HEADER_SYNONYMS, month_from_folder: bool = False
) -> DataFrame:
    """Every CSV file under ``root``: one row per file, from its name and first line (read by tasks), as a written table."""
    # settings of this listing alone: every file is a partition of its own, whatever its size
    alone = spark.newSession()
    for setting in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        alone.conf.set(setting, str(1 << 40))
    known = dict(synonyms)
    ship_package(spark)

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, batch in enumerate(batches):
            if n == 0 and batch.num_rows:
                header, file, size = (batch[c][0].as_py() for c in ("value", "file", "size"))
                yield pa.RecordBatch.from_pylist([{**look_at(file, header, known, month_from_folder), "size": size}], _FILE)
            elif n == READ_ON:  # a worker that leaves input unread is not used again, which costs more than a short file
                return

    # only the first line of each file leaves the JVM
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    heads = _lines(alone, root).select(*(F.when(first, F.col(c)).alias(c) for c in ("value", "file", "size")))
    path = scratch_path(spark, "trip-files")
    heads.mapInArrow(first_line, _FILE_DDL).hint("rebalance").write.parquet(path)
    return spark.read.schema(_FILE_DDL).parquet(path)


def read_files(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    *,
    month_from_folder: bool = False,
    on_unknown: str = "raise",
    months: Collection[str] | None = None,
) -> DataFrame:
    """The rows of those ``files`` (of :func:`trip_files`) that can be read, as text columns in canonical order, ``year_month``,
    and ``extra_cells``: how many cells under headers without a canonical name hold something."""
    wanted = files if months is None else files.where(F.col("year_month").isin(*months))
    layouts = wanted.groupBy("status").agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("first"), F.max("width").alias("width"))
    by_status = {r["status"]: r for r in layouts.collect()}
    unknown = [by_status[s] for s in ("unknown header", "ambiguous header") if s in by_status]
    if unknown and on_unknown != "skip":
        raise ValueError(f"{sum(r['files'] for r in unknown)} files have unknown or ambiguous headers, the first is {unknown[0]['first']}")
    width = max(1, by_status["read"]["width"] if "read" in by_status else 1)

    month = month_column(F.col("file"), month_from_folder)
    lines = _lines(spark, root).drop("size").where(month.isin(*months) if months is not None else month.isNotNull())
    read = wanted.where(F.col("status") == "read").select("file", "header", "places", "extra_places", "year_month")
    # a blank line is no row, nor is the header, wherever it stands
    rows = lines.join(read, "file").where((F.trim("value") != "") & (F.col("value") != F.col("header")))
    cells = F.from_csv("value", ", ".join(f"c{n} string" for n in range(width)), {"mode": "PERMISSIVE"})
    rows = rows.withColumn("_cells", cells).withColumn("_cells", F.array(*(F.col(f"_cells.c{n}") for n in range(width))))
    return rows.select(
        *(F.get("_cells", F.col("places")[n]).alias(f.name) for n, f in enumerate(TRIP_FIELDS)),
        "year_month",
        F.size(F.filter("extra_places", lambda p: F.get("_cells", p).isNotNull())).alias(EXTRA_CELLS),
    )


def in_small_files(files: DataFrame, months: Collection[str] | None = None) -> bool:
    """Whether some month (of ``months``, where given) lies in many small ones of ``files`` (of :func:`trip_files`). Rows of
    such a month are worth dealing to one task; else each task that reads a part of a file may store it."""
    read = files.where("status = 'read'")
    by_month = (read if months is None else read.where(F.col("year_month").isin(*months))).groupBy("year_month")
    small = by_month.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).where((F.col("n") > FEW_FILES) & (F.col("bytes") < F.col("n") * LARGE_FILE))
    return not small.isEmpty()


def read_trip_files(
    spark: SparkSession,
    root: str,
    synonyms: Mapping[str, str] = HEADER_SYNONYMS,
    *,
    month_from_folder: bool = False,
    on_unknown: str = "raise",
    months: Collection[str] | None = None,
) -> DataFrame:
    """All trip files under ``root`` (of ``months``, where given) as text columns in canonical
    order, plus ``year_month``. :func:`tripflow.operators.cleaning.clean_trips` types it.

    Files without a month in their name are not trip files; ``file_report`` lists
    them. A header that is unknown or ambiguous raises, or with ``on_unknown="skip"``
    leaves the file out.
    """
    files = trip_files(spark, root, synonyms, month_from_folder)
    rows = read_files(spark, root, files, month_from_folder=month_from_folder, on_unknown=on_unknown, months=months)
    return rows.drop(EXTRA_CELLS)


def file_report(
    spark: SparkSession, root: str, synonyms: Mapping[str, str] = HEADER_SYNONYMS, month_from_folder: bool = False
) -> DataFrame:
    """One row per file: path, year_month, status, header, and the columns without a canonical name."""
    return trip_files(spark, root, synonyms, month_from_folder).select("path", "year_month", "status", "header", "extras")
