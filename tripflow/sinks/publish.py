"""Loads that readers see whole or not at all.

A load is written to a fresh folder first. Its rows are counted in the write itself, and only
then does the catalog point at it: one step for a table, one step for each partition
(``ALTER TABLE ... SET LOCATION``). Until that step readers have the old rows; a load that fails, or
has no rows, leaves them there. Folders that the catalog no longer names stay for queries
that still read them; ``remove_unpublished`` takes them away after a while.

Tables are external: their folders lie under a ``root`` that the caller owns.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_LOAD = "load-"


def _files(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    where, files = _files(spark, path)
    files.delete(where, True)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def stage(df: DataFrame, root: str, partition_by: Sequence[str] = (), fmt: str = "parquet", gather: bool = True) -> tuple[str, int]:
    """Writes ``df`` to a fresh folder under ``root`` and returns the folder and the rows in it.

    One pass: the rows are counted while they are written. With ``partition_by``, rows of a value go to
    few tasks (AQE splits a heavy one), unless ``gather`` is False: for an input whose tasks hold few values each. A failed
    write leaves no folder.
    """
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/{_LOAD}{int(time.time())}-{uuid.uuid4().hex[:12]}"
    seen = Observation()
    out = df.hint("rebalance", *partition_by) if partition_by and gather else df
    try:
        out.observe(seen, F.count(F.lit(1)).alias("n")).write.format(fmt).partitionBy(*partition_by).save(folder)
    except BaseException:
        remove(spark, folder)
        raise
    return folder, int(seen.get["n"])


def publish_table(df: DataFrame, table: str, root: str, fmt: str = "parquet") -> int:
    """Replaces the rows of ``table`` by those of ``df`` in one catalog step, and returns how many there are. The table is
    made if need be; without rows nothing changes. A table keeps its columns: a load with others fails."""
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if exists and _columns(spark.table(table).schema) != _columns(df.schema):
        raise ValueError(f"{table} has the columns {_columns(spark.table(table).schema)}, the load {_columns(df.schema)}")
    folder, n = stage(df, root, fmt=fmt)
    if n == 0:
        remove(spark, folder)
    elif exists:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(folder)}")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"CREATE TABLE {table} ({_columns(df.schema)}) USING {fmt} LOCATION {_text(folder)}")
    return n


def _written_partitions(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Paths like ``year_month=2015_01`` below a load's folder."""
    found = [""]
    for _ in range(depth):
        deeper = []
        for name in found:
            where, files = _files(spark, f"{folder}/{name}")
            deeper += [f"{name}/{s.getPath().getName()}".lstrip("/") for s in files.listStatus(where) if "=" in s.getPath().getName()]
        found = deeper
    return sorted(found)


def _spec(path: str) -> str:
    """The partition that a path below a load's folder names, in SQL."""
    parts = []
    for part in path.split("/"):
        name, value = part.split("=", 1)
        parts.append(f"`{name}`=" + ("NULL" if value == "__HIVE_DEFAULT_PARTITION__" else _text(unquote(value))))
    return ", ".join(parts)


def publish_partitions(
    df: DataFrame, table: str, root: str, partition_by: Sequence[str] = ("year_month",), fmt: str = "parquet", gather: bool = True
) -> int:
    """Replaces those partitions of ``table`` that ``df`` has rows for, each in one catalog step; others stay. Returns the rows written.
    ``gather`` is :func:`stage`'s.

    A reader has the old or the new rows of a partition. Several partitions change one after the other.
    """
    spark = df.sparkSession
    own = [c for c in df.columns if c not in partition_by]
    df = df.select(*own, *partition_by)
    exists = spark.catalog.tableExists(table)
    if exists and _columns(spark.table(table).schema) != _columns(df.schema):
        raise ValueError(f"{table} has the columns {_columns(spark.table(table).schema)}, the load {_columns(df.schema)}")
    folder, n = stage(df, root, partition_by, fmt, gather)
    if n == 0:
        remove(spark, folder)
        return 0
    if not exists:
        parts = ", ".join(f"`{c}`" for c in partition_by)
        spark.sql(f"CREATE TABLE {table} ({_columns(df.schema)}) USING {fmt} PARTITIONED BY ({parts}) LOCATION {_text(root)}")
    paths = _written_partitions(spark, folder, len(partition_by))
    known = {unquote(r[0]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    new = [p for p in paths if unquote(p) not in known]
    for path in paths:
        if path not in new:
            spark.sql(f"ALTER TABLE {table} PARTITION ({_spec(path)}) SET LOCATION {_text(f'{folder}/{path}')}")
    if new:
        added = " ".join(f"PARTITION ({_spec(p)}) LOCATION {_text(f'{folder}/{p}')}" for p in new)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    spark.catalog.refreshTable(table)
    return n


def _metadata(spark: SparkSession, table: str):
    state = spark._jsparkSession.sessionState()
    name = state.sqlParser().parseTableIdentifier(table)
    return state.catalog(), name, state.catalog().getTableMetadata(name)


def home_of(spark: SparkSession, table: str) -> str:
    """The folder that the catalog names for a table."""
    return _metadata(spark, table)[2].location().getPath().rstrip("/")


def home_of_path(spark: SparkSession, path: str) -> str:
    """A folder as :func:`home_of` writes it."""
    where, files = _files(spark, path)
    return files.makeQualified(where).toUri().getPath().rstrip("/")


def published(spark: SparkSession, table: str) -> list[str]:
    """The folders that the catalog names for a table's rows: its partitions', or its own."""
    catalog, name, meta = _metadata(spark, table)
    if meta.partitionColumnNames().isEmpty():
        return [home_of(spark, table)]
    parts = catalog.listPartitions(name, spark.sparkContext._jvm.scala.Option.empty())
    return [parts.apply(n).location().getPath() for n in range(parts.size())]


def remove_unpublished(spark: SparkSession, table: str, root: str, older_than: float = 86_400.0) -> list[str]:
    """Removes the loads under ``root`` that began over ``older_than`` seconds ago and that no part of the table lies in. Returns
    the folders' names. A load counts as a whole: it goes when its last partition was replaced."""
    where, files = _files(spark, root)
    used = published(spark, table)
    gone = []
    for status in files.listStatus(where) if files.exists(where) else []:
        path = status.getPath()
        name = path.getName()
        if not name.startswith(_LOAD) or time.time() - int(name.split("-")[1]) < older_than:
            continue
        if not any(f"/{name}/" in f"{u}/" for u in used):
            files.delete(path, True)
            gone.append(name)
    return gone
