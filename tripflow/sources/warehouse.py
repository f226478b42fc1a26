"""Generic table sources: query results, tables, partitioned files, load guards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_source(
    spark: SparkSession,
    *,
    query: str | None = None,
    table: str | None = None,
    path: str | None = None,
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """One entry point for "load the result of a query / a table / some files".

    ``query`` runs through Spark SQL over registered tables, or, with ``fmt``, in the
    source which that connector reaches. ``fmt`` may name any data source whose
    connector is on the classpath; files are Parquet unless it says otherwise.
    """
    if query is not None:
        return spark.sql(query) if fmt is None else spark.read.format(fmt).options(**(options or {})).option("query", query).load()
    if table is not None:
        return spark.table(table)
    if path is None:
        raise ValueError("give query, table or path")
    return spark.read.format(fmt or "parquet").options(**(options or {})).load(path)


def read_years(spark: SparkSession, path: str, first: int, last: int, year_column: str = "year", fmt: str = "parquet") -> DataFrame:
    """Files partitioned by ``year=`` (or carrying a text/int year column),
    limited to ``first..last``; on a partition column the range prunes folders."""
    df = spark.read.format(fmt).load(path)
    return df.where(F.col(year_column).cast("int").between(first, last))


def read_wildcard(
    spark: SparkSession, pattern: str, first: str | None = None, last: str | None = None, suffix_column: str = "table_suffix"
) -> DataFrame:
    """Sibling tables as one: all catalog tables whose name is ``pattern`` with something for its one ``*``, which
    becomes the column ``suffix_column``. ``first`` and ``last`` bound the suffixes (as text, both included): other tables are not
    opened, so their files are not even listed. A column that a table lacks is null there.

    A later filter on ``suffix_column`` also leaves tables out, as it is a constant in each.
    """
    before, star, after = pattern.rpartition(".")[2].partition("*")
    if star != "*" or "*" in after:
        raise ValueError(f"{pattern!r} needs one * in the table's name")
    database = pattern.rpartition(".")[0]
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES {'IN ' + database if database else ''} LIKE '{before}*{after}'").collect()]
    suffixes = sorted(n[len(before) : len(n) - len(after)] for n in names if len(n) > len(before) + len(after))
    wanted = [s for s in suffixes if (first is None or s >= first) and (last is None or s <= last)]
    if not wanted:
        raise ValueError(f"no table is named {pattern} between {first} and {last}")
    out = None
    for suffix in wanted:
        name = f"`{before}{suffix}{after}`"
        part = spark.table(f"{database}.{name}" if database else name).withColumn(suffix_column, F.lit(suffix))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def table_has_rows(spark: SparkSession, name: str) -> bool:
    """True when ``name`` exists and holds at least one row (reads one row at most)."""
    return spark.catalog.tableExists(name) and not spark.table(name).isEmpty()
