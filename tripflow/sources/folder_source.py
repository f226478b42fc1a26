"""A connector to a folder of Parquet files that takes a query: the data source ``tripflow_folder``.

It stands for warehouses that are reached by a connector with a query text. Options: ``path``, a folder that driver and
executors reach as a local one, and ``query``, SQL of one row at a time (columns, expressions, filters) over the table
``source``. Each file is a partition, and its task runs the query on that file; comparisons
that Spark pushes down become part of it (``spark.sql.python.filterPushdown.enabled``).
"""

from __future__ import annotations

import datetime
import glob
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from tripflow.session import ship_package

FORMAT = "tripflow_folder"
_COMPARISONS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _literal(value) -> str | None:
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return f"'{value}'"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else None


def condition(f: Filter) -> str | None:
    """A pushed filter as SQL, or None where the source leaves it to Spark."""
    column = getattr(f, "attribute", ())
    if len(column) != 1:
        return None
    name = '"' + column[0].replace('"', '""') + '"'
    if isinstance(f, IsNotNull):
        return f"{name} IS NOT NULL"
    if isinstance(f, In):
        values = [_literal(v) for v in f.value]
        return f"{name} IN ({', '.join(values)})" if values and None not in values else None
    value = _literal(f.value) if type(f) in _COMPARISONS else None
    return f"{name} {_COMPARISONS[type(f)]} {value}" if value is not None else None


@dataclass
class _File(InputPartition):
    path: str


def _source(path: str) -> str:
    return "CREATE VIEW source AS SELECT * FROM read_parquet('" + path.replace("'", "''") + "')"


def _batches(path: str, sql: str) -> Iterator[pa.RecordBatch]:
    import duckdb

    with duckdb.connect() as own:
        own.execute(_source(path))
        yield from own.sql(sql).to_arrow_reader(10_000)


class FolderReader(DataSourceReader):
    def __init__(self, path: str, query: str, schema: StructType):
        self.path, self.query, self.schema = path, query, schema
        self.conditions: list[str] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            sql = condition(f)
            if sql is None:
                yield f
            else:
                self.conditions.append(sql)

    def sql(self) -> str:
        return f"SELECT * FROM ({self.query})" + (f" WHERE {' AND '.join(self.conditions)}" if self.conditions else "")

    def partitions(self) -> list[_File]:
        return [_File(p) for p in sorted(glob.glob(f"{glob.escape(self.path)}/**/*.parquet", recursive=True))]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        yield from _batches(partition.path, self.sql())


class FolderSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _path(self) -> str:
        return self.options["path"].removeprefix("file://").removeprefix("file:").rstrip("/")

    def schema(self) -> StructType:
        """Of the query over the first file."""
        files = FolderReader(self._path(), self.options["query"], StructType()).partitions()
        if not files:
            raise ValueError(f"{self._path()} holds no Parquet file")
        import duckdb

        with duckdb.connect() as own:
            own.execute(_source(files[0].path))
            return from_arrow_schema(own.sql(f"SELECT * FROM ({self.options['query']}) LIMIT 0").to_arrow_table().schema)

    def reader(self, schema: StructType) -> FolderReader:
        return FolderReader(self._path(), self.options["query"], schema)


def register(spark: SparkSession) -> str:
    """Makes the source known to a session and returns its format's name."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FolderSource)
    return FORMAT
