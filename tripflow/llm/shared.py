"""Where operators put tables that later jobs read back."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tripflow.session import checkpoint_dir, scratch_path


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; only where that is unset (tests, a laptop),
    under the session's warehouse."""
    try:
        checkpoint_dir(spark)
    except RuntimeError:
        checkpoint_dir(spark, default=spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return scratch_path(spark, name)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, and read back by
    every later job, also after its executors are lost."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Tables:
    """The written tables of one run of an operator. Those that no later step reads are dropped at once."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        path = self.paths[name] = shared_path(self.spark, name)
        df.write.partitionBy(*(partition_by or [])).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        for name in names or list(self.paths):
            where = hadoop.Path(self.paths.pop(name))
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def tidy(work: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A task's function that gives the memory it no longer uses back to the system when it ends. The worker process
    waits for other tasks, of later stages too, and would keep it."""

    @functools.wraps(work)
    def tidied(*args, **how):
        try:
            yield from work(*args, **how)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return tidied
