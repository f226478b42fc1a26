"""Weather job: daily weather as a stored table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripflow.operators.weather import daily_weather
from tripflow.sinks.publish import publish_table
from tripflow.sources.warehouse import table_has_rows


def load_weather(
    spark: SparkSession,
    readings: DataFrame | Callable[[], DataFrame],
    table: str,
    *,
    store: str | None = None,
    reload: bool = False,
    **how,
) -> DataFrame:
    """Saves the daily weather of ``readings`` as ``table`` and returns the table.

    A table that has rows is finished: nothing is read, and ``readings`` given as a function is not
    called, unless ``reload``. A load is written beside the table and published in one step, so
    that one that fails, or has no rows, leaves the table as it is; without rows and without an earlier
    table it fails. ``store`` is where loads are written, by default a folder in the warehouse.

    ``readings`` are limited to their years already, where the store can skip folders (``read_years``).
    """
    if not reload and table_has_rows(spark, table):
        return spark.table(table)
    rows = readings() if callable(readings) else readings
    root = store or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_loads/{table}"
    if not publish_table(daily_weather(rows, **{"years": None, **how}), table, root) and not table_has_rows(spark, table):
        raise ValueError(f"no weather was loaded and {table} has none")
    return spark.table(table)
