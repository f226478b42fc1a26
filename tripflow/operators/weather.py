"""Daily weather summary from station-day readings with missing-value codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tripflow.constants import WEATHER_OUTPUTS, WEATHER_SENTINELS, WEATHER_STATIONS, WEATHER_YEARS
from tripflow.functions.calendar import day_start
from tripflow.functions.cleaning import without_sentinel


def daily_weather(
    readings: DataFrame,
    stations: Sequence[str] | None = WEATHER_STATIONS,
    years: tuple[int, int] | None = WEATHER_YEARS,
    sentinels: Mapping[str, object] = WEATHER_SENTINELS,
    outputs: Mapping[str, str] = WEATHER_OUTPUTS,
    sort: bool = False,
) -> DataFrame:
    """One row per day: ``timestamp`` (midnight) and the mean of each reading.

    ``readings`` has ``stn``, ``year``, ``mo``, ``da`` (text) and one column
    per key of ``outputs``. A reading equal to its column's missing-value code
    is ignored by the mean (a text-typed column is compared as text, then cast).
    Station and year filters run before the aggregate and reach the scan: years that are text
    are compared with the years' names, as a cast column would not be pushed down.
    """
    df = readings
    if years is not None:
        first, last = years
        is_text = isinstance(df.schema["year"].dataType, StringType)
        df = df.where(F.col("year").isin([str(y) for y in range(first, last + 1)]) if is_text else F.col("year").between(first, last))
    if stations is not None:
        df = df.where(F.col("stn").isin(*stations))
    ts = day_start("year", "mo", "da").alias("timestamp")
    aggs = []
    for raw, out in outputs.items():
        value = without_sentinel(raw, sentinels[raw]) if raw in sentinels else F.col(raw)
        aggs.append(F.avg(value.try_cast("double")).alias(out))
    result = df.groupBy(ts).agg(*aggs)
    return result.orderBy("timestamp") if sort else result
