"""Frame-level cleaning: typing by name, time parsing, null policies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, TimestampNTZType

from tripflow.functions.cleaning import parse_time, textual_null
from tripflow.sources.schemas import TRIP_FIELDS

# Columns the marts need; ``"all"`` reproduces dropping a trip with any null.
MART_REQUIRED = (
    "tripduration",
    "starttime",
    "stoptime",
    "start_station_name",
    "start_station_latitude",
    "start_station_longitude",
    "end_station_name",
    "end_station_latitude",
    "end_station_longitude",
    "usertype",
)


def _typed(field: StructField, text: Column) -> Column:
    if isinstance(field.dataType, TimestampNTZType):
        return parse_time(text.cast("string"))
    if isinstance(field.dataType, StringType):
        return text.cast("string")
    # '1990.0' style numbers still give integers
    return F.coalesce(text.try_cast(field.dataType), text.try_cast("double").try_cast(field.dataType))


def _text_of(raw: DataFrame, field: StructField) -> Column:
    return F.col(field.name) if field.name in raw.columns else F.lit(None).cast("string")


def type_trips(raw: DataFrame) -> DataFrame:
    """Text trip columns -> declared types, matched by name; bad text -> null."""
    cols = [_typed(f, _text_of(raw, f)).alias(f.name) for f in TRIP_FIELDS]
    return raw.select(*cols, *(c for c in raw.columns if c not in {f.name for f in TRIP_FIELDS}))


def _required(required: Sequence[str] | str) -> list[str]:
    return [f.name for f in TRIP_FIELDS] if required == "all" else list(required)


def clean_trips(
    raw: DataFrame, required: Sequence[str] | str = MART_REQUIRED, seen: Observation | None = None, extra_cells: str | None = None
) -> DataFrame:
    """Typed trips with ``start_date`` (timestamp) and ``start_day`` (date);
    rows null in any ``required`` column dropped (``"all"`` = every trip column).

    ``seen`` gets, from the job that reads the result, what was dropped and why: ``rows_read``, ``rows_rejected``,
    ``missing_<column>`` (no text in a required column), ``unreadable_<column>`` (text that is not of the
    column's type, required or not), and with ``extra_cells``, a column that counts them, cells without a canonical column.
    """
    subset = _required(required)
    t = type_trips(raw)
    if seen is not None:
        had = F.struct(*(_text_of(raw, f).isNotNull().alias(f.name) for f in TRIP_FIELDS)).alias("_had")
        marked = raw.select(*(_typed(f, _text_of(raw, f)).alias(f.name) for f in TRIP_FIELDS), *t.columns[len(TRIP_FIELDS) :], had)
        rejected = reduce(or_, (F.col(c).isNull() for c in subset), F.lit(False))
        counts = [F.count(F.lit(1)).alias("rows_read"), F.count_if(rejected).alias("rows_rejected")]
        counts += [F.count_if(~F.col(f"_had.{c}")).alias(f"missing_{c}") for c in subset]
        typed = [f.name for f in TRIP_FIELDS if not isinstance(f.dataType, StringType)]
        counts += [F.count_if(F.col(f"_had.{c}") & F.col(c).isNull()).alias(f"unreadable_{c}") for c in typed]
        if extra_cells:
            counts.append(F.coalesce(F.sum(F.col(extra_cells)), F.lit(0)).alias(extra_cells))
        t = marked.observe(seen, *counts).drop("_had")
    if extra_cells:
        t = t.drop(extra_cells)
    t = t.withColumn("start_date", F.col("starttime")).withColumn("start_day", F.to_date("starttime"))
    return t.dropna(how="any", subset=subset)


def drop_textual_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose ``columns`` hold a null or a textual null ('nan', blank) are dropped."""
    for c in columns:
        df = df.withColumn(c, textual_null(c))
    return df.dropna(subset=list(columns))
