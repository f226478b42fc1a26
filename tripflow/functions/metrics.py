"""Row-level business metrics and small aggregate helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.constants import EFFICIENT, OVERUSED, OVERUSED_ABOVE, UNDERUSED, UNDERUSED_BELOW


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trip_minutes(seconds: str | Column) -> Column:
    """Trip length in minutes, rounded to 2 decimals."""
    return F.round(_col(seconds) / F.lit(60.0), 2)


def avg_speed_kmh(distance_km: str | Column, minutes: str | Column) -> Column:
    """km per hour from the (already rounded) minutes; null for a zero-length trip."""
    return F.round(F.try_divide(_col(distance_km), _col(minutes) / F.lit(60.0)), 2)


def net_flow(ended: str | Column, started: str | Column) -> Column:
    """Trips ended minus trips started; a missing side counts as 0."""
    return F.coalesce(_col(ended), F.lit(0)) - F.coalesce(_col(started), F.lit(0))


def trips_per_dock(started: str | Column, ended: str | Column, capacity: str | Column) -> Column:
    """(started + ended) / capacity; null for zero or missing capacity."""
    return F.try_divide(_col(started) + _col(ended), _col(capacity))


def flow_stress(flow: str | Column, capacity: str | Column) -> Column:
    """|net flow| / capacity; null for zero or missing capacity."""
    return F.try_divide(F.abs(_col(flow)), _col(capacity))


def utilization_status(rate: str | Column, unknown_label: str | None = None) -> Column:
    """Overused above 15 trips per dock, Underused below 6, else Efficient.

    A null rate (no capacity) falls to Efficient unless ``unknown_label`` is given.
    """
    r = _col(rate)
    expr = F.when(r > OVERUSED_ABOVE, OVERUSED).when(r < UNDERUSED_BELOW, UNDERUSED)
    if unknown_label is not None:
        expr = expr.when(r.isNull(), unknown_label)
    return expr.otherwise(EFFICIENT)


def flow_class(flow: str | Column) -> Column:
    """Station role from its net flow sign."""
    f = _col(flow)
    return (
        F.when(f > 0, "Destination (surplus)")
        .when(f < 0, "Origin (shortage)")
        .when(f == 0, "Balanced")
    )


def rain_condition(precipitation: str | Column) -> Column:
    """Rain / No rain from daily precipitation; Unknown when missing."""
    p = _col(precipitation)
    return F.when(p > 0, "Rain").when(p == 0, "No rain").otherwise("Unknown")


def fixed_point_mean(value: str | Column, decimals: int) -> Column:
    """Mean of a measure that has ``decimals`` fixed decimals (aggregate).

    Values are summed as integers, so the result does not depend on the order in
    which partitions are combined: the same input always gives the same bits,
    on any cluster layout and in any engine. Nulls are ignored.
    """
    scale = 10**decimals
    units = F.round(_col(value) * F.lit(float(scale))).cast("bigint")
    return F.try_divide(F.sum(units), F.count(units)) / F.lit(float(scale))
