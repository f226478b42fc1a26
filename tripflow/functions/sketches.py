"""Distinct counts that add up: HyperLogLog sketches, kept per group and merged for any larger one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12


def distinct_sketches(df: DataFrame, keys: Sequence[str], column: str, lg_k: int = LG_K) -> DataFrame:
    """``keys`` and a ``sketch`` of the distinct values of ``column`` (nulls do not count): at most some 2**lg_k bytes
    a group, whatever its rows. Sketches are made map-side, so only they are shuffled."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, lg_k).alias("sketch"))


def merged_distinct(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys`` and ``about``, the number of distinct values in all sketches of a group together."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about"))


def relative_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """How far an estimate may be off, as a share: so many standard errors, each 1.04 / sqrt(2**lg_k)."""
    return deviations * 1.04 / 2 ** (lg_k / 2)
