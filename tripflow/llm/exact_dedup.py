"""Exact deduplication by sorting contents, with DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ID, _TEXT, _HEAD, _HASH, _SALT, _SALTS, _RANK, _RUN_KEEP, _RUN_SIZE = (
    f"__dedup_{n}" for n in ("id", "text", "head", "hash", "salt", "salts", "rank", "run_keep", "run_size")
)
_HEAD_CHARS = 64


def whole_text(text: Column) -> Column:
    """The default normal form: the text itself, null as empty."""
    return F.coalesce(text, F.lit(""))


def _frequent(rows: DataFrame, least: int) -> DataFrame:
    """Hashes of texts that fill more than half a shuffle partition, and over how many salts to split each.

    They are fewer than twice the shuffle partitions, since their rows are part of
    the table; that bounds the broadcast. A hash only chooses the way a text takes,
    it never decides equality.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(least, rows.count() // (2 * parts))
    return (
        rows.groupBy(_HASH)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > share)
        .select(_HASH, F.ceil(F.col("n") / F.lit(share)).cast("int").alias(_SALTS))
    )


def _sorted_runs(docs: DataFrame, id_col: str, text_col: str, normalise, keep: str, least: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their rank, kept id and size within a run of equal texts: those whose
    run is the whole group, and those of frequent texts, whose groups span salted runs."""
    text = normalise(F.col(text_col))
    rows = docs.withColumn(_ID, F.col(id_col)).withColumn(_TEXT, text).withColumn(_HASH, F.xxhash64(_TEXT))
    rows = rows.withColumn(_HEAD, F.substring(_TEXT, 1, _HEAD_CHARS))
    frequent = _frequent(docs.select(F.xxhash64(text).alias(_HASH)), least)
    order = F.col(_ID).desc_nulls_last() if keep == "max" else F.col(_ID).asc_nulls_last()
    best = F.max if keep == "max" else F.min

    def runs(part: DataFrame, *key: str) -> DataFrame:
        # sampled splitters deal out ranges of contents; the window sorts each range (spilling
        # to disk) and compares neighbours in full. A splitter is a text's head and the hash
        # of its whole, since whole texts would pass through the driver as samples
        run = Window.partitionBy(_HEAD, _HASH, _TEXT, *key)
        return (
            part.repartitionByRange(_HEAD, _HASH, *key)
            .withColumn(_RANK, F.row_number().over(run.orderBy(order)))
            .withColumn(_RUN_KEEP, best(_ID).over(run))
            .withColumn(_RUN_SIZE, F.count(F.lit(1)).over(run))
        )

    plain = rows.join(F.broadcast(frequent.select(_HASH)), _HASH, "left_anti")
    split = rows.join(F.broadcast(frequent), _HASH).withColumn(_SALT, F.pmod(F.xxhash64(_ID), F.col(_SALTS)))
    return runs(plain), runs(split, _SALT)


def exact_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = whole_text,
    keep: str = "max",
    least: int = 100,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normal forms have the same bytes. The row with the
    largest id (``keep="min"``: smallest) stays; of rows with that same id one stays.
    A null text counts as empty; null ids come last, and a group of null ids only
    keeps one row with a null keep_id. Other columns are not read. Empty in, empty out.

    A text with over half a shuffle partition of copies is dealt out over salted
    runs; only the best row of each run meets the others.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    plain, split = _sorted_runs(docs, "doc_id", "text", normalise, keep, least)
    digest = F.sha2(F.col(_TEXT), 256).alias("text_sha256")
    split = split.select("doc_id", digest, _TEXT, _SALT, _RANK, _RUN_KEEP, _RUN_SIZE)
    ordered = F.struct(F.col(_RUN_KEEP).isNotNull(), F.col(_RUN_KEEP), F.col(_SALT))
    if keep != "max":
        ordered = F.struct(F.col(_RUN_KEEP).isNotNull(), -F.col(_RUN_KEEP), F.col(_SALT))
    groups = (
        split.filter(F.col(_RANK) == 1)
        .groupBy(_TEXT)
        .agg(
            F.first("text_sha256").alias("text_sha256"),
            F.max_by(F.struct(_RUN_KEEP, _SALT), ordered).alias("best"),
            F.sum(_RUN_SIZE).alias("group_size"),
        )
        .drop(_TEXT)
    )
    return plain.select(
        "doc_id",
        F.col(_RUN_KEEP).alias("keep_id"),
        F.col(_RUN_SIZE).alias("group_size"),
        (F.col(_RANK) == 1).alias("kept"),
        digest,
    ).unionByName(
        split.join(F.broadcast(groups.withColumnRenamed("text_sha256", "digest")), F.col("text_sha256").eqNullSafe(F.col("digest"))).select(
            "doc_id",
            F.col(f"best.{_RUN_KEEP}").alias("keep_id"),
            "group_size",
            ((F.col(_RANK) == 1) & (F.col(_SALT) == F.col(f"best.{_SALT}"))).alias("kept"),
            "text_sha256",
        )
    )


def drop_exact_copies(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = whole_text,
    keep: str = "max",
    least: int = 100,
) -> DataFrame:
    """The rows that ``exact_groups`` keeps, with all their columns."""
    plain, split = _sorted_runs(docs, id_col, text_col, normalise, keep, least)
    order = F.col(_ID).desc_nulls_last() if keep == "max" else F.col(_ID).asc_nulls_last()
    best = split.filter(F.col(_RANK) == 1).withColumn(_RANK, F.row_number().over(Window.partitionBy(_TEXT).orderBy(order)))
    return (
        plain.filter(F.col(_RANK) == 1)
        .select(*docs.columns)
        .unionByName(best.filter(F.col(_RANK) == 1).select(*docs.columns))
    )
