"""Sharding by jump consistent hashing, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the published method: the multiplier of its linear congruential generator.
JUMP_MULTIPLIER = 2862933555777941757

_LOW = 0xFFFFFFFF
_USUAL_JUMPS = 64  # the expected number is about ln(shards) + 1
_CHUNK_DIGITS = 3  # 16**3 chunks number the rows of a shard in parallel


def _times(key_hi: Column, key_lo: Column) -> tuple[Column, Column]:
    """key * multiplier + 1 modulo 2**64 in two 32-bit halves; no step exceeds a signed long."""
    m = [(JUMP_MULTIPLIER >> s) & 0xFFFF for s in (0, 16, 32, 48)]
    mid = key_lo * F.lit(m[1])
    low = key_lo * F.lit(m[0]) + F.shiftleft(mid.bitwiseAND(F.lit(_LOW)), 16) + F.lit(1)
    high = (
        F.shiftright(low, 32)
        + F.shiftleft(F.shiftright(mid, 32), 16)
        + key_lo * F.lit(m[2])
        + F.shiftleft((key_lo * F.lit(m[3])).bitwiseAND(F.lit(_LOW)), 16)
        + key_hi * F.lit(m[0])
        + F.shiftleft((key_hi * F.lit(m[1])).bitwiseAND(F.lit(_LOW)), 16)
    )
    return high.bitwiseAND(F.lit(_LOW)), low.bitwiseAND(F.lit(_LOW))


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of a 64-bit integer key: it moves only into the new shard when one is appended.

    Each step draws the next shard count at which the key would move; the last one
    below ``shards`` wins. A step always goes up, so ``shards`` steps are enough; all
    but a vanishing share of keys are done after the first few. Null keys count as 0.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.lit(0).cast("long").alias("to"),
        F.shiftrightunsigned(key, 32).alias("hi"),
        key.bitwiseAND(F.lit(_LOW)).alias("lo"),
    )

    def jump(state: Column, _: Column) -> Column:
        hi, lo = _times(state["hi"], state["lo"])
        step = F.struct(
            state["to"].alias("at"),
            F.floor((state["to"] + 1) * (F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + 1).cast("double"))).alias("to"),
            hi.alias("hi"),
            lo.alias("lo"),
        )
        return F.when(state["to"] < shards, step).otherwise(state)

    state = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, _USUAL_JUMPS))), start, jump)
    if shards > _USUAL_JUMPS:
        rest = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), state, jump)
        state = F.when(state["to"] < shards, rest).otherwise(state)
    return state["at"].cast("int")


def shard_documents(
    docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Shard, slot and the shard after one is appended, for every document.

    Columns doc_id, size (UTF-8 bytes + 1), text_crc32, law, shard, slot, grown_shard.
    The law is ``key``: doc_id and the shard count alone decide, so equal texts
    follow their own ids. Slots number a shard's rows from 0 without gaps, by a
    digest prefix of the id and then by id. Numbering is dealt over fixed chunks of
    a shard: chunk sizes are counted first, then each chunk numbers its own rows, so
    no task orders a whole shard. A null text has size 1 and the checksum of no
    bytes; null ids go where key 0 goes; rows that repeat get a slot each; other
    columns are not read; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc_id = F.col(id_col).cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        jump_shard(doc_id, shards).alias("shard"),
        jump_shard(doc_id, shards + 1).alias("grown_shard"),
        F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, _CHUNK_DIGITS).alias("chunk"),
    )
    # at most shards * 16**digits rows, whatever the size of the table
    chunks = (
        rows.groupBy("shard", "chunk")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n"))
        .drop("n")
    )
    inside = Window.partitionBy("shard", "chunk").orderBy("doc_id", "size", "text_crc32")
    return (
        rows.withColumn("within", F.row_number().over(inside) - 1)
        .join(F.broadcast(chunks), ["shard", "chunk"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("before") + F.col("within")).cast("long").alias("slot"),
            "grown_shard",
        )
    )
