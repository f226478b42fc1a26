"""Binary files of token ids: a shared dictionary, one compressed frame per document.

A store is a folder of two Parquet tables, so that any file system Spark knows can
hold it. ``dictionary`` has one row: the zstandard dictionary, its SHA-256 and the
width of an id in bytes. ``blocks`` has a row for about ``block_bytes`` of frames:

    shard, block       place in the order of documents; blocks count within a shard
    first_id, last_id  smallest and largest doc_id inside
    before             ids of the shard's earlier blocks
    doc_ids, n_tokens  of each document
    offsets            where each frame begins in the payload, and the payload's end
    payload            frames, one per document: its ids, little-endian, ``width`` bytes each
    dictionary_sha256  the dictionary that the frames need
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripflow.llm.tokenizing import encoder, runs

_MEMO_BYTES = 256_000_000  # of words and their ids, about, in a worker that writes
BLOCKS = (
    "shard int, block int, first_id long, last_id long, before long, doc_ids array<long>, n_tokens array<int>, "
    "offsets array<long>, payload binary, dictionary_sha256 string"
)
_DICTIONARY = "dictionary_sha256 string, width int, dictionary binary"
_DOCUMENTS = "shard int, doc_id long, before long, n_tokens long, ids binary"


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary; with too few samples to train one, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return (b"\0" * 8 + b"".join(samples))[-size:]


def _sample(rows: DataFrame, path: str, end_id: int, width: int, docs: int, most: int) -> list[bytes]:
    """Serialised ids of about ``docs`` documents, spread by a hash of the id; at most ``most`` bytes of each."""
    n = max(1, rows.count())
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < docs).limit(2 * docs)

    def serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path, end_id)
        for batch in batches:
            for text in batch.column(1).to_pylist():
                ids, _ = tokens.encode([text[: 4 * most]])
                yield pa.RecordBatch.from_pydict({"ids": [ids.astype(f"<u{width}").tobytes()[:most]]})

    return [bytes(r.ids) for r in chosen.mapInArrow(serialise, "ids binary").collect()]


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    width: int = 2,
    level: int = 3,
    dictionary_bytes: int = 64 << 10,
    sample_docs: int = 400,
    sample_bytes: int = 8 << 10,
    block_bytes: int = 2 << 20,
) -> None:
    """Encodes every whole text, appends ``end_id`` and writes the ids in ascending doc_id order.

    Only the dictionary is fit on a bounded sample (``sample_docs``, ``sample_bytes``
    each). Rows are range-partitioned by id and sorted within partitions, so shards
    follow each other; a task holds one block. ``width`` must hold the vocabulary.
    A null text counts as empty (its frame holds the end id); null ids come first;
    rows that repeat are written once each; other columns are not read; of an empty
    table only the dictionary is written.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dictionary = train_dictionary(_sample(rows, tokenizer_path, end_id, width, sample_docs, sample_bytes), dictionary_bytes)
    sha = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(sha, width, dictionary)], _DICTIONARY).coalesce(1).write.parquet(f"{path}/dictionary")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer_path, end_id, _MEMO_BYTES)
        frames = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary))
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        counts: list[int] = []
        parts: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal block, before, held
            known = [i for i in doc_ids if i is not None]
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).tolist()
            row = (shard, block, min(known, default=None), max(known, default=None), before, doc_ids[:], counts[:], offsets, b"".join(parts), sha)
            block, before, held = block + 1, before + sum(counts), 0
            doc_ids.clear(), counts.clear(), parts.clear()
            return pa.RecordBatch.from_pylist([dict(zip(_BLOCKS.names, row))], schema=_BLOCKS)

        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in runs(texts):
                ids, n = tokens.encode(texts.slice(a, b - a).to_pylist())
                if len(ids) and int(ids.max()) >> (8 * width):
                    raise ValueError(f"an id of {int(ids.max())} does not fit into {width} bytes")
                packed = ids.astype(f"<u{width}").tobytes()
                ends = np.cumsum(n) * width
                for doc_id, end, count in zip(ids_of[a:b], ends.tolist(), n.tolist()):
                    frame = frames.compress(packed[end - count * width : end])
                    doc_ids.append(doc_id), counts.append(count), parts.append(frame)
                    held += len(frame)
                    if held >= block_bytes:
                        yield close()
        if doc_ids:
            yield close()

    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(blocks, BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


_BLOCKS = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("first_id", pa.int64()),
        ("last_id", pa.int64()),
        ("before", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int32())),
        ("offsets", pa.list_(pa.int64())),
        ("payload", pa.binary()),
        ("dictionary_sha256", pa.string()),
    ]
)


def read_token_files(spark: SparkSession, path: str, between: tuple[int, int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned
    32-bit) of every document, or of those with an id in ``between``, both ends included.

    ``between`` reaches the scan through the blocks' id ranges, and of a block only
    the frames asked for are decompressed, by their offsets.
    """
    row = spark.read.schema(_DICTIONARY).parquet(f"{path}/dictionary").first()
    dictionary, width, sha = bytes(row["dictionary"]), row["width"], row["dictionary_sha256"]
    if hashlib.sha256(dictionary).hexdigest() != sha:
        raise ValueError("the dictionary does not match its hash")
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # a row per shard, and shards are the writer's partitions
    totals = (
        blocks.select("shard", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda t, n: t + n).alias("n"))
        .groupBy("shard")
        .agg(F.sum("n").alias("n"))
        .select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    )
    if between:
        blocks = blocks.filter((F.col("last_id") >= between[0]) & (F.col("first_id") <= between[1]))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        for batch in batches:
            for block in range(batch.num_rows):
                shard, before, doc_ids, counts, offsets, payload, needs = (c[block].as_py() for c in batch.columns)
                if needs != sha:
                    raise ValueError("a block needs another dictionary")
                out = []
                for n, doc_id in enumerate(doc_ids):
                    if between is None or (doc_id is not None and between[0] <= doc_id <= between[1]):
                        raw = frames.decompress(payload[offsets[n] : offsets[n + 1]])
                        ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                        out.append((shard, doc_id, before, len(ids), ids.tobytes()))
                    before += counts[n]
                for at in range(0, len(out), 500):
                    columns = zip(*out[at : at + 500])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                        names=["shard", "doc_id", "before", "n_tokens", "ids"],
                    )

    columns = ["shard", "before", "doc_ids", "n_tokens", "offsets", "payload", "dictionary_sha256"]
    return (
        blocks.select(*columns)
        .mapInArrow(documents, _DOCUMENTS)
        .join(F.broadcast(totals), "shard")
        .select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids")
    )
