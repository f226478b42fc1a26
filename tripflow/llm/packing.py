"""Packing of token sequences into fixed windows by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.shared import tidy
from tripflow.llm.tokenizing import MEMO_BYTES, encoder, runs

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_PIECES = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())]
)


def difference(lengths: list[int], windows: int) -> np.ndarray:
    """Window of each item by multiway differencing.

    Every item begins as a partial partition of its own: ``windows`` sums, all
    but one of them zero. The two partitions whose sums differ most are merged,
    the largest sum of one onto the smallest of the other, until one is left.
    """
    n = len(lengths)
    sums = []
    for x in lengths:
        one = np.zeros(windows, np.int64)
        one[0] = x
        sums.append(one)  # descending
    heap = [(-x, i) for i, x in enumerate(lengths)]
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = sums[a] + sums[b][::-1]
        order = np.argsort(-both, kind="stable")
        merged = both[order]
        sums[a] = sums[b] = None
        sums.append(merged)
        merges.append((a, b, order))
        heapq.heappush(heap, (int(merged[-1] - merged[0]), n + len(merges) - 1))
    # unfold: a slot of a merged partition is a slot of one side and the mirrored slot of the other
    place: dict[int, np.ndarray] = {heap[0][1]: np.arange(windows)}
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        here = place.pop(n + k)
        own = np.empty(windows, np.int64)
        own[order] = here
        place[a], place[b] = own, own[::-1]
    return np.array([place[i][0] for i in range(n)], np.int64)


def windows_for(lengths: list[int], capacity: int) -> np.ndarray:
    """Window of each item, with as few near-equal windows as hold within ``capacity``:
    the count starts at the sum's need and rises whenever a window exceeds it."""
    k = max(1, -(-sum(lengths) // capacity))
    while True:
        place = difference(lengths, k) if k > 1 else np.zeros(len(lengths), np.int64)
        if np.bincount(place, weights=lengths, minlength=k).max() <= capacity:
            return place
        k += 1


class _Packer:
    """Turns one partition's documents into pieces, a block of windows at a time."""

    def __init__(self, partition: int, capacity: int, piece: int, block_windows: int, fill: float):
        self.capacity, self.piece = capacity, piece
        self.target = int(block_windows * capacity * fill)
        self.next_id = partition << 40
        self.out: list[tuple] = []
        self.out_bytes = 0
        self.open: list[tuple] = []  # (doc_id, start, doc_tokens, ids)
        self.open_tokens = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        n, at = len(ids), 0
        while n - at >= self.capacity:
            self._emit(doc_id, at, n, ids[at : at + self.capacity], self.next_id, 0)
            self.next_id += 1
            at += self.capacity
        while at < n:
            size = min(self.piece, n - at, self.target - self.open_tokens)
            self.open.append((doc_id, at, n, ids[at : at + size].copy()))
            self.open_tokens += size
            at += size
            if self.open_tokens == self.target:
                self.close_block()

    def close_block(self) -> None:
        if not self.open:
            return
        place = windows_for([len(x[3]) for x in self.open], self.capacity)
        filled = np.zeros(place.max() + 1, np.int64)
        for (doc_id, start, n, ids), w in zip(self.open, place.tolist()):
            self._emit(doc_id, start, n, ids, self.next_id + w, int(filled[w]))
            filled[w] += len(ids)
        self.next_id += len(filled)
        self.open, self.open_tokens = [], 0

    def _emit(self, doc_id, start, n, ids, sequence, offset) -> None:
        self.out.append((doc_id, start, len(ids), n, sequence, offset, ids.astype("<u4").tobytes()))
        self.out_bytes += 4 * len(ids)

    def take(self) -> pa.RecordBatch:
        rows, self.out, self.out_bytes = self.out, [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    capacity: int = 2048,
    piece: int = 512,
    block_windows: int = 64,
    fill: float = 0.999,
    memo_bytes: int = MEMO_BYTES,
) -> DataFrame:
    """Tokenises whole texts and packs them into sequences of at most ``capacity`` ids.

    A document's full windows become sequences of their own. The rest is cut into
    pieces of at most ``piece`` ids; pieces gather in blocks of ``fill`` times
    ``block_windows`` windows, and differencing deals each block into near-equal
    windows, one more whenever a window would exceed the capacity. One row per
    piece: doc_id, start, length, doc_tokens, sequence_id, offset and the ids as
    little-endian unsigned 32-bit integers.

    A worker remembers the ids of about ``memo_bytes`` of words.

    Every scan partition packs its own rows and holds one block of them, so nothing
    is shuffled and no group meets in one task; a partition's last block pads at
    most one window. Sequence ids carry the partition's number, so a task that runs
    again writes the same rows. A null text counts as empty (one piece: its end
    id), a null doc_id stays null, rows that repeat are packed once each, other
    columns are not read, an empty table gives no rows.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    @tidy
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer_path, end_id, memo_bytes)
        packer = _Packer(TaskContext.get().partitionId(), capacity, piece, block_windows, fill)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in runs(texts):
                ids, counts = tokens.encode(texts.slice(a, b - a).to_pylist())
                ends = np.cumsum(counts)
                for doc_id, end, count in zip(doc_ids[a:b], ends.tolist(), counts.tolist()):
                    packer.add(doc_id, ids[end - count : end])
                if packer.out_bytes > 4_000_000:
                    yield packer.take()
        packer.close_block()
        if packer.out:
            yield packer.take()

    return source.mapInArrow(pack, PIECES)
