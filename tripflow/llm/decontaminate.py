"""Benchmark decontamination: words of training texts that stand in a passage of a benchmark item.

A passage is a window of ``window`` consecutive words of an item; an item with fewer words,
but not none, is one passage as a whole. Words are runs of digits, letters and non-ASCII
characters, with A-Z as a-z.

Every task cuts its documents into shards of about ``SHARD_BYTES``, builds an FM-index of
each shard (:mod:`tripflow.llm.fm_index`) and looks all passages up in it. The passages
reach the tasks as a broadcast of at most ``passes_of`` of them; a benchmark with more is looked
up in several passes over the documents, with a bounded broadcast in each.

Rows: every document row gives one row. A text that is null or empty has no words and no
hits. A document without an id keeps its null. An item whose text is null, empty or without words has no
passage; items of one id are one item, and items without an id count together as one, named ''.
Either table may be empty. Other columns of either table are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.fm_index import FMIndex
from tripflow.llm.shared import Tables
from tripflow.llm.tokenizing import runs

SHARD_BYTES = 2_500_000
PASSAGES_A_PASS = 200_000

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: A-Z as a-z, and a blank for every byte that no word holds.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)

FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def _texts(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary()).fill_null(b"")


@dataclass(frozen=True)
class Passages:
    """Distinct passages as numbered words, aligned right, and the items that hold each."""

    numbers: dict[bytes, int]  # from 1
    phrases: np.ndarray
    lengths: np.ndarray
    items: list[str]
    holders: np.ndarray  # places in ``items``, passage by passage
    ends: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> "Passages":
        """From rows (passage: words joined by blanks, item)."""
        items = sorted(set(rows["item"].to_pylist()))
        place = {item: n for n, item in enumerate(items)}
        held: dict[bytes, list[int]] = {}
        for passage, item in zip(rows["passage"].to_pylist(), rows["item"].to_pylist()):
            held.setdefault(passage, []).append(place[item])
        numbers: dict[bytes, int] = {}
        width = max((p.count(b" ") + 1 for p in held), default=1)
        phrases = np.zeros((len(held), width), np.int32)
        for line, passage in zip(phrases, held):
            ids = [numbers.setdefault(w, len(numbers) + 1) for w in passage.split()]
            line[width - len(ids) :] = ids
        sizes = np.fromiter(map(len, held.values()), np.int64, len(held))
        holders = np.fromiter((i for h in held.values() for i in h), np.int64, int(sizes.sum()))
        lengths = np.count_nonzero(phrases, axis=1)
        return cls(numbers, phrases, lengths, items, holders, np.concatenate(([0], np.cumsum(sizes))))


def passages(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct rows (passage, item) of a benchmark."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch["item"].to_pylist(), _texts(batch["text"]).to_pylist()):
                words = words_of(text)
                found = {b" ".join(words[n : n + window]) for n in range(max(1, len(words) - window + 1))} if words else set()
                yield pa.RecordBatch.from_pydict({"passage": pa.array(sorted(found), pa.binary()), "item": pa.array([item] * len(found), pa.string())})

    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(cut, "passage binary, item string").distinct()


def _occurrences(words: list[list[bytes]], known: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passage, document and first word (counted in the whole shard, with one end mark a document) of every occurrence."""
    number, numbered = known.numbers.get, []
    for some in words:
        numbered.extend(map(number, some, repeat(0)))
        numbered.append(0)
    symbols = np.array(numbered, np.int32)
    starts = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words])))
    index = FMIndex(symbols, len(known.numbers) + 1)
    low, high = index.search(known.phrases, known.lengths)
    times = high - low
    passage = np.repeat(np.arange(len(times)), times)
    rows = np.arange(len(passage)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
    at = index.locate(rows)
    return passage, np.searchsorted(starts, at, "right") - 1, at


def _spans(text: bytes, hit: np.ndarray) -> list[dict]:
    """The stretches of hit words, in characters of the text."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    places = [m.span() for m in _WORD.finditer(text)]
    spans, bytes_before, characters = [], 0, 0
    for first, end in edge.reshape(-1, 2):
        bounds = []
        for place in (places[first][0], places[end - 1][1]):
            characters += len(text[bytes_before:place].decode())
            bytes_before = place
            bounds.append(characters)
        spans.append({"start": bounds[0], "end": bounds[1]})
    return spans


def _shard(texts: list[bytes], known: Passages, before: list[tuple[list[dict], list[str]]] | None) -> list[tuple]:
    """n_words, n_hit, items and spans of every text; ``before`` are spans and items of earlier passes."""
    words = [words_of(t) for t in texts]
    passage, doc, at = _occurrences(words, known)
    starts = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words])))
    cover = np.zeros(starts[-1] + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + known.lengths[passage], -1)
    hit = np.cumsum(cover) > 0
    sizes = known.ends[passage + 1] - known.ends[passage]
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    pairs = np.unique(np.repeat(doc, sizes) * max(1, len(known.items)) + known.holders[inside + np.repeat(known.ends[passage], sizes)])
    items: list[list[str]] = [[] for _ in texts]
    for pair in pairs.tolist():
        items[pair // len(known.items)].append(known.items[pair % len(known.items)])
    out = []
    for n, text in enumerate(texts):
        mine = hit[starts[n] : starts[n + 1] - 1]
        if before and before[n][0]:
            places = [m.start() for m in _WORD.finditer(text)]
            characters = np.array([len(text[:p].decode()) for p in places]) if not text.isascii() else np.array(places)
            for span in before[n][0]:
                mine[np.searchsorted(characters, span["start"]) : np.searchsorted(characters, span["end"])] = True
            items[n] = sorted({*items[n], *before[n][1]})
        count = int(np.count_nonzero(mine))
        out.append((len(words[n]), count, items[n], _spans(text, mine) if count else []))
    return out


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    passages_a_pass: int = PASSAGES_A_PASS,
) -> DataFrame:
    """One row per document row: its id, ``n_words``, ``n_hit`` (words inside a passage), ``items`` (ids of
    the items with such a passage, as text, ascending) and ``spans`` (stretches of hit words, in characters)."""
    tables = Tables(docs.sparkSession)
    rows = tables.write(passages(benchmark, item_col, item_text_col, window), "passages")
    passes = max(1, -(-rows.count() // passages_a_pass))
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = out.schema["id"].dataType.simpleString()
    for n in range(passes):
        part = rows.where(F.pmod(F.xxhash64("passage", "item"), F.lit(passes)) == n).toArrow()
        known = docs.sparkSession.sparkContext.broadcast(Passages.of(part))
        last = n == passes - 1

        def look_up(batches: Iterator[pa.RecordBatch], known=known, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = _texts(batch["text"])
                for begin, end in runs(texts, SHARD_BYTES):
                    some = texts[begin:end].to_pylist()
                    part = batch.slice(begin, end - begin)
                    before = list(zip(part["spans"].to_pylist(), part["items"].to_pylist())) if "spans" in part.schema.names else None
                    n_words, n_hit, items, spans = zip(*_shard(some, known.value, before))
                    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                    columns = {"id": part["id"]} if last else {"id": part["id"], "text": part["text"]}
                    columns |= {"n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64())}
                    columns |= {"items": pa.array(items, pa.list_(pa.string())), "spans": pa.array(spans, span)}
                    yield pa.RecordBatch.from_pydict(columns)

        if last:
            out = out.mapInArrow(look_up, f"id {id_type}, {FOUND}")
        else:
            out = tables.write(out.mapInArrow(look_up, f"id {id_type}, text string, {FOUND}"), f"pass-{n}")
            if n:
                tables.drop(f"pass-{n - 1}")
    tables.drop("passages")
    return out.withColumnRenamed("id", id_col)


def without_spans(text: str, spans: str = "spans") -> F.Column:
    """The text with its ``spans`` (ascending, apart) cut out."""
    bounds = F.concat(
        F.array(F.lit(0).cast("long")),
        F.flatten(F.transform(spans, lambda s: F.array(s["start"], s["end"]))),
        F.array(F.length(text).cast("long")),
    )
    pieces = F.transform(
        F.sequence(F.lit(0), F.size(spans)),
        lambda n: F.substring(F.col(text), (bounds[2 * n] + 1).cast("int"), (bounds[2 * n + 1] - bounds[2 * n]).cast("int")),
    )
    return F.array_join(pieces, "")
