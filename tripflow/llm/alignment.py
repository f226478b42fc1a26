"""Alignment of two tokenizers over a corpus: which ids of one stand where which ids of the other do.

A text is encoded by a byte-level vocabulary (A, as space + text) and by a sentencepiece
model (B, which adds the space itself). Byte offsets at which tokens of both end cut the text
into groups; every A token of a group is linked with every B token of it. The count of an
id pair is the number of documents that hold it linked.

The counting is external, in runs:

1. *Runs.* Tasks align documents and write, for about ``RUN_BYTES`` of text, one run of (pair, document,
   links) records, ordered by radix of the A id, A id, B id, and document, as zstd frames in the shared folder.
   A run's distinct pairs and their document counts go into a frame of their own per radix, so that
   a pair that most documents hold is one entry a run.
2. *Merge.* A radix's frames are merged over a heap, ``FAN_IN`` at a time, until one list is left. It is in
   the order of A ids, so the highest count of an A id stands in its stretch.
3. *Back.* The counts go back to the runs, and a run's records add them up by document.

Tasks never hold more than ``FAN_IN`` frames of one radix, the merged list of one radix (at most
its share of the id pairs that both vocabularies allow), or one run. A document is never cut:
one longer than ``RUN_BYTES`` is a run of its own.

Rows: every document row gives one row, repeated ids too, and each counts as a document. Texts that
are null, empty, or that a vocabulary does not give back byte by byte have no tokens: zeros and
''. A null id stays null. Without rows there is no result row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.shared import Tables
from tripflow.llm.tokenizing import WordMemoEncoder, runs

RUN_BYTES = 4_000_000
RADIX = 256
FAN_IN = 256
MEMO_BYTES = 256_000_000  # of a worker, about; later tasks of the process go on with its memo
MEMO_UNIT = 64  # characters; longer units are aligned anew each time
LEARN_AT_ONCE = 20_000
SMALL_GROUP = 4096  # links

DIGESTS = ("n_a", "n_b", "n_groups", "n_links")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary writes: printable Latin-1 stands for itself, the
    other bytes for the letters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + n): b for n, b in enumerate(rest)}


class Aligner:
    """Aligns texts unit by unit. A unit is a word with the space before it where spaces stand alone between
    visible characters, as then neither vocabulary has a token over its end; else the whole text. Units that
    recur are aligned once; the memo is emptied when it holds about ``memo_bytes``."""

    def __init__(self, path_a: str, path_b: str, memo_bytes: int = MEMO_BYTES):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        self.bytes_a = [bytes(letters.get(c, 0) for c in self.a.id_to_token(i)) for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        self.shown = [f"{i}{mark}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for mark in (",", "|", ";", "")]
        self.memo_bytes = memo_bytes
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.texts: list[str] = []
        self.digests = array("q")  # four a row; n_a is -1 where bytes differ
        self.pairs, self.links, self.ends = array("q"), array("q"), array("q", [0])
        self.held = 0

    def groups(self, text: str) -> list[tuple[list[int], list[int]]] | None:
        """A and B ids of each group of space + text, or None where their bytes differ from it."""
        (a,), (b,) = self._encode([text])
        if not self._same(text, a, b):
            return None
        out, na, nb, end_a, end_b, begin_a, begin_b = [], 0, 0, 0, 0, 0, 0
        while na < len(a):
            if end_a <= end_b:
                end_a += len(self.bytes_a[a[na]])
                na += 1
            while nb < len(b) and end_b < end_a:
                end_b += len(self.bytes_b[b[nb]])
                nb += 1
            if end_a == end_b:
                out.append((a[begin_a:na], b[begin_b:nb]))
                begin_a, begin_b = na, nb
        return out

    def _encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in a], self.b.encode(texts, num_threads=1)

    def _same(self, text: str, a: list[int], b: list[int]) -> bool:
        whole = b" " + text.encode()
        return whole == b"".join([self.bytes_a[i] for i in a]) and whole == b"".join([self.bytes_b[i] for i in b])

    @staticmethod
    def _all_same(texts: list[str], ids: list[list[int]], table: list[bytes]) -> bool:
        """Whether the ids of every text write space + text, looked at all together."""
        written = list(map(table.__getitem__, chain.from_iterable(ids)))
        ends = np.cumsum([len(x) for x in ids])
        sizes = np.concatenate(([0], np.cumsum(np.fromiter(map(len, written), np.int64, len(written)))))[ends]
        own = np.cumsum([len(t) + 1 if t.isascii() else len(t.encode()) + 1 for t in texts])
        return np.array_equal(sizes, own) and b"".join(written) == (" " + " ".join(texts)).encode()

    def learn(self, texts: list[str]) -> None:
        """Aligns texts and keeps what comes of each as the next row."""
        for n in range(0, len(texts), LEARN_AT_ONCE):
            self._learn(texts[n : n + LEARN_AT_ONCE])

    def _learn(self, texts: list[str]) -> None:
        a, b = self._encode(texts)
        same = [True] * len(texts)
        if not (self._all_same(texts, a, self.bytes_a) and self._all_same(texts, b, self.bytes_b)):
            same = [self._same(*x) for x in zip(texts, a, b)]
            a, b = ([x if ok else [] for x, ok in zip(ids, same)] for ids in (a, b))
        of_a, of_b = (np.repeat(np.arange(len(texts)), [len(x) for x in ids]) for ids in (a, b))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a, b))
        # all texts lie behind one another, so bytes where tokens of both end cut texts and groups
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        many_a, many_b = (np.bincount(g, minlength=len(cuts)) for g in (group_a, group_b))
        first_a, first_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
        owner = of_a[first_a]
        digests = np.stack(
            [np.bincount(of_a, minlength=len(texts)), np.bincount(of_b, minlength=len(texts)), np.bincount(owner, minlength=len(texts))]
            + [np.zeros(len(texts), np.int64)],
            axis=1,
        )
        np.add.at(digests[:, 3], owner, many_a * many_b)
        digests[~np.array(same, bool)] = (-1, 0, 0, 0)
        # links of small groups one by one, of large ones by distinct ids
        small = many_a * many_b <= SMALL_GROUP
        links = np.where(small, many_a * many_b, 0)
        group = np.repeat(np.arange(len(cuts)), links)
        place = np.arange(len(group)) - np.repeat(np.cumsum(links) - links, links)
        left, right = a[first_a[group] + place // many_b[group]], b[first_b[group] + place % many_b[group]]
        pair, text, times = [left << 16 | right], [owner[group]], [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(~small):
            x, nx = np.unique(a[first_a[g] : first_a[g] + many_a[g]], return_counts=True)
            y, ny = np.unique(b[first_b[g] : first_b[g] + many_b[g]], return_counts=True)
            pair.append(((x << 16)[:, None] | y).ravel())
            text.append(np.full(len(x) * len(y), owner[g]))
            times.append(np.outer(nx, ny).ravel())
        pair, text, times = np.concatenate(pair), np.concatenate(text), np.concatenate(times)
        key, where = np.unique(text << 32 | pair, return_inverse=True)
        sums = np.zeros(len(key), np.int64)
        np.add.at(sums, where, times)
        ends = self.ends[-1] + np.cumsum(np.bincount(key >> 32, minlength=len(texts)))
        # the groups as text: the ids of A, then of B, each with the mark that follows it
        last_a, last_b = (np.append(g[1:] != g[:-1], [True] * min(1, len(g))) for g in (group_a, group_b))
        closes = np.append(of_b[1:] != of_b[:-1], [True] * min(1, len(of_b)))
        marks = np.empty(len(a) + len(b), np.int64)
        marks[np.arange(len(a)) + first_b[group_a]] = a * 4 + np.where(last_a, 1, 0)
        marks[np.arange(len(b)) + (first_a + many_a)[group_b]] = b * 4 + np.where(closes, 3, np.where(last_b, 2, 0))
        written = list(map(self.shown.__getitem__, marks.tolist()))
        upto = np.concatenate(([0], np.cumsum(np.abs(digests[:, 0]) * (digests[:, 0] >= 0) + digests[:, 1]))).tolist()
        before = len(self.texts)
        self.texts.extend("".join(written[i:j]) for i, j in zip(upto, upto[1:]))
        self.digests.frombytes(digests.tobytes())
        self.pairs.frombytes((key & 0xFFFFFFFF).tobytes())
        self.links.frombytes(sums.tobytes())
        self.ends.frombytes(ends.astype(np.int64).tobytes())
        self.held += 16 * len(key) + sum(250 + len(t) for t in self.texts[before:])

    def units(self, texts: list[str]) -> list[list[int]]:
        """Rows of the units of each text."""
        units = [t.split(" ") if t and WordMemoEncoder._apart(t) else [t] if t else [] for t in texts]
        new = list(set(chain.from_iterable(units)).difference(self.rows))
        self.rows.update(zip(new, range(len(self.texts), len(self.texts) + len(new))))
        self.learn(new)
        row = self.rows.__getitem__
        rows = [list(map(row, some)) for some in units]
        for unit in new:
            if len(unit) > MEMO_UNIT:
                del self.rows[unit]
        return rows


def _frame(values: np.ndarray) -> bytes:
    """An array of counts as a zstd frame in the least width; the letter for the width stands first."""
    return _as_is(values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8))


def _as_is(small: np.ndarray) -> bytes:
    return small.dtype.char.encode() + zstandard.compress(small.tobytes(), 3)


def _array(frame: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(frame[1:]), np.dtype(chr(frame[0])))


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))  # wraps, as does the cumulative sum that undoes it


class _Run:
    """What one run of documents writes."""

    def __init__(self, texts: list[str], aligner: Aligner):
        units = aligner.units(texts)
        kept, ends, all_pairs, all_links = (
            np.frombuffer(x, np.int64) if len(x) else np.zeros(0, np.int64)
            for x in (aligner.digests, aligner.ends, aligner.pairs, aligner.links)
        )
        kept = kept.reshape(-1, 4)
        doc = np.repeat(np.arange(len(texts)), [len(u) for u in units])
        row = np.array([r for u in units for r in u], np.int64)
        bad = np.bincount(doc[kept[row, 0] < 0], minlength=len(texts)) > 0
        doc, row = doc[~bad[doc]], row[~bad[doc]]
        sums = np.zeros((len(texts), 4), np.int64)
        np.add.at(sums, doc, kept[row])
        self.digests = {name: sums[:, n] for n, name in enumerate(DIGESTS)}
        self.hashes = [
            "" if not u or bad[n] else hashlib.sha256(";".join([aligner.texts[r] for r in u]).encode()).hexdigest()
            for n, u in enumerate(units)
        ]
        # distinct units of each document, then their pairs
        both, times = np.unique(doc * max(1, len(kept)) + row, return_counts=True)
        doc, row = both // max(1, len(kept)), both % max(1, len(kept))
        sizes = ends[row + 1] - ends[row]
        at = np.arange(int(sizes.sum())) + np.repeat(ends[row] - (np.cumsum(sizes) - sizes), sizes)
        pair, links = all_pairs[at], all_links[at] * np.repeat(times, sizes)
        doc = np.repeat(doc, sizes)
        radix = (pair >> 16) % RADIX
        order = np.lexsort((doc, radix << 32 | pair))
        pair, doc, links = pair[order], doc[order], links[order]
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])
        begin = np.flatnonzero(new)
        self.links = np.add.reduceat(links, begin) if len(begin) else links
        self.docs, pair = doc[begin].astype(np.min_scalar_type(len(texts))), pair[begin]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(pair)), bool), pair[1:] != pair[:-1])))
        self.pairs, self.holders = pair[first], np.diff(np.append(first, len(pair)))

    def entries(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of each radix, the distinct pairs and how many documents hold them."""
        radix = (self.pairs >> 16) % RADIX
        cuts = np.flatnonzero(np.diff(radix)) + 1
        for n, pairs, holders in zip(radix[[0, *cuts]] if len(radix) else (), np.split(self.pairs, cuts), np.split(self.holders, cuts)):
            yield int(n), pairs, holders


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _write_runs(
    batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, run_bytes: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    aligner = _ALIGNERS.setdefault((path_a, path_b), Aligner(path_a, path_b))
    n = 0
    for batch in batches:
        texts = batch["text"].cast(pa.large_string()).fill_null("")
        for begin, end in runs(texts, run_bytes):
            if aligner.held > aligner.memo_bytes:
                aligner.forget()
            run = _Run(texts[begin:end].to_pylist(), aligner)
            name = f"{TaskContext.get().partitionId()}-{n}"
            n += 1
            rows = [
                {"run": name, "radix": radix, "pairs": _frame(_steps(pairs)), "holders": _frame(holders), "is_run": False}
                for radix, pairs, holders in run.entries()
            ]
            whole = {"run": name, "is_run": True, "ids": batch["id"][begin:end].to_pylist(), "hashes": run.hashes}
            whole |= {name: digest.tolist() for name, digest in run.digests.items()}
            whole |= {"holders": _frame(run.holders), "docs": _as_is(_steps(run.docs)), "links": _frame(run.links)}
            yield pa.RecordBatch.from_pylist([*rows, whole], schema)


def _merged(frames: Iterator[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending pairs and the sums of their counts, from lists of ascending pairs and counts."""

    def entries(pairs: bytes, counts: bytes) -> Iterator[tuple[int, int]]:
        return zip(np.cumsum(_array(pairs), dtype=np.int64).tolist(), _array(counts).tolist())

    pairs, counts = [], []
    for pair, same in groupby(heapq.merge(*(entries(*f) for f in frames)), key=lambda e: e[0]):
        pairs.append(pair)
        counts.append(sum(e[1] for e in same))
    return np.array(pairs, np.int64), np.array(counts, np.int64)


def _merge(key: tuple, table: pa.Table) -> pa.Table:
    pairs, counts = _merged(zip(table["pairs"].to_pylist(), table["holders"].to_pylist()))
    return pa.table({"radix": [key[0].as_py()], "part": [key[1].as_py()], "pairs": [_frame(_steps(pairs))], "holders": [_frame(counts)]},
                    pa.schema([("radix", pa.int32()), ("part", pa.int64()), ("pairs", pa.binary()), ("holders", pa.binary())]))


def _send_back(key: tuple, entries: pa.Table, merged: pa.Table) -> pa.Table:
    """For each run of a radix, the corpus counts of its pairs and whether they are the highest of their A id."""
    pairs, counts = (_array(merged[c][0].as_py()) for c in ("pairs", "holders"))
    pairs = np.cumsum(pairs, dtype=np.int64)
    side = pairs >> 16
    begin = np.flatnonzero(np.concatenate(([True], side[1:] != side[:-1])))
    highest = np.repeat(np.maximum.reduceat(counts, begin), np.diff(np.append(begin, len(side))))
    out = []
    for run, own in zip(entries["run"].to_pylist(), entries["pairs"].to_pylist()):
        at = np.searchsorted(pairs, np.cumsum(_array(own), dtype=np.int64))
        out.append((run, key[0].as_py(), _frame(counts[at]), _frame((counts[at] == highest[at]).view(np.uint8))))
    schema = pa.schema([("run", pa.string()), ("radix", pa.int32()), ("counts", pa.binary()), ("best", pa.binary())])
    return pa.table([list(c) for c in zip(*out)] if out else [[]] * 4, schema=schema)


def _add_up(run: pa.Table, back: pa.Table) -> pa.Table:
    row = run.slice(0, 1).to_pylist()[0]
    back = back.sort_by("radix")
    counts, best = ([_array(f) for f in back[c].to_pylist()] for c in ("counts", "best"))
    holders = _array(row["holders"]).astype(np.int64)
    steps, links = _array(row["docs"]), _array(row["links"]).astype(np.int64)
    docs = np.cumsum(steps, dtype=steps.dtype)
    sums = {}
    for name, values in (("n_best", best), ("count_sum", counts)):
        values = np.concatenate([v.astype(np.int64) for v in values]) if values else np.zeros(0, np.int64)
        sums[name] = np.zeros(len(row["ids"]), np.int64)
        np.add.at(sums[name], docs, links * np.repeat(values, holders))
    columns = {"id": pa.array(row["ids"], run.schema.field("ids").type.value_type)} | {c: pa.array(row[c], pa.int64()) for c in DIGESTS}
    columns |= {c: pa.array(v) for c, v in sums.items()}
    return pa.table(columns | {"groups_sha256": pa.array(row["hashes"], pa.string())})


def align_tokenizers(
    docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text", run_bytes: int = RUN_BYTES, fan_in: int = FAN_IN
) -> DataFrame:
    """One row per document row: its id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose
    pair has the highest count of its A id), ``count_sum`` (counts added up over links) and ``groups_sha256``
    (of the groups' ids as text)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    tables = Tables(spark)
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = own.schema["id"].dataType.simpleString()
    fields = ["run string", "radix int", "pairs binary", "holders binary", "docs binary", "links binary", f"ids array<{id_type}>"]
    fields += [f"{c} array<long>" for c in DIGESTS] + ["hashes array<string>", "is_run boolean"]
    arrow = to_arrow_schema(spark.createDataFrame([], ", ".join(fields)).schema)
    written = tables.write(
        own.mapInArrow(lambda batches: _write_runs(batches, path_a, path_b, run_bytes, arrow), ", ".join(fields)), "runs", ["is_run"]
    )
    whole = written.where("is_run").drop("is_run", "radix", "pairs")
    parts = max(1, -(-whole.count() // fan_in))
    entries = written.where("NOT is_run").select(
        "run", "radix", F.pmod(F.xxhash64("run"), F.lit(parts)).alias("part"), "pairs", "holders"
    )
    merged, left = entries, parts
    while True:  # as often as ``fan_in`` divides the number of runs
        merged = merged.groupBy("radix", "part").applyInArrow(_merge, "radix int, part long, pairs binary, holders binary")
        if left == 1:
            break
        left = -(-left // fan_in)
        merged = tables.write(merged, f"merged-{left}").withColumn("part", F.pmod("part", F.lit(left)))
    merged = tables.write(merged, "merged")
    for_each_part = merged.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    back = entries.drop("holders").groupBy("radix", "part").cogroup(for_each_part.groupBy("radix", "part"))
    back = back.applyInArrow(_send_back, "run string, radix int, counts binary, best binary")
    out = whole.groupBy("run").cogroup(back.groupBy("run")).applyInArrow(
        _add_up,
        f"id {id_type}, " + ", ".join(f"{c} long" for c in (*DIGESTS, "n_best", "count_sum")) + ", groups_sha256 string",
    )
    return out.withColumnRenamed("id", id_col)
