"""Spelling variants: words one edit from a much more frequent word.

Words are runs of A-Z, a-z and U+00C0-U+00FF with at least ``min_letters`` letters after A-Z became a-z,
that occur ``min_count`` times or more in all texts together. Two words are near if they differ by exactly
one inserted, deleted or replaced letter. The form of a word is its near word that occurs most often (of several
the first in code-point order) if it occurs ``ratio`` times as often as the word or more.

Near words are found over a frequency-vector trie (:mod:`tripflow.llm.frequency_trie`). The trie is cut into
nodes of at most ``node_words`` words; a node meets the nodes whose letter counts are within the budgets,
and one task goes down the two subtrees together. Words of equal counts on all levels that are
more than ``node_words`` are dealt into chunks, and chunk meets chunk. Nothing is left out.

Rows: one per word that occurs often enough; none if no text has such a word (also for an empty table). Null and
empty texts have no words. Repeated document rows count each. A null id counts as an empty one where
``slip_every`` uses ids. Letters beyond the range end a word. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.frequency_trie import GROUPS, Trie, near_pairs, paths
from tripflow.llm.shared import Tables

NODE_WORDS = 65_536
DEPTHS = (1, 2, 3, 4, 5, 6, 8, 10, 13, 16, 24, GROUPS)  # where the trie may be cut
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_letters: int = 7, min_count: int = 2, slip_every: int | None = None
) -> DataFrame:
    """``word`` and how often it occurs, ``n``.

    With ``slip_every``, a word of a document whose checksum (of ``<id>:<word>``) this number divides
    loses the letter at checksum modulo length: misspelled words, for trials."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit("([A-Za-zÀ-ÿ]{%d,})" % min_letters), F.lit(1))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("word"))
    rows = rows.withColumn("word", F.translate("word", _UPPER, _LOWER))
    if slip_every:
        rows = rows.withColumn("sum", F.crc32(F.concat_ws(":", "id", "word")))
        at = (F.col("sum") % F.length("word")).cast("int")
        shorter = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        rows = rows.withColumn("word", F.when(F.col("sum") % slip_every == 0, shorter).otherwise(F.col("word")))
        rows = rows.where(F.length("word") >= min_letters)
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _letters(words: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in words.to_pylist()]  # a code point a byte


def _level_order(words: DataFrame) -> np.ndarray:
    """Letter groups, those first that part the words most evenly."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            have = (paths(_letters(batch["word"]), np.arange(GROUPS)) > 0).sum(axis=0)
            yield pa.RecordBatch.from_pydict({"level": np.arange(GROUPS, dtype=np.int32), "have": have, "of": np.full(GROUPS, batch.num_rows)})

    rows = words.select("word").mapInArrow(count, "level int, have long, of long").groupBy("level").agg(F.sum("have"), F.sum("of")).collect()
    uneven = {level: abs(have / of - 0.5) for level, have, of in rows}
    return np.array(sorted(range(GROUPS), key=lambda level: (uneven.get(level, 0.5), level)))


def _with_path(words: DataFrame, levels: np.ndarray) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [p.tobytes() for p in paths(_letters(batch["word"]), levels)]
            yield pa.RecordBatch.from_pydict({"word": batch["word"], "n": batch["n"], "path": pa.array(found, pa.binary())})

    return words.mapInArrow(add, "word string, n long, path binary")


def _start(depth: int) -> F.Column:
    return F.substring("path", 1, depth)


def _nodes(words: DataFrame, node_words: int, tables: Tables) -> DataFrame:
    """Where the trie is cut: ``node`` (the beginning that its words share) and ``chunks``. Beginnings with more than
    ``node_words`` words are cut again further down."""
    out, rest = None, words
    for depth in DEPTHS:
        counted = tables.write(rest.groupBy(_start(depth).alias("node")).agg(F.count(F.lit(1)).alias("words")), f"nodes-{depth}")
        fits = counted if depth == GROUPS else counted.where(F.col("words") <= node_words)
        fits = fits.select("node", F.ceil(F.col("words") / node_words).cast("int").alias("chunks"))
        out = fits if out is None else out.unionByName(fits)
        large = counted.where(F.col("words") > node_words)
        if depth == GROUPS or large.isEmpty():
            return out
        rest = rest.join(large.select("node"), _start(depth) == F.col("node"), "left_semi")


def _within_budget(start: bytes) -> Iterator[bytes]:
    """Beginnings of paths that differ from ``start`` by a surplus and a deficit of at most one each."""

    def changed(*steps: tuple[int, int]) -> bytes | None:
        counts = list(start)
        for place, by in steps:
            counts[place] += by
        return bytes(counts) if all(0 <= c <= 255 for c in counts) else None

    places = range(len(start))
    found = [changed()] + [changed((k, by)) for k in places for by in (1, -1)]
    found += [changed((k, 1), (m, -1)) for k in places for m in places if k != m]
    return (f for f in found if f is not None)


def _node_pairs(nodes: DataFrame) -> DataFrame:
    """Chunks of nodes that may hold near words: each pair once, a chunk with itself too."""

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, chunks in zip(batch["node"].to_pylist(), batch["chunks"].to_pylist()):
                other = [p for depth in DEPTHS if depth <= len(node) for p in _within_budget(node[:depth])]
                other = [p for p in other if len(p) < len(node) or p >= node]
                yield pa.RecordBatch.from_pydict(
                    {"a": pa.array([node] * len(other), pa.binary()), "a_chunks": pa.array([chunks] * len(other), pa.int32()), "b": pa.array(other, pa.binary())}
                )

    near = nodes.mapInArrow(partners, "a binary, a_chunks int, b binary").join(nodes.withColumnRenamed("node", "b"), "b")
    chunk = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    both = near.select("a", "b", "chunks", chunk("a_chunks").alias("a_chunk")).select("a", "b", "a_chunk", chunk("chunks").alias("b_chunk"))
    return both.where("a <> b OR a_chunk <= b_chunk")


def _compare(table: pa.Table, levels: np.ndarray, schema: pa.Schema) -> pa.Table:
    """What two chunks of nodes (``side`` 0 and 1; only 0 for a chunk with itself) add to their words."""
    table = table.combine_chunks()
    side = table["side"].to_numpy()
    words, n = table["word"].to_pylist(), table["n"].to_numpy()
    rank = np.empty(len(words), np.int64)  # 0: most frequent, of these the first in order
    rank[np.lexsort((np.unique(np.array(words, object), return_inverse=True)[1], -n))] = np.arange(len(words))
    by_rank = np.argsort(rank)
    tries, own = [], []
    for k in (0, 1) if side.any() else (0,):
        mine = np.flatnonzero(side == k)
        tries.append(Trie([words[i].encode("latin-1") for i in mine], levels))
        own.append(mine[tries[-1].order])
    near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))
    for i, j in near_pairs(tries[0], tries[-1]):
        i, j = own[0][i], own[-1][j]
        for to, of in ((i, j), (j, i))[: len(tries)]:
            np.add.at(near, to, 1)
            np.minimum.at(best, to, rank[of])
    some = np.flatnonzero(near)
    best = by_rank[best[some]]
    return pa.table([[words[i] for i in some], near[some], [words[i] for i in best], n[best]], schema=schema)


def near_words(words: DataFrame, node_words: int = NODE_WORDS, tables: Tables | None = None) -> DataFrame:
    """Of each word (columns ``word``, ``n``) that has near words: how many, ``n_near``, the most frequent of them, ``best``, and its ``best_n``."""
    tables = tables or Tables(words.sparkSession)
    levels = _level_order(words)
    words = tables.write(_with_path(words, levels), "paths")
    nodes = tables.write(_nodes(words, node_words, tables), "nodes")
    pairs = tables.write(_node_pairs(nodes).withColumn("pair", F.monotonically_increasing_id()), "node-pairs")
    start = F.explode(F.array(*(_start(d) for d in DEPTHS))).alias("node")
    placed = words.select("word", "n", start).join(nodes, "node")
    placed = tables.write(placed.select("node", F.pmod(F.xxhash64("word"), "chunks").cast("int").alias("chunk"), "word", "n"), "placed")
    sides = []
    for side, name in enumerate(("a", "b")):
        here = pairs if side == 0 else pairs.where("a <> b OR a_chunk <> b_chunk")
        met = (F.col("node") == F.col(name)) & (F.col("chunk") == F.col(f"{name}_chunk"))
        sides.append(placed.join(here, met).select("pair", F.lit(side).cast("byte").alias("side"), "word", "n"))
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best", pa.string()), ("best_n", pa.int64())])
    found = sides[0].unionByName(sides[1]).groupBy("pair").applyInArrow(lambda table: _compare(table, levels, schema), "word string, n_near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top"))
    return found.select("word", "n_near", F.col("top.word").alias("best"), (-F.col("top.n")).alias("best_n"))


def _roots(forms: DataFrame, most: int, ratio: int, tables: Tables) -> DataFrame:
    """The last word of each chain of forms. Each step has ``ratio`` times the count, so chains have at most
    log(most) of them, and every round doubles what is behind."""
    roots = tables.write(forms.select("word", F.col("form").alias("root")), "roots-0")
    for n in range(max(0, math.ceil(math.log(max(1, most), ratio))).bit_length()):
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        roots = tables.write(further, f"roots-{n + 1}")
        tables.drop(f"roots-{n}")
    return roots


def spelling_variants(docs: DataFrame, *, ratio: int = 10, node_words: int = NODE_WORDS, **counting) -> DataFrame:
    """One row per word: ``word``, ``n``, ``form`` and ``form_n`` (null without one), ``root`` (what forms of forms lead to,
    or the word itself) and ``n_near``. ``counting`` goes to :func:`word_counts`."""
    if ratio < 2:
        raise ValueError("forms must occur at least twice as often")
    tables = Tables(docs.sparkSession)
    words = tables.write(word_counts(docs, **counting), "words")
    near = tables.write(words.join(near_words(words, node_words, tables), "word", "left"), "near")
    is_form = F.col("best_n") >= F.col("n") * ratio
    near = near.withColumn("form", F.when(is_form, F.col("best"))).withColumn("form_n", F.when(is_form, F.col("best_n")))
    most = words.agg(F.max("n")).first()[0] or 1
    roots = _roots(near.where("form IS NOT NULL"), most, ratio, tables)
    return near.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )
