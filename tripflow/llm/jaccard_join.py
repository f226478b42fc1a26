"""N-gram Jaccard join: prefixes under several global token orders, then exact verification.

Texts become sets of word shingles. For a threshold t, two sets of similarity t or
more share a token among the first ``n - ceil(t * n) + 1`` of each, under any order
of all tokens. Here every order puts frequent shingles last, the first one before them
shingles of common words, and each permutes the rest in its own way. A pair is verified only if it shares a prefix token under all of them.

Equal sets become one node first. The nodes that have a token in their prefix are
parted by size into ranges of which similar sets share one. A small group gives its
pairs as rows. Of large groups of the same nodes (by count, first node and 128 bits of hashes) one is kept.
A large group gives a star: its first node against the others. Those
that the star links need no further pairs among themselves; the others meet all of
the group's nodes in blocks, inside tasks, which write a spanning forest of the links.

Pairs first compare counts of their tokens by class: the counts differ by no more in
total than the sets do, so a larger difference rules a link out before any set moves.
Longer sets have more classes: with a fixed number of them the counts of two long sets are
alike by the law of large numbers, and long sets are those that share a rare token by chance.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.shared import Tables, tidy
from tripflow.llm.shingles import CLASS_BITS, HASH_BITS, Counts, magnitudes, shingle_sets, word_hashes
from tripflow.llm.tokenizing import runs
from tripflow.llm.words import mix

ORDERS = (21, 22, 23)  # seeds of the token orders
FEW = 32  # a group of more nodes than this goes the way of stars and blocks
BLOCK = 256  # nodes of a large group that meet in one task, on either side
FILTER_BITS = 27  # as a power of two: the most bits of the filter of wanted ids, 16 MB
CLASSES = 64  # token classes whose counts a set carries, at least
CLASS_TOKENS = 8  # a set has a class for so many tokens at most
COUNT_MAX = 127  # counts end here; capped counts differ by no more than the counts
FILTER_PLACES = 4  # bits that an id sets in the filter
_FREQUENT_LOCALLY, _FREQUENT_KEPT = 4, 100_000


@dataclass(frozen=True)
class Similarity:
    """Link when ``100 * intersection >= percent * union`` of the sets of ``words``-word shingles."""

    words: int = 5
    percent: int = 80

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - (self.percent * n + 99) // 100 + 1

    def sizes(self, a: Column, b: Column) -> Column:
        return (F.lit(100) * F.least(a, b)) >= (F.lit(self.percent) * F.greatest(a, b))

    def apart(self, a: np.ndarray, b: np.ndarray, both: int) -> bool:
        """Whether class counts ``a`` and ``b`` of sets with ``both`` tokens in all differ too much for a link."""
        classes = min(len(a), len(b))
        difference = int(np.abs(_folded(a, classes) - _folded(b, classes)).sum())
        return difference * (100 + self.percent) > both * (100 - self.percent)

    def ranges(self, n: Column) -> Column:
        """Two numbers of size ranges; sets whose sizes permit a link have one in common."""
        step = -math.log(self.percent / 100) * (1 + 1e-9)  # a little wide: rounding must not part sizes
        low = F.floor(F.log(n.cast("double")) / F.lit(step)).cast("int")
        return F.array(low, low + 1)


def _classes(n: np.ndarray) -> np.ndarray:
    """How many token classes sets of ``n`` tokens have, a power of two."""
    return np.left_shift(1, np.ceil(np.log2(np.maximum(n / CLASS_TOKENS, CLASSES))).astype(np.int64))


def _folded(counts: np.ndarray, classes: int) -> np.ndarray:
    """The counts by fewer classes: a token's class is its hash modulo their number."""
    return np.minimum(counts.astype(np.int64).reshape(-1, classes).sum(axis=0), COUNT_MAX)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, pa.StringArray]]:
    for a, b in runs(batch.column(column)):
        yield a, b, batch.column(column).slice(a, b - a)


@dataclass(frozen=True)
class Common:
    """What the token orders rest on: the most frequent words and the most frequent shingles."""

    words: Counts
    shingles: Counts


def common_parts(docs: DataFrame, words: int, tables: Tables) -> Common:
    """The most frequent words and shingles with the magnitude of their counts over all documents.

    Shingles of common words, and passages that many documents share, come last in
    all orders, so that few prefixes hold them. The orders are right with any tables,
    as long as all documents use the same: a word or shingle that is missing here
    ranks as rare. That makes the bound on the tables harmless.
    """

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list] = ([], [])
        found: tuple[dict, dict] = ({}, {})

        def merge() -> None:
            for parts, counts in zip(held, found):
                if not parts:
                    continue
                token, n = np.unique(np.concatenate(parts), return_counts=True)
                often = n >= _FREQUENT_LOCALLY
                for t, c in zip(token[often].view(np.int64).tolist(), n[often].tolist()):
                    counts[t] = counts.get(t, 0) + c
                if len(counts) > 4 * _FREQUENT_KEPT:
                    for t in sorted(counts, key=counts.get)[: -2 * _FREQUENT_KEPT]:
                        del counts[t]
                parts.clear()

        size = 0
        for batch in batches:
            for _, _, texts in _texts(batch, 0):
                held[0].append(word_hashes(texts)[0])
                held[1].append(shingle_sets(texts, words)[0] & HASH_BITS)
                size += len(held[0][-1])
                if size > 3_000_000:
                    merge()
                    size = 0
        merge()
        for kind, counts in enumerate(found):
            top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:_FREQUENT_KEPT]
            for at in range(0, len(top), 10_000):
                t, c = zip(*top[at : at + 10_000])
                yield pa.RecordBatch.from_pydict(
                    {"kind": pa.array([kind] * len(t), pa.int32()), "token": pa.array(t, pa.int64()), "n": pa.array(c, pa.int64())}
                )

    counts = docs.select("text").mapInArrow(count, "kind int, token long, n long").groupBy("kind", "token").agg(F.sum("n").alias("n"))
    counts = tables.write(counts, "counts")

    def top(kind: int) -> Counts:
        rows = counts.filter(F.col("kind") == kind).orderBy(F.desc("n"), "token").limit(_FREQUENT_KEPT).select("token", "n").toArrow()
        token = rows.column("token").to_numpy().view(np.uint64)
        order = np.argsort(token)
        magnitude = np.minimum(np.log2(np.maximum(rows.column("n").to_numpy(), 1)).astype(np.uint64) + np.uint64(1), np.uint64(31))
        return token[order], magnitude[order]

    common = Common(top(0), top(1))
    tables.drop("counts")
    return common


def _rank(h: np.ndarray, seed: int, common: Common) -> np.ndarray:
    """A token's place in the order of this seed: last frequent shingles, and in the first order first
    shingles of rare words. The other orders permute all that are not frequent: a passage of rare
    words that two texts share would otherwise lead in every order."""
    often = magnitudes(h & HASH_BITS, common.shingles)
    rare = h >> np.uint64(64 - CLASS_BITS) if seed == ORDERS[0] else np.uint64(0)
    level = np.where(often > 0, often + np.uint64(32), rare)
    return (mix(h, seed) >> np.uint64(6)) | (level << np.uint64(58))


def _list(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _sets(docs: DataFrame, how: Similarity, common: Common) -> DataFrame:
    """doc_id, n, key (a digest of the set), its counts by token class, and its prefix under the
    first order. The prefixes under later orders are taken where a pair's whole sets meet."""

    @tidy
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in _texts(batch, 1):
                h, ends = shingle_sets(texts, how.words, common.words)
                n = np.diff(ends)
                owner = np.repeat(np.arange(len(n)), n)
                take = np.where(n > 0, how.prefix(n), 0)
                prefix_ends = np.concatenate(([0], np.cumsum(take)))
                rank = _rank(h, ORDERS[0], common)
                order = np.lexsort((rank, owner))
                first = np.arange(len(h)) - ends[:-1][owner] < take[owner]
                prefix = _list(rank[order][first].view(np.int64), prefix_ends, pa.int64())
                sums = [np.concatenate(([np.uint64(0)], np.cumsum(mix(h, s)))) for s in (31, 32)]
                digest = np.stack([(s[ends[1:]] - s[ends[:-1]]) for s in sums], axis=1).astype("<u8")
                classes = _classes(n)
                class_ends = np.concatenate(([0], np.cumsum(classes)))
                at = class_ends[:-1][owner] + (mix(h, 41) % classes[owner].astype(np.uint64)).astype(np.int64)
                counts = _list(np.minimum(np.bincount(at, minlength=class_ends[-1]), COUNT_MAX).astype(np.int8), class_ends, pa.int8())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array([d.tobytes() for d in digest], pa.binary()), counts, prefix],
                    names=["doc_id", "n", "key", "counts", "prefix"],
                )

    return docs.mapInArrow(build, "doc_id long, n long, key binary, counts array<tinyint>, prefix array<long>")


def _id_filter(wanted: DataFrame) -> tuple[np.ndarray, int]:
    """Bits that are set at the places of the wanted ids, and how many bits there are: 16 an id, at most ``FILTER_BITS``.
    With more ids the filter lets more texts through, which the joins after it sort out."""
    bits = 1 << min(FILTER_BITS, max(15, (16 * wanted.count()).bit_length()))
    at = wanted.select(F.explode(_filter_places(F.col("rep"), bits)).alias("place")).select((F.col("place") + 1).alias("at"))
    rows = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for row in rows.collect():  # at most bits / 2**15 rows of 4 KB
        begin = (row["bucket"] - 1) * 4096
        out[begin : begin + 4096] = np.frombuffer(row["bits"], np.uint8)
    return out, bits


def _filter_places(doc_id: Column, bits: int) -> Column:
    return F.array(*(F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(bits)) for seed in range(FILTER_PLACES)))


def _tokens(docs: DataFrame, wanted: DataFrame, how: Similarity, common: Common) -> DataFrame:
    """rep, mark and tokens (ascending 64-bit hashes) of the wanted nodes, from the text of one document of
    each, and of few others. Where an id repeats, ``mark`` tells the node's text from others; rows that repeat give the
    node more than once, which adds no link. Neither texts nor sets move: sets are made where they are read, of those documents
    that a filter of bounded size lets through, and found by rep and mark."""
    held, bits = _id_filter(wanted)
    held = docs.sparkSession.sparkContext.broadcast(held)

    @tidy
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, FILTER_PLACES)
            batch = batch.filter(pa.array(((held.value[place >> 3] >> (place & 7)) & 1 == 1).all(axis=1)))
            for a, b, texts in _texts(batch, 1):
                h, ends = shingle_sets(texts, how.words, common.words)
                sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(h, 31))))
                own = (sums[ends[1:]] - sums[ends[:-1]]).astype("<u8").view(">i8").astype(np.int64)
                rows = [(doc, k, h[s:e].tobytes()) for doc, k, s, e in zip(batch.column(0)[a:b].to_pylist(), own.tolist(), ends[:-1], ends[1:])]
                for at in range(0, len(rows), 256):
                    columns = zip(*rows[at : at + 256])
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()))], names=["rep", "mark", "tokens"])

    some = docs.filter("doc_id IS NOT NULL").select("doc_id", "text", _filter_places(F.col("doc_id"), bits).alias("places"))
    return some.mapInArrow(build, "rep long, mark long, tokens binary")


def _alike(pairs: DataFrame, nodes: DataFrame, how: Similarity) -> DataFrame:
    """The pairs whose counts by token class permit a link."""

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            x, y = (batch.column(c) for c in ("counts_a", "counts_b"))
            flat_x, at_x, flat_y, at_y = (part.to_numpy() for c in (x, y) for part in (c.values, c.offsets))
            keep = [
                not how.apart(flat_x[at_x[i] : at_x[i + 1]], flat_y[at_y[i] : at_y[i + 1]], int(n_a[i]) + int(n_b[i]))
                for i in range(len(batch))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    counts = nodes.select("ref", F.col("n").cast("int").alias("n"), "counts")
    pairs = pairs.join(counts.toDF("a", "n_a", "counts_a"), "a").join(counts.toDF("b", "n_b", "counts_b"), "b")
    return pairs.mapInArrow(compare, "a long, b long")


def _heads(tokens: np.ndarray, how: Similarity, common: Common) -> list[np.ndarray]:
    """A set's prefix under each order after the first."""
    take = how.prefix(len(tokens))
    return [np.sort(_rank(tokens, seed, common))[:take] for seed in ORDERS[1:]]


def _linked(a: bytes, b: bytes, how: Similarity, common: Common) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if not all(len(np.intersect1d(p, q)) for p, q in zip(_heads(x, how, common), _heads(y, how, common))):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= how.percent * (len(x) + len(y) - both)


def _verified(pairs: DataFrame, wanted: DataFrame, tokens: DataFrame, how: Similarity, common: Common) -> DataFrame:
    """Of the pairs, those that share a token of their prefixes under the later orders too and are alike enough."""

    @tidy
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            keep = [i for i in range(len(a)) if _linked(x[i], y[i], how, common)]
            yield pa.RecordBatch.from_pydict({"a": pa.array([a[i] for i in keep], pa.int64()), "b": pa.array([b[i] for i in keep], pa.int64())})

    # both joins read the same columns under the same names of the same exchange, so Spark deals the sets once
    tokens = tokens.repartition("rep", "mark")
    pairs = pairs.join(wanted.toDF("a", "rep_a", "mark_a"), "a").join(wanted.toDF("b", "rep_b", "mark_b"), "b")
    first = pairs.join(tokens, (F.col("rep_a") == F.col("rep")) & (F.col("mark_a") == F.col("mark")))
    first = first.select("a", "b", "rep_b", "mark_b", F.col("tokens").alias("tokens_a"))
    both = first.join(tokens, (F.col("rep_b") == F.col("rep")) & (F.col("mark_b") == F.col("mark"))).select("a", "b", "tokens_a", "tokens")
    return both.mapInArrow(verify, "a long, b long")


def _groups(nodes: DataFrame, how: Similarity, tables: Tables) -> DataFrame:
    """slot, ref, n of the nodes that share a prefix token and a range of sizes, beside their group's count c, its first
    node ``hub`` of ``hub_n`` tokens and two marks of its nodes. A slot is the hash of token and range: should two
    of them fall together, their nodes are compared in vain.

    Rows are dealt by token, and those of shared tokens by slot; either time groups and their rows are read from the same
    exchange, as the groups use all columns of their rows.
    """
    postings = nodes.select("ref", F.col("n").cast("int").alias("n"), F.explode("prefix").alias("token")).repartition("token")
    of_token = [f(c).alias(f"{name}_{c}") for c in ("ref", "n") for name, f in (("least", F.min), ("most", F.max))]
    tokens = postings.groupBy("token").agg(F.count(F.lit(1)).alias("c"), *of_token)
    # of two nodes alone the sizes decide
    tokens = tokens.filter((F.col("least_ref") < F.col("most_ref")) & ((F.col("c") > 2) | how.sizes(F.col("least_n"), F.col("most_n"))))
    shared = postings.join(tokens.select("token"), "token")
    slots = shared.select(F.explode(how.ranges(F.col("n"))).alias("size"), "token", "ref", "n")
    postings = tables.write(slots.select(F.xxhash64("token", "size").alias("slot"), "ref", "n"), "postings").repartition("slot")
    marks = [F.bit_xor(F.xxhash64("ref", F.lit(seed))).alias(f"mark_{seed}") for seed in (1, 2)]
    groups = postings.groupBy("slot").agg(F.count(F.lit(1)).alias("c"), F.min("ref").alias("hub"), F.min_by("n", "ref").alias("hub_n"), *marks)
    return postings.join(groups.filter("c > 1"), "slot")


def _pairs(few: DataFrame, how: Similarity) -> DataFrame:
    """a and b, the smaller ref first, of nodes that are together in a group of at most ``FEW`` and whose sizes permit a link."""
    met = few.groupBy("slot").agg(F.collect_list(F.struct("ref", "n")).alias("x"))
    met = met.select(F.explode("x").alias("x"), F.col("x").alias("ys")).select("x", F.explode("ys").alias("y"))
    met = met.filter((F.col("x.ref") < F.col("y.ref")) & how.sizes(F.col("x.n"), F.col("y.n")))
    return met.select(F.col("x.ref").alias("a"), F.col("y.ref").alias("b"))


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens each set of one side shares with each set of the other."""
    out = np.zeros((len(left), len(right)), np.float32)
    x, y = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(x, y)
    if not len(shared):
        return out

    def places(sets: list[np.ndarray], flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(shared, flat), len(shared) - 1)
        hit = shared[at] == flat
        return owner[hit], at[hit]

    (lo, la), (ro, ra) = places(left, x), places(right, y)
    for start in range(0, len(shared), 4096):
        width = min(4096, len(shared) - start)
        one, two = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        for m, owner, at in ((one, lo, la), (two, ro, ra)):
            now = (at >= start) & (at < start + width)
            m[owner[now], at[now] - start] = 1
        out += one @ two.T
    return out


def _block_links(table: pa.Table, how: Similarity, common: Common) -> pa.Table:
    """A spanning forest of the links between the two sides of a block, or inside one side."""
    refs = table.column("ref").to_numpy()
    sets = [np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()]
    side = table.column("side").to_numpy()
    left = np.flatnonzero(side == side.min())
    right = np.flatnonzero(side == side.max())
    n = np.array([len(s) for s in sets])
    ok = 100 * np.minimum.outer(n[left], n[right]) >= how.percent * np.maximum.outer(n[left], n[right])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    begin = np.concatenate(([0], np.cumsum(n)))
    take = how.prefix(n)
    for seed in ORDERS[1:]:
        rank = _rank(flat, seed, common)
        order = np.lexsort((rank, owner))
        heads = [rank[order[s : s + p]] for s, p in zip(begin, take)]
        ok &= _overlaps([heads[i] for i in left], [heads[i] for i in right]) > 0
    both = _overlaps([sets[i] for i in left], [sets[i] for i in right])
    ok &= 100 * both >= how.percent * (n[left][:, None] + n[right][None, :] - both)
    root = {int(r): int(r) for r in refs}

    def find(r: int) -> int:
        while root[r] != r:
            root[r] = root[root[r]]
            r = root[r]
        return r

    links = []
    for i, j in zip(*np.nonzero(ok)):
        a, b = int(refs[left[i]]), int(refs[right[j]])
        ra, rb = find(a), find(b)
        if ra != rb:
            root[max(ra, rb)] = min(ra, rb)
            links.append((min(a, b), max(a, b)))
            if len(links) == len(root) - 1:  # all are connected
                break
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def connected(edges: DataFrame, tables: Tables) -> DataFrame:
    """ref and the smallest ref it is connected with, for every end of an edge.

    Alternates the large and the small star: neighbours above a node, then those not
    above it, are joined to the smallest one. Each round is a written table.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    edges = tables.write(edges, "edges-0")
    before = None
    for turn in itertools.count(1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a > b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .filter("a > b")
            .distinct()
        )
        edges = tables.write(small, f"edges-{turn}")
        tables.drop(f"edges-{turn - 1}")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("ref"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("ref"), F.col("b").alias("root")).distinct()
    )


def jaccard_components(docs: DataFrame, how: Similarity = Similarity(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links, itself included).

    A null text counts as empty; empty texts link with nothing. Rows that repeat and
    equal texts are one node and share a component. Null ids link with nothing and
    have a null component. Other columns are not read; an empty table gives no rows.
    Intermediate tables lie in the shared folder; those that the result reads stay
    there until the session ends.
    """
    return _components(docs, how, id_col, text_col, Tables(docs.sparkSession))


def _components(docs: DataFrame, how: Similarity, id_col: str, text_col: str, tables: Tables) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    common = common_parts(docs, how.words, tables)
    sets = tables.write(_sets(docs, how, common), "sets")

    nodes = tables.write(
        sets.filter("n > 0 AND doc_id IS NOT NULL")
        .groupBy("key")
        .agg(F.min("doc_id").alias("rep"), F.first(F.struct("n", "counts", "prefix")).alias("set"))
        .select(F.monotonically_increasing_id().alias("ref"), "key", "rep", "set.*"),
        "nodes",
    )
    groups = tables.write(_groups(nodes, how, tables), "groups")
    tables.drop("postings")
    # a passage gives one large group of the same nodes for each of its shingles: one of them is compared
    same = ["c", "hub", "hub_n", "mark_1", "mark_2"]
    many = groups.filter((F.col("c") > FEW) & (F.col("ref") == F.col("hub"))).groupBy(*same).agg(F.min("slot").alias("slot")).select("slot")
    many = groups.filter(F.col("c") > FEW).select("slot", "ref", "n", "hub", "hub_n").join(many, "slot", "left_semi")
    many = tables.write(many, "many")

    star = many.filter((F.col("ref") != F.col("hub")) & how.sizes(F.col("n"), F.col("hub_n"))).select(F.col("hub").alias("a"), F.col("ref").alias("b"))
    pairs = _pairs(groups.filter(F.col("c") <= FEW), how).unionByName(star).distinct()
    pairs = tables.write(_alike(pairs, nodes, how), "pairs")
    tables.drop("groups")

    wanted = (
        pairs.select(F.col("a").alias("ref")).unionByName(pairs.select(F.col("b").alias("ref"))).unionByName(many.select("ref")).distinct()
    )
    # eight bytes of the digest as a long
    high, low = (F.conv(F.hex(F.substring("key", at, 4)), 16, 10).cast("long") for at in (1, 5))
    mark = F.shiftleft(high, 32).bitwiseOR(low).alias("mark")
    wanted = tables.write(nodes.select("ref", "rep", mark).join(wanted, "ref").select("ref", "rep", "mark"), "wanted")
    tokens = tables.write(_tokens(docs, wanted, how, common), "tokens")
    links = tables.write(_verified(pairs, wanted, tokens, how, common), "links")
    tables.drop("pairs")

    # of a large group: those its hub is linked to, and the others, which still have to meet everyone
    tied = links.select(F.col("a").alias("hub"), F.col("b").alias("ref"), F.lit(True).alias("tied"))
    many = many.join(tied, ["hub", "ref"], "left").withColumn("tied", F.coalesce("tied", F.col("hub") == F.col("ref")))
    loose = many.groupBy("slot").agg(F.count_if(~F.col("tied")).alias("loose"), F.count(F.lit(1)).alias("all"))
    many = many.join(loose.filter("loose > 0"), "slot")
    loose_blocks = F.ceil(F.col("loose") / BLOCK).cast("int")
    tied_blocks = F.ceil((F.col("all") - F.col("loose")) / BLOCK).cast("int")
    whole = F.col("all") <= BLOCK  # such a group is one block, and each of its sets moves once
    own = F.when(whole, 0).when(F.col("tied"), loose_blocks + F.pmod(F.xxhash64("ref"), tied_blocks)).otherwise(F.pmod(F.xxhash64("ref"), loose_blocks)).cast("int")
    # loose blocks come first; a tied block meets loose ones only
    partners = F.when(whole, F.array(F.lit(0))).when(F.col("tied"), F.sequence(F.lit(0), loose_blocks - 1)).otherwise(F.sequence(F.lit(0), loose_blocks + tied_blocks - 1))
    met = many.select("slot", "ref", own.alias("side"), F.explode(partners).alias("partner"))
    met = met.select("slot", F.least("side", "partner").alias("one"), F.greatest("side", "partner").alias("two"), "side", "ref")

    def block(table: pa.Table) -> pa.Table:
        return _block_links(table, how, common)

    more = met.join(wanted, "ref").join(tokens, ["rep", "mark"]).drop("rep", "mark").groupBy("slot", "one", "two").applyInArrow(block, "a long, b long")
    roots = connected(links.unionByName(more), tables)
    tables.drop("many", "wanted", "tokens", "links")
    lowest = roots.join(nodes.select("ref", "rep"), "ref")
    lowest = lowest.join(lowest.groupBy("root").agg(F.min("rep").alias("low")), "root").select("ref", "low")
    named = nodes.select("ref", "key", "rep").join(lowest, "ref", "left").select("key", F.coalesce("low", "rep").alias("component"))
    members = sets.select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("key")).alias("key"))
    linked = members.filter("key IS NOT NULL").join(named, "key").select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    alone = members.filter("key IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def drop_near_copies(docs: DataFrame, how: Similarity = Similarity(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all columns, of the document with the smallest id of each component.

    Rows of one id stay or go together; null ids stay.
    """
    tables = Tables(docs.sparkSession)
    gone = (
        _components(docs, how, id_col, text_col, tables)
        .filter("component_id < doc_id")
        .select(F.col("doc_id").alias("__gone"))
        .distinct()
    )
    inner = list(tables.paths)
    gone = tables.write(gone, "gone")
    tables.drop(*inner)
    return docs.join(gone, F.col(id_col) == F.col("__gone"), "left_anti").select(*docs.columns)
