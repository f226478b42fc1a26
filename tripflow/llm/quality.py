"""Document quality: random-indexing word vectors, pooled, and a small calibrated network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tripflow.llm.shared import tidy
from tripflow.llm.tokenizing import runs
from tripflow.llm.words import bytes_of, hashes, mix, stretches

BUCKETS, SIZE, MARKS = 8192, 32, 4  # word buckets, vector length, non-zero entries of an index vector
WINDOW = 2  # words to either side that are a word's context
POOLED = 3 * SIZE
SCORE = "__quality_score"

# kinds of bytes whose stretches count as words: letters, digits, signs
_KIND = np.full(256, 3, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = 1
_KIND[128:] = 1


def word_buckets(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every stretch of letters, digits or signs, in order."""
    raw, ends = bytes_of(texts)
    begin, end, text = stretches(_KIND[raw], ends)
    return (hashes(raw, begin, end) % np.uint64(BUCKETS)).astype(np.int64), text


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Each bucket's random index vector: the places of its few non-zero entries, and their signs."""
    draws = mix(np.arange(BUCKETS * MARKS, dtype=np.uint64), 7).reshape(BUCKETS, MARKS)
    return (draws % np.uint64(SIZE)).astype(np.int64), np.where(draws >> np.uint64(63), 1, -1).astype(np.int64)


def _contexts(texts: pa.StringArray, places: np.ndarray, signs: np.ndarray, into: np.ndarray) -> None:
    """Adds to each bucket's row the index vectors of the words around its words."""
    word, text = word_buckets(texts)
    for gap in range(1, WINDOW + 1):
        same = text[gap:] == text[:-gap]
        a, b = word[:-gap][same], word[gap:][same]
        for one, other in ((a, b), (b, a)):
            for k in range(MARKS):
                cell = one * SIZE + places[other, k]
                up = signs[other, k] > 0
                into += np.bincount(cell[up], minlength=BUCKETS * SIZE)
                into -= np.bincount(cell[~up], minlength=BUCKETS * SIZE)


_ROWS = 128  # buckets in a row of the partial sums


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit vectors of all word buckets, from the contexts of every word of every document.

    A task sums its own contexts; the sums are added up in two rounds. The result is
    of fixed size, whatever the corpus.
    """

    @tidy
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        places, signs = index_vectors()
        total = np.zeros(BUCKETS * SIZE, np.int64)
        for batch in batches:
            for a, b in runs(batch.column(0)):
                _contexts(batch.column(0).slice(a, b - a), places, signs, total)
        rows = total.reshape(BUCKETS // _ROWS, -1)
        group = TaskContext.get().partitionId() // 32
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(range(len(rows)), pa.int32()),
                "group": pa.array([group] * len(rows), pa.int32()),
                "sums": pa.array([r.astype("<i8").tobytes() for r in rows], pa.binary()),
            }
        )

    @tidy
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for part, group, raw in zip(*(c.to_pylist() for c in batch.columns)):
                key = (part, group // 32)
                sums[key] = sums.get(key, 0) + np.frombuffer(raw, "<i8")
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([k[0] for k in sums], pa.int32()),
                "group": pa.array([k[1] for k in sums], pa.int32()),
                "sums": pa.array([v.astype("<i8").tobytes() for v in sums.values()], pa.binary()),
            }
        )

    schema = "part int, group int, sums binary"
    sums = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(partial, schema)
    for keys in (("part", "group"), ("part",)):
        sums = sums.repartition(*keys).mapInArrow(add, schema)
    total = np.zeros((BUCKETS // _ROWS, _ROWS * SIZE), np.float64)
    for row in sums.collect():  # of fixed size: one row of sums for each part
        total[row["part"]] += np.frombuffer(row["sums"], "<i8")
    vectors = total.reshape(BUCKETS, SIZE)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(norms > 0, norms, 1)).astype(np.float32)


def pooled(texts: pa.StringArray, vectors: np.ndarray) -> np.ndarray:
    """Per text the mean and the deviation of its word vectors, and the mean step from word to word.

    A text without words has zeros.
    """
    word, text = word_buckets(texts)
    out = np.zeros((len(texts), POOLED), np.float32)
    if not len(word):
        return out
    seen, first = np.unique(text, return_index=True)
    count = np.diff(np.append(first, len(word)))[:, None]
    v = vectors[word]
    mean = np.add.reduceat(v, first) / count
    square = np.add.reduceat(v * v, first) / count
    step = np.zeros_like(v)
    np.abs(v[1:] - v[:-1], out=step[1:])
    step[first] = 0  # the first word of a text has none before it
    out[seen, :SIZE] = mean
    out[seen, SIZE : 2 * SIZE] = np.sqrt(np.maximum(square - mean * mean, 0))
    out[seen, 2 * SIZE :] = np.add.reduceat(step, first) / np.maximum(count - 1, 1)
    return out


@dataclass
class Network:
    """Two layers; ``temperature`` scales the logit so that scores are probabilities."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.centre) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x.astype(np.float64)) / self.temperature, -30, 30)))


def train_network(
    x: np.ndarray, y: np.ndarray, *, hidden: int = 32, epochs: int = 40, batch: int = 128, rate: float = 2e-3,
    decay: float = 1e-4, seed: int = 11,
) -> Network:
    """Fits by Adam on four fifths of the rows and the temperature on the rest.

    Rows of one label only, or none, give a constant: their share of label 1 (1.0 for no rows).
    """
    x, y = x.astype(np.float64), y.astype(np.float64)
    if not len(y) or y.min() == y.max():
        share = np.clip(y.mean() if len(y) else 1.0, 1e-6, 1 - 1e-6)
        wide = x.shape[1] if x.ndim == 2 else POOLED
        return Network(np.zeros(wide), np.ones(wide), np.zeros((wide, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, fit = np.split(order, [len(y) // 5])
    net = Network(
        x[fit].mean(0), x[fit].std(0) + 1e-3, rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)),
        np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), hidden), 0.0,
    )
    moments: dict[str, list] = {}
    t = 0
    for epoch in range(epochs):
        pace = rate * (1 - epoch / epochs)
        for rows in np.array_split(rng.permutation(fit), max(1, len(fit) // batch)):
            t += 1
            z = (x[rows] - net.centre) / net.scale
            pre = z @ net.w1 + net.b1
            h = np.maximum(pre, 0)
            p = 1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2, -30, 30)))
            g = (p - y[rows]) / len(rows)
            back = np.outer(g, net.w2) * (pre > 0)
            for name, grad in (
                ("w1", z.T @ back + decay * net.w1), ("b1", back.sum(0)), ("w2", h.T @ g + decay * net.w2), ("b2", g.sum()),
            ):
                m = moments.setdefault(name, [0.0, 0.0])
                m[0] = 0.9 * m[0] + 0.1 * grad
                m[1] = 0.999 * m[1] + 0.001 * grad * grad
                fall = pace * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.999**t)) + 1e-8)
                setattr(net, name, getattr(net, name) - fall)
    if len(held):
        logit, target = net.logit(x[held]), y[held]
        tries = np.geomspace(0.25, 8, 61)
        loss = [np.mean(np.logaddexp(0, -np.where(target > 0, logit, -logit) / t)) for t in tries]
        net.temperature = float(tries[int(np.argmin(loss))])
    return net


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document are kept from training."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """All columns of the rows and ``SCORE``; only the text is looked at. A null text counts as empty."""
        at = docs.columns.index(text_col)
        model = self

        @tidy
        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(at).fill_null("")
                scores = [model.network.score(pooled(texts.slice(a, b - a), model.vectors)) for a, b in runs(texts)]
                column = pa.array(np.concatenate(scores) if scores else [], pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, SCORE])

        return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField(SCORE, DoubleType())]))


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train_rows: int = 16_000
) -> QualityModel:
    """Word vectors from all documents, and the network from at most ``train_rows`` labelled rows.

    Labels of held-out documents, null labels and labels without a document teach
    nothing. The rows come in the order of a hash of the id; a document labelled
    more than once is an example each time. Only the text makes the features. Empty
    tables give a constant score (see ``train_network``).
    """
    vectors = word_vectors(docs, text_col)
    chosen = (
        labels.select(F.col(id_col).cast("long").alias("label_id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("label").isNotNull() & F.col("label_id").isNotNull() & ~held_out(F.col("label_id")))
        .orderBy(F.xxhash64("label_id"), "label")
        .limit(train_rows)
    )
    rows = docs.select(F.col(id_col).cast("long").alias("label_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    taught = rows.join(F.broadcast(chosen), "label_id").select("label_id", "label", "text")

    @tidy
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in runs(batch.column(2)):
                x = pooled(batch.column(2).slice(a, b - a), vectors)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array([r.astype("<f4").tobytes() for r in x], pa.binary())],
                    names=["id", "label", "x"],
                )

    # as many rows as labels where ids are unique; where they repeat, the first by id, label and features
    made = taught.mapInArrow(features, "id long, label int, x binary")
    got = made.orderBy("id", "label", "x").limit(2 * train_rows).collect()
    x = np.array([np.frombuffer(r["x"], "<f4") for r in got], np.float32).reshape(-1, POOLED)
    return QualityModel(vectors, train_network(x, np.array([r["label"] for r in got])))
