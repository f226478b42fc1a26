"""Exact top-k search by inner product, pruned by segment statistics from coarse to fine.

A vector is cut into segments; of each, the mean and the deviation are kept, at
several resolutions. For a segment of ``m`` components,

    sum (q - x)^2 >= m * ((mean q - mean x)^2 + (dev q - dev x)^2),

a lower bound of the distance, and with the vectors' lengths an upper bound of the
inner product: ``m * (mean q * mean x + dev q * dev x)``. Candidates whose bound
cannot reach the k-th best score so far are dropped at the coarsest resolution that
shows it; exact scores are computed for those that survive all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESOLUTIONS = (4, 16)  # segments, coarse to fine
QUERIES_A_BLOCK, CANDIDATES_A_BLOCK = 1024, 4096
_SEEDS = 64  # candidates scored first in a block, to have a k-th best score to prune with


def segment_statistics(v: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each vector's segments, weighted so that the product of two rows
    of statistics bounds the vectors' inner product from above."""
    parts = []
    for s in np.array_split(v, min(segments, v.shape[1]), axis=1):
        weight = np.sqrt(s.shape[1])
        parts += [weight * s.mean(axis=1), weight * s.std(axis=1)]
    return np.stack(parts, axis=1)


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of paired rows."""
    return np.einsum("ij,ij->i", q, x)


def search_block(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best candidates of each query within a block: query and candidate positions, and scores.

    ``q`` and ``x`` hold integers. Best is the higher score, then the smaller id; a
    candidate with the query's own id takes no part.
    """
    order = np.argsort(x_ids, kind="stable")  # then positions break ties as ids do
    x_ids, x = x_ids[order], x[order]
    qf, xf = q.astype(np.float64), x.astype(np.float64)
    slack = 1e-9 * np.linalg.norm(qf, axis=1)[:, None] * np.linalg.norm(xf, axis=1)[None, :] + 1e-6
    alive = q_ids[:, None] != x_ids[None, :]

    # a first k-th best score for each query, from the candidates whose coarse bounds are highest
    coarse = segment_statistics(qf, RESOLUTIONS[0]) @ segment_statistics(xf, RESOLUTIONS[0]).T
    coarse[~alive] = -np.inf
    first = min(_SEEDS, x.shape[0])
    seeds = np.argpartition(-coarse, first - 1, axis=1)[:, :first]
    rows = np.repeat(np.arange(len(q)), first)
    found = _scores(q[rows], x[seeds.ravel()]).reshape(len(q), first).astype(np.float64)
    found[~np.take_along_axis(alive, seeds, axis=1)] = -np.inf
    least = np.sort(found, axis=1)[:, max(0, first - k)] if first >= k else np.full(len(q), -np.inf)

    bound = coarse
    for n, segments in enumerate(RESOLUTIONS):
        if n:
            bound = segment_statistics(qf, segments) @ segment_statistics(xf, segments).T
        alive &= bound + slack >= least[:, None]
    out = []
    for at in range(0, len(q), 64):  # bounds the pairs that are compared in full at once
        i, j = np.nonzero(alive[at : at + 64])
        i += at
        score = _scores(q[i], x[j])
        best = np.lexsort((j, -score, i))
        i, j, score = i[best], j[best], score[best]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        top = rank < k
        out.append((i[top], order[j[top]], score[top]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def integer_components(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of every component, x as double; null if the vector is null, holds
    a null or non-finite component, or has no components."""
    wide = vector.cast("array<double>")
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(finite & (F.size(wide) > 0), F.transform(wide, lambda x: F.floor(F.lit(float(factor)) * x)))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best by integer inner product.

    ``vector_col`` holds arrays of integers; null vectors and null ids take no part.
    Candidates are every row but the query's own (rows that repeat its id are its
    own); ties go to the smaller id, and rows that repeat an id each count. Only
    vectors of the query's length are compared. Scores must fit a signed 64-bit
    integer. Fewer candidates than k give fewer rows; an empty table gives none.

    The query set meets all rows in blocks: both sides are hashed into blocks of
    bounded size, each pair of blocks is one group with k rows a query out of it, and
    the groups' results are ranked at the end. No threshold is taken from a sample,
    so results are exact whatever the data.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<long>").alias("v"), is_query.alias("q"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("q")).first()
    parts = {name: max(1, -(-n // size)) for name, n, size in (("x", sizes["n"], CANDIDATES_A_BLOCK), ("q", sizes["q"], QUERIES_A_BLOCK))}

    def blocks(part: DataFrame, own: str, is_query_side: bool) -> DataFrame:
        other = "q" if own == "x" else "x"
        # dealt by row, not by vector: equal vectors spread over all blocks
        block = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(parts[own])).cast("int")
        part = part.select("id", "v", F.size("v").alias("length"), block.alias(f"{own}_block"))
        part = part.withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.lit(parts[other] - 1))))
        return part.select("length", "q_block", "x_block", F.lit(is_query_side).alias("asks"), "id", "v")

    def search(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids = table.column("id").to_numpy()
        length = table.column("length")[0].as_py()
        v = table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, length)
        i, j, score = search_block(ids[asks], v[asks], ids[~asks], v[~asks], k) if asks.any() and (~asks).any() else ([], [], [])
        empty = np.zeros(0, np.int64)
        return pa.table(
            {
                "query_id": pa.array(ids[asks][i] if len(i) else empty, pa.int64()),
                "vec_id": pa.array(ids[~asks][j] if len(j) else empty, pa.int64()),
                "score": pa.array(score if len(i) else empty, pa.int64()),
            }
        )

    both = blocks(rows.filter("q"), "q", True).unionByName(blocks(rows, "x", False))
    found = both.groupBy("length", "q_block", "x_block").applyInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
