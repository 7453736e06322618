"""Exact top-k search by block-at-a-time pruning.

Vectors are turned into integers, floor(1024 * x) for each component, and scored by
their inner product. The components are the terms: a block of BLOCK vectors keeps
the largest and the least value of each. For a query these sum up to a bound on any
score in the block. Blocks are taken in the order of their bounds, their vectors
scored through the block's rows (the forward index), until the bounds fall below
the kth score so far. Bounds equal to it are still scored, as ties go to the
smaller id. So results are exact.

Vectors are dealt to segments of some SEGMENT rows and queries to groups of some GROUP,
both by hashes, so that copies are dealt like other rows. Each pair of a segment and a group
is one task's work: it puts similar vectors together, cuts blocks, and gives each query's k
best. The best of these are the result. Neither queries nor vectors are ever in one
place, and nothing but counts comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
BLOCK, SEGMENT, PIVOTS = 64, 4_096, 64
#: Queries of a group.
GROUP = 4_096
#: Blocks scored at once.
STEP = 4

def whole(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Integer components, as doubles where these are exact; short vectors end in 0."""
    out = np.zeros((len(vectors), width))
    flat = vectors.combine_chunks()
    lengths = flat.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, np.arange(len(rows)) - starts] = flat.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * out)


def _product(rows: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as longs; sums that doubles can't hold are taken in longs."""
    if exact:
        return (rows @ query).astype(np.int64)
    return rows.astype(np.int64) @ query.astype(np.int64)


class Segment:
    """Vectors in blocks, with the bounds of each block's components."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        pivots = rows[:: max(1, len(rows) // PIVOTS)][:PIVOTS]
        nearest = (rows @ pivots.T - (pivots * pivots).sum(axis=1) / 2).argmax(axis=1)
        order = np.argsort(nearest, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.cuts = np.arange(0, len(ids), BLOCK)
        self.most = np.maximum.reduceat(self.rows, self.cuts, axis=0)
        self.least = np.minimum.reduceat(self.rows, self.cuts, axis=0)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No score of a query in a block is above this."""
        return (np.maximum(queries, 0) @ self.most.T
                + np.minimum(queries, 0) @ self.least.T)

    def search(self, own: int, query: np.ndarray, bounds: np.ndarray, exact: bool,
               best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of `best` (scores, ids) and this segment, in order."""
        scores, ids = best
        order = np.argsort(-bounds, kind="stable")
        # Beyond exact doubles a bound may be off in its last digits.
        slack = 0.0 if exact else np.abs(bounds).max(initial=0.0) * 1e-9 + 1.0
        for i in range(0, len(order), STEP):
            blocks = order[i:i + STEP]
            full = len(scores) >= k
            if full and bounds[blocks[0]] + slack < scores[-1]:
                break
            at = (self.cuts[blocks][:, None] + np.arange(BLOCK)).ravel()
            at = at[at < len(self.ids)]
            found = _product(self.rows[at], query, exact)
            there = self.ids[at]
            good = there != own
            if full:
                good &= found >= scores[-1]
            if good.any():
                scores = np.concatenate((scores, found[good]))
                ids = np.concatenate((ids, there[good]))
                first = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[first], ids[first]
        return scores, ids


def _searched(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The k best rows of a segment for each query of a group."""
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        own = queries.column("query_id").to_numpy()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        if len(rows) and len(own):
            width = max(1, *(int(max(t.column("vector").combine_chunks().value_lengths()
                                     .to_numpy(zero_copy_only=False))) for t in (rows, queries)))
            segment = Segment(rows.column("vec_id").to_numpy(),
                              whole(rows.column("vector"), width))
            asked = whole(queries.column("vector"), width)
            exact = float(np.abs(asked).max()) * max(
                float(np.abs(segment.rows).max()), 1.0) * width < 2.0 ** 53
            none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
            bounds = segment.bounds(asked)
            found = [segment.search(own[i], query, bounds[i], exact, none, k)
                     for i, query in enumerate(asked)]
        sizes = [len(ids) for _, ids in found]
        both = [np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in (1, 0)]
        return pa.table([np.repeat(own[:len(sizes)], sizes), *both],
                        ["query_id", "vec_id", "score"])
    return run


def _finite(vector: str) -> Column:
    x = F.col(vector)
    return x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v)
                                     | (F.abs(v) == float("inf")))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10,
          vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest scores.

    Candidates are all rows but those with the query's vec_id; ties go to the
    smaller vec_id. All candidates, if fewer than k. Rows with a null vec_id, and
    vectors that are null or hold null or non-finite components, take no part. A
    shorter vector counts as followed by zeros. Rows that share a vec_id are each a
    candidate; as a query the least of them is taken. Scores beyond a long wrap.
    Without queries or candidates the result is empty.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asked"))
    rows = rows.where(F.col("vec_id").isNotNull() & _finite("vector"))
    asked = rows.where("asked").groupBy(F.col("vec_id").alias("query_id")).agg(
        F.min("vector").alias("vector"))
    n, n_asked = rows.agg(F.count("*"), F.count_distinct(F.when(F.col("asked"), F.col("vec_id")))
                          ).first()
    segments, groups = max(1, -(-n // SEGMENT)), max(1, -(-n_asked // GROUP))

    def dealt(frame: DataFrame, own: str, count: int, of: Column, other: str, times: int
              ) -> DataFrame:
        """Rows with their own part by a hash, once for each part of the other side."""
        part = F.pmod(F.xxhash64(of, "vector"), F.lit(count)).cast("int")
        return frame.withColumn(own, part).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    key = ["segment", "group"]
    there = dealt(rows.select("vec_id", "vector"), "segment", segments, F.col("vec_id"),
                  "group", groups)
    here = dealt(asked, "group", groups, F.col("query_id"), "segment", segments)
    found = there.groupBy(*key).cogroup(here.groupBy(*key)).applyInArrow(
        _searched(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
