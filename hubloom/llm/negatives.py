"""Hard negatives by a multiway hyperplane tree with distance ranges.

Scores are inner products of whole numbers. A number more, sqrt(R^2 - |x|^2), brings all
rows to the largest length R, and then a row's distance from an anchor follows from its
score alone: a window of scores is an annulus around the anchor, and the k best rows
are a ball that shrinks.

1. The tree's split points come from a sample of FITTED rows, those with the least hash.
   A node has up to FANOUT split points far from each other; a row goes to the nearest,
   the sides of hyperplanes. Every row is put into its leaf.
2. Each split point stores the least and largest distance to every sibling's subtree,
   over all rows. An annulus with radii r1 to r2 around an anchor at distance D from a
   split point meets only rows at max(D - r2, r1 - D) to D + r2 from it: a sibling whose
   stored range lies outside, for any split point, is eliminated.
3. Leaves are cut into pages of at most some PAGE rows by a hash, so a leaf of copies is many
   pages. Anchors are sent to the pages that are left, in groups. A page builds a tree of
   its own rows in the same way; leaves of that one are scored in full.

Positives are found twice: in an anchor's home leaf, whose kth score bounds the ball, and
then in all that the ball meets. Negatives are those in the annulus of each positive's
window. Nothing is collected but the sample and the ranges of the tree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hubloom.session import keep

SCALE = 256
#: Rows the tree is fitted on, its split points a node, depth, and sample rows a leaf.
FITTED, FANOUT, DEPTH, SAMPLED = 8192, 8, 3, 64
#: Rows of a page, queries it meets at once, rows of a leaf of its own tree.
PAGE, GROUP, LEAF = 8192, 4096, 256
#: Rows a node looks at to choose split points.
LOOKED_AT = 512
LEAST, MOST = -(2 ** 63) + 1, 2 ** 63 - 1

Arrow = Iterator[pa.RecordBatch]


class Tree:
    """Split points, and the ranges of distances from each to its siblings' rows.

    Points have one length, `radius`; node 0 is the root, a child below 0 is the leaf
    -1 - child.
    """

    def __init__(self, points: np.ndarray, radius: float, leaf: int, depth: int) -> None:
        self.radius = radius
        self.centers: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.n_leaves = 0
        self.root = self._grown(points, leaf, depth)
        self.low = [np.full((len(c), len(c)), np.inf) for c in self.centers]
        self.high = [np.full((len(c), len(c)), -np.inf) for c in self.centers]

    def _grown(self, points: np.ndarray, leaf: int, depth: int) -> int:
        centers = self._far_apart(points) if depth and len(points) > leaf else points[:0]
        if len(centers) < 2:
            self.n_leaves += 1
            return -self.n_leaves
        node = len(self.centers)
        self.centers.append(centers)
        self.children.append([])
        nearest = (points @ centers.T).argmax(axis=1)
        self.children[node] = [self._grown(points[nearest == j], leaf, depth - 1)
                               for j in range(len(centers))]
        return node

    def _far_apart(self, points: np.ndarray) -> np.ndarray:
        """Points each of which is farthest from those before it; none is repeated."""
        points = points[:: max(1, len(points) // LOOKED_AT)]
        chosen = [0]
        nearest = points @ points[0]
        while len(chosen) < FANOUT:
            i = int(nearest.argmin())
            if self._distances(nearest[i]) <= self.slack:
                break
            chosen.append(i)
            nearest = np.maximum(nearest, points @ points[i])
        return points[chosen]

    @property
    def slack(self) -> float:
        """More than a distance is off by rounding."""
        return 1e-6 * self.radius + 1e-9

    def _distances(self, products: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 * (self.radius ** 2 - products), 0))

    def leaves_of(self, points: np.ndarray, learn: bool = False) -> np.ndarray:
        """The leaf of each point; `learn` widens the ranges to hold them."""
        out = np.zeros(len(points), np.int64)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
                continue
            products = points[rows] @ self.centers[node].T
            nearest = products.argmax(axis=1)
            for j, child in enumerate(self.children[node]):
                there = nearest == j
                if there.any():
                    if learn:
                        far = self._distances(products[there])
                        np.minimum(self.low[node][:, j], far.min(axis=0),
                                   out=self.low[node][:, j])
                        np.maximum(self.high[node][:, j], far.max(axis=0),
                                   out=self.high[node][:, j])
                    todo.append((child, rows[there]))
        return out

    def met(self, queries: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which leaves may hold a row that scores from `least` to `most`, query by query.

        `queries` have a last component 0, so a row's distance is |q|^2 + R^2 - 2 score.
        """
        total = (queries * queries).sum(axis=1) + self.radius ** 2
        inner = np.sqrt(np.maximum(total - 2.0 * most, 0)) - self.slack
        outer = np.sqrt(np.maximum(total - 2.0 * least, 0)) + self.slack
        out = np.zeros((len(queries), self.n_leaves), bool)
        todo = [(self.root, np.arange(len(queries)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows, -1 - node] = True
                continue
            apart = np.sqrt(np.maximum(
                total[rows, None] - 2 * (queries[rows] @ self.centers[node].T), 0))
            near = np.maximum(apart - outer[rows, None], inner[rows, None] - apart) - self.slack
            far = apart + outer[rows, None] + self.slack
            for j, child in enumerate(self.children[node]):
                there = ((near <= self.high[node][:, j]) & (far >= self.low[node][:, j])).all(axis=1)
                if there.any():
                    todo.append((child, rows[there]))
        return out


def _matrix(vectors: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _raised(rows: np.ndarray, radius: float) -> np.ndarray:
    """Rows with the component that brings them to one length."""
    rows = rows.astype(np.float64)
    more = np.sqrt(np.maximum(radius ** 2 - (rows * rows).sum(axis=1), 0))
    return np.column_stack((rows, more))


def _flat(queries: np.ndarray) -> np.ndarray:
    return np.column_stack((queries.astype(np.float64), np.zeros(len(queries))))


class Best:
    """The k best rows of each query so far, by score, then by the smaller id."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.scores, self.ids = np.full((n, k), LEAST), np.full((n, k), MOST)

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of some queries by rows that are in the order of their ids."""
        first = np.argsort(-scores, axis=1, kind="stable")[:, :self.k]
        scores = np.concatenate((self.scores[queries],
                                 np.take_along_axis(scores, first, 1)), axis=1)
        ids = np.concatenate((self.ids[queries], ids[first]), axis=1)
        order = np.lexsort((ids, -scores), axis=1)[:, :self.k]
        self.scores[queries] = np.take_along_axis(scores, order, 1)
        self.ids[queries] = np.take_along_axis(ids, order, 1)


def _searched(width: int, radius: float, exact: bool, k: int) -> Callable:
    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        ids = rows.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        values = _matrix(rows.column("vector"), width)[order] if len(ids) else np.zeros((0, width))
        names, codes = np.unique(np.array(
            rows.column("label").to_pylist() + asked.column("label").to_pylist(), object).astype(
            str), return_inverse=True)
        labels, own_labels = codes[:len(ids)][order], codes[len(ids):]
        own = asked.column("anchor_id").to_numpy()
        same = asked.column("same").to_numpy(zero_copy_only=False)
        least, most = asked.column("least").to_numpy().copy(), asked.column("most").to_numpy()
        best = Best(len(own), k)
        if len(own) and len(ids):
            queries = _matrix(asked.column("vector"), width)
            points = _raised(values, radius)
            tree = Tree(points, radius, LEAF, DEPTH if exact else 0)
            leaf = tree.leaves_of(points, learn=True)
            flat = _flat(queries)
            numbers = (values.astype(np.float64), queries.astype(np.float64)) if exact else (
                values, queries)

            def score(leaf_no: int, some: np.ndarray) -> None:
                there = np.flatnonzero(leaf == leaf_no)
                scores = (numbers[1][some] @ numbers[0][there].T).astype(np.int64)
                good = ((labels[there] == own_labels[some, None]) == same[some, None])
                good &= (ids[there] != own[some, None]) & (scores >= least[some, None])
                good &= scores <= most[some, None]
                best.add(some, np.where(good, scores, LEAST), ids[there])

            home = tree.leaves_of(flat)
            for number in range(tree.n_leaves):
                some = np.flatnonzero(home == number)
                if len(some):
                    score(number, some)
            least = np.maximum(least, best.scores[:, -1])
            met = tree.met(flat, least, most) if exact else np.ones((len(own), 1), bool)
            met[np.arange(len(own)), home] = False
            for number in range(tree.n_leaves):
                some = np.flatnonzero(met[:, number])
                if len(some):
                    score(number, some)
        found, at = np.nonzero(best.scores > LEAST)
        return pa.table([own[found], asked.column("most").to_numpy()[found], best.ids[found, at],
                         best.scores[found, at]], ["anchor_id", "most", "vec_id", "score"])
    return run


def _put(tree, width: int) -> Callable[[Arrow], Arrow]:
    """Adds the leaf to rows."""
    def run(batches: Arrow) -> Arrow:
        for batch in batches:
            points = _raised(_matrix(batch.column("vector"), width), tree.value.radius)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tree.value.leaves_of(points).astype(np.int32))],
                [*batch.schema.names, "leaf"])
    return run


def _ranged(tree, width: int) -> Callable[[Arrow], Arrow]:
    """The ranges of a task's rows: node, split point, sibling, least, largest."""
    def run(batches: Arrow) -> Arrow:
        seen = tree.value
        for low, high in zip(seen.low, seen.high, strict=True):
            low[:], high[:] = np.inf, -np.inf
        for batch in batches:
            seen.leaves_of(_raised(_matrix(batch.column("vector"), width), seen.radius), learn=True)
        for node, (low, high) in enumerate(zip(seen.low, seen.high, strict=True)):
            i, j = np.nonzero(high >= low)
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), node, np.int32)), pa.array(i.astype(np.int32)),
                     pa.array(j.astype(np.int32)), pa.array(low[i, j]), pa.array(high[i, j])],
                    ["node", "point", "sibling", "low", "high"])
    return run


def _routed(tree, width: int, home: bool) -> Callable[[Arrow], Arrow]:
    """Adds the leaves a query has to look at."""
    def run(batches: Arrow) -> Arrow:
        for batch in batches:
            flat = _flat(_matrix(batch.column("vector"), width))
            if home:
                leaves = tree.value.leaves_of(flat).astype(np.int32)[:, None].tolist()
            else:
                met = tree.value.met(flat, *(batch.column(c).to_numpy() for c in ("least", "most")))
                leaves = [np.flatnonzero(m).tolist() for m in met]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaves, pa.list_(pa.int32()))],
                [*batch.schema.names, "leaves"])
    return run


def _finite(vector: Column) -> Column:
    return vector.isNotNull() & ~F.exists(
        vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
                   percent: int = 80, label: str = "label", vector: str = "embedding",
                   scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its first rows of the same label, by score, ties to the
    smaller vec_id. For each, the first rows of other labels follow whose score is at
    least `percent` hundredths of the positive's and not above it, ranked from 1. All, if
    there are fewer; no row, if there is none.

    Scores are inner products of floor(scale * x), with numbers beyond a long held to its
    range; scores beyond a long wrap, and no row is pruned where doubles would not be
    exact. A shorter vector counts as followed by zeros. Rows with a null vec_id, label or
    vector, or with null or non-finite components take no part. Rows that share a vec_id
    are each a candidate, though none for an anchor of that vec_id; as an anchor the least
    by label and vector is taken. Other columns take no part.
    """
    spark = vectors.sparkSession
    result = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
              "negative_score"]
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("asked"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull()
                      & _finite(F.col("vector")))
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * float(scale))))
    size = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    n, width, radius, most, n_asked = rows.agg(
        F.count("*"), F.max(F.size("vector")), F.max(size), F.max(largest),
        F.count_distinct(F.when(F.col("asked"), F.col("vec_id")))).first()
    width = max(width or 0, 1)
    exact = (most or 0.0) ** 2 * width < 2 ** 52
    radius = float(np.sqrt(radius or 0.0)) if exact else 1.0
    rows = rows.withColumn("vector", F.concat(
        "vector", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vector"))))

    sample = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id", "vector").limit(FITTED)
    points = np.array([r.vector for r in sample.select("vector").collect()], np.int64)
    points = _raised(points.reshape(-1, width), radius)
    tree = Tree(points, radius, SAMPLED, DEPTH if exact else 0)
    sent = spark.sparkContext.broadcast(tree)
    rows = keep(spark, rows.mapInArrow(
        _put(sent, width), "vec_id long, label string, vector array<long>, asked boolean, leaf int"),
        "leaves")
    # As many numbers as the tree has, which the sample bounds.
    for node, i, j, low, high in rows.select("vector").mapInArrow(
            _ranged(sent, width), "node int, point int, sibling int, low double, high double"
            ).groupBy("node", "point", "sibling").agg(F.min("low"), F.max("high")).collect():
        tree.low[node][i, j], tree.high[node][i, j] = low, high
    sent = spark.sparkContext.broadcast(tree)
    # A leaf of twice the mean size is cut, so that copies are no larger pages than others.
    page = min(PAGE, max(LEAF, 2 * n // tree.n_leaves))
    pages = rows.groupBy("leaf").agg(F.ceil(F.count("*") / page).cast("int").alias("n_pages"))
    pages = keep(spark, pages, "leaf-pages")
    paged = rows.join(F.broadcast(pages), "leaf").select(
        "leaf", F.pmod(F.xxhash64("vec_id", "vector"), F.col("n_pages")).cast("int").alias("page"),
        "vec_id", "label", "vector")

    def search(queries: DataFrame, n_queries: int, k: int, home: bool = False) -> DataFrame:
        """anchor_id, most, vec_id, score, rank: the k best rows of each query."""
        groups = max(1, -(-n_queries // GROUP))
        here = queries.mapInArrow(
            _routed(sent, width, home), "anchor_id long, label string, vector array<long>, "
            "same boolean, least long, most long, leaves array<int>")
        here = here.withColumn("leaf", F.explode("leaves")).drop("leaves").join(
            F.broadcast(pages), "leaf").withColumn(
            "page", F.explode(F.sequence(F.lit(0), F.col("n_pages") - 1))).drop("n_pages")
        here = here.withColumn("group", F.pmod(F.xxhash64("anchor_id", "most"),
                                               F.lit(groups)).cast("int"))
        there = paged.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        key = ["leaf", "page", "group"]
        found = there.groupBy(*key).cogroup(here.groupBy(*key)).applyInArrow(
            _searched(width, radius, exact, k),
            "anchor_id long, most long, vec_id long, score long")
        order = Window.partitionBy("anchor_id", "most").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    anchors = rows.where("asked").groupBy("vec_id").agg(
        F.min(F.struct("label", "vector")).alias("least")).select(
        F.col("vec_id").alias("anchor_id"), "least.label", "least.vector")
    balls = anchors.select("*", F.lit(True).alias("same"), F.lit(LEAST).alias("least"),
                           F.lit(MOST).alias("most"))
    near = search(balls, n_asked, positives, home=True).where(F.col("rank") == positives)
    near = near.select("anchor_id", F.col("score").alias("bound"))
    balls = balls.join(near, "anchor_id", "left").select(
        "anchor_id", "label", "vector", "same",
        F.coalesce("bound", F.lit(LEAST)).alias("least"), "most")
    first = keep(spark, search(balls, n_asked, positives).select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives")
    # A negative score's window is empty: its lower end lies above it.
    windows = first.where("positive_score >= 0").select(
        "anchor_id", F.col("positive_score").alias("most")).distinct()
    # The least score that is enough, without leaving the range of longs.
    exact_share = F.ceil(F.col("most").cast("decimal(38,0)") * percent / 100).cast("long")
    asked = anchors.join(windows, "anchor_id").select(
        "anchor_id", "label", "vector", F.lit(False).alias("same"),
        exact_share.alias("least"), "most")
    found = search(asked, n_asked * positives, negatives)
    return found.select(
        "anchor_id", F.col("most").alias("positive_score"), F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"), "rank").join(
        first, ["anchor_id", "positive_score"]).select(*result)
