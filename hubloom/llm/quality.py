"""Quality classifier: a sparse ensemble of rules over text statistics.

1. STATISTICS are counted on every whole text.
2. A forest of shallow trees is fitted on labelled rows; every path from a root to
   a node is a rule, a conjunction of comparisons.
3. A logistic model with lasso weights is fitted on the rules; most get none.
4. The rules that have weights are compiled into one Spark column expression.

Fitting takes at most FITTED labelled rows (those with the least hash of doc_id),
none of them held out. A document is held out if crc32(doc_id as text) mod 5 is 0.
Counting statistics and scoring read all documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log
from operator import eq

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hubloom.llm.rows import Carried
from hubloom.llm.texts import chunks
from hubloom.session import keep

FITTED = 20_000
TREES, DEPTH, LASSO, ROUNDS = 20, 3, 0.001, 60
ACCEPTED = 0.3

STATISTICS = (
    "words", "mean_word", "distinct_words", "top_word", "adjacent_repeats", "distinct_triples",
    "upper", "letters", "digits", "symbols", "sentence_marks", "bars", "wide", "lines",
    "mean_line", "distinct_lines", "ended_lines", "marked_words", "capital_words", "short_words")

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = b"0123456789"
_MARKS = b".,;:?'\"()-"
_SYMBOLS = bytes(b for b in range(33, 127) if b not in _LETTERS + _DIGITS + _MARKS)
_WIDE = bytes(range(128, 256))
_ENDS = (b".", b"!", b"?", b":", b'"')

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, is at most, bound), ...
Arrow = Iterator[pa.RecordBatch]


def statistics(text: bytes | None) -> list[float]:
    """STATISTICS of a text; all 0 for a null or empty one."""
    text = text or b""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(text)
    share = lambda kind: (size - len(text.translate(None, kind))) / size
    lines = [line for line in text.split(b"\n") if line.strip()]
    marked = sum(1 for w in words if w[-1] in _SYMBOLS)
    return [
        float(n), sum(map(len, words)) / n, len(set(words)) / n,
        max(Counter(words).values()) / n, sum(map(eq, words, words[1:])) / n,
        len(set(zip(words, words[1:], words[2:], strict=False))) / (n - 2) if n > 2 else 1.0,
        share(_UPPER), share(_LETTERS), share(_DIGITS), share(_SYMBOLS), share(_MARKS),
        share(b"|"), share(_WIDE), float(len(lines)), size / len(lines),
        len(set(lines)) / len(lines), sum(x.rstrip().endswith(_ENDS) for x in lines) / len(lines),
        marked / n, sum(w[:1].isupper() for w in words) / n, sum(len(w) < 3 for w in words) / n]


def _counted(batches: Arrow) -> Arrow:
    """The statistics in the place of the column `bytes`."""
    for batch in batches:
        others = [n for n in batch.schema.names if n != "bytes"]
        for part in chunks(batch, "bytes"):
            found = [statistics(t) for t in part.column("bytes").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in others), pa.array(found, pa.list_(pa.float64()))],
                [*others, "statistics"])


def with_statistics(rows: DataFrame) -> DataFrame:
    """`rows` with the array `statistics` in the place of the column `bytes`."""
    fields = [f for f in rows.schema.fields if f.name != "bytes"]
    added = T.StructField("statistics", T.ArrayType(T.DoubleType()))
    return rows.mapInArrow(_counted, T.StructType([*fields, added]))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept for testing; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _bytes() -> Column:
    return F.col("text").cast("binary")


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and labels of at most FITTED labelled documents, written once.

    A doc_id with several labels takes the least.
    """
    chosen = (labels.where("quality is not null and doc_id is not null")
              .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.min("quality").cast("double").alias("label"))
              .where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FITTED))
    # FITTED rows of two numbers at most.
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), _bytes().alias("bytes"))
            .join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "bytes"))
    counted = with_statistics(rows).dropDuplicates(["doc_id"])
    return keep(docs.sparkSession, counted, "fitted")


def rules_of(tree: str) -> Iterator[Rule]:
    """The paths from the root to each other node of a tree's description."""
    path: list[tuple[int, bool, float]] = []
    for line in tree.splitlines():
        if m := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            depth = len(m[1]) // 1
            path = [c for c in path if c[0] < depth] + [
                (depth, int(m[2]), m[3] == "<=", float(m[4]))]
            yield merged([c[1:] for c in path])


def merged(conditions: list[tuple[int, bool, float]]) -> Rule:
    """The tightest bound for each statistic and side."""
    bounds: dict[tuple[int, bool], float] = {}
    for statistic, at_most, bound in conditions:
        old = bounds.get((statistic, at_most), bound)
        bounds[statistic, at_most] = min(old, bound) if at_most else max(old, bound)
    return tuple(sorted((s, m, b) for (s, m), b in bounds.items()))


def compiled(rule: Rule) -> Column:
    """Whether a rule holds for the array statistics."""
    value = lambda i: F.col("statistics")[i]
    out = F.lit(True)
    for statistic, at_most, bound in rule:
        out = out & (value(statistic) <= bound if at_most else value(statistic) > bound)
    return out


class RuleEnsemble:
    """Rules with their weights; a constant without both labels, or without any rule."""

    def __init__(self, weights: dict[Rule, float], intercept: float) -> None:
        self.weights, self.intercept = weights, intercept

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame) -> RuleEnsemble:
        """Fits on a sample; what it reads is at most FITTED rows, in one order."""
        rows = _sample(docs, labels).coalesce(1).sortWithinPartitions("doc_id")
        counts = dict(rows.groupBy("label").count().collect())
        if len(counts) < 2:
            return cls({}, {0.0: -4.0, 1.0: 4.0}.get(next(iter(counts), None), 0.0))
        data = rows.select("label", "statistics",
                           array_to_vector("statistics").alias("features")).cache()
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7,
                                        minInstancesPerNode=5).fit(data)
        rules = sorted({r for t in forest.trees for r in rules_of(t.toDebugString)})
        if not rules:
            # Texts that no statistic tells apart: the share of good ones among them.
            data.unpersist()
            return cls({}, log(counts[1.0] / counts[0.0]))
        held = F.array(*(compiled(r).cast("double") for r in rules))
        met = data.select("label", array_to_vector(held).alias("features")).cache()
        model = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=ROUNDS,
                                   standardization=False).fit(met)
        met.unpersist(), data.unpersist()
        weights = {r: float(w) for r, w in zip(rules, model.coefficients, strict=True) if w}
        return cls(weights, float(model.intercept))

    def score(self) -> Column:
        """Probability of a good label, from the array statistics."""
        logit = F.lit(self.intercept)
        for rule, weight in self.weights.items():
            logit = logit + F.when(compiled(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def _scores(docs: DataFrame, labels: DataFrame) -> tuple[Carried, DataFrame]:
    """The caller's rows with held_out, score and predicted."""
    ensemble = RuleEnsemble.fit(docs, labels)
    carried = Carried(docs)
    rows = with_statistics(carried.rows(held_out=held_out(), bytes=_bytes()))
    rows = rows.select("row", "held_out", ensemble.score().alias("score"))
    return carried, rows.withColumn("predicted", (F.col("score") >= ACCEPTED).cast("int"))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` with held_out, score (0 to 1) and predicted (1 from ACCEPTED on).

    Reads doc_id and text, and labels.doc_id and labels.quality; columns with the
    names of the results, in any spelling, are replaced. Null and empty texts have
    statistics of 0 and get a score as well. Without labelled rows every score is one
    half; without both labels it follows the one there is; where no rule tells the
    labelled texts apart it is the share of good ones.
    """
    added = ("held_out", "score", "predicted")
    carried, rows = _scores(docs, labels)
    return rows.select(*carried.columns(added), *added)


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are predicted to be good, as they are."""
    carried, rows = _scores(docs, labels)
    return rows.where("predicted = 1").select(*carried.columns())
