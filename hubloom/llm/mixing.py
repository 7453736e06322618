"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells by source, language and topic. The cells' tokens are
raked: scaled in turn so that the sums over sources, languages and topics meet
their targets, until all three do, and no cell is asked for more than it has. A
cell's raked over its present tokens is the chance at which each of its documents
stays; the draw is a seeded hash of the document.

Tokens are words between white space, or a column that the caller names. The topic
is a column too, or else the register of the text, see `register`.

Every source, language and topic is a category of its own. Only cells that hold
documents are kept, as rows of a table that is read in one part for every CELLS_A_TASK
cells. Where it is one part, a task sums up over windows of it; of more, each dimension
takes an aggregate and a join. Sums are taken in decimals, which do not depend on the order
of rows, so both give the same to the last bit. Nothing but sums comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hubloom.llm.rows import Carried
from hubloom.session import delete, keep, shared_dir

SEED = 29
#: Most rounds, how many are done before their last one is looked at, and how little of all
#: tokens a cell may have moved by in that.
ROUNDS, AT_ONCE, CLOSE = 200, 4, 1e-7
#: Targets left open: present shares to this power, which evens them out.
EVENING = 0.8
#: Share of all tokens that is kept.
FRACTION = 0.8
DIMENSIONS = ("source", "lang", "topic")
#: Cells that a task rakes.
CELLS_A_TASK = 200_000

Targets = dict[str, dict[str, float]]


def word_count(text: str = "text") -> Column:
    """Words between ASCII white space; 0 for a null text."""
    words = F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def register(text: str = "text") -> Column:
    """A topic by the look of a text: license, table, contact, short or prose."""
    t = F.coalesce(F.col(text), F.lit(""))
    return (F.when(t.contains("icense"), "license").when(t.contains(" | "), "table")
            .when(t.contains("@"), "contact").when(F.length(t) < 500, "short")
            .otherwise("prose"))


EXACT = "decimal(38,9)"


def _goals(cells: DataFrame, dimension: str, targets: Targets, total: float, wanted: float
           ) -> DataFrame:
    """The tokens to keep of each category that has any, as goal_`dimension`; they sum up
    to `wanted`."""
    spark, named = cells.sparkSession, targets.get(dimension)
    present = cells.groupBy(dimension).agg(F.sum("tokens").alias("n")).where("n > 0")
    share = F.col("n") / total
    if named:
        given = spark.createDataFrame([(k, float(v)) for k, v in named.items()],
                                      f"{dimension} string, target double")
        shares = present.join(given, dimension, "left").select(
            dimension, F.coalesce("target", share).alias("share"))
    else:
        shares = present.select(dimension, F.pow(share, F.lit(EVENING)).alias("share"))
    shares = keep(spark, shares, "shares")
    whole = float(shares.agg(F.sum(F.col("share").cast("decimal(38,18)"))).first()[0] or 0)
    # Without any share wanted, the dimension is left as it is.
    goal = F.lit(wanted) * F.col("share") / whole if whole else F.lit(None).cast("double")
    return shares.select(dimension, goal.alias(f"goal_{dimension}"))


def _scaled(rows: DataFrame, dimension: str, parts: int) -> DataFrame:
    """Cells scaled so that sums over a dimension meet its goals, as far as cells have it."""
    fitted, tokens = F.col("fitted"), F.col("tokens").cast("double")
    if parts == 1:
        rows = rows.withColumn("now", F.sum(fitted.cast(EXACT)).over(
            Window.partitionBy(dimension)).cast("double"))
    else:
        rows = rows.join(rows.groupBy(dimension).agg(
            F.sum(fitted.cast(EXACT)).cast("double").alias("now")), dimension)
    goal = F.col(f"goal_{dimension}")
    factor = F.when(F.col("now") > 0, F.coalesce(goal, F.col("now")) / F.col("now")).otherwise(0.0)
    return rows.withColumn("fitted", F.least(fitted * factor, tokens)).drop("now")


def calibrated(cells: DataFrame, targets: Targets, fraction: float) -> DataFrame:
    """source, lang, topic and chance for each cell.

    `cells` has the three dimensions and tokens, no nulls. A dimension without
    targets gets present shares to the power EVENING. A category without a target
    in a dimension that has some keeps its present share. Targets that contradict each
    other, as empty cells can make them, end with the last scaling.
    """
    spark = cells.sparkSession
    total, n = cells.agg(F.sum("tokens"), F.count("*")).first()
    total, parts = float(total or 0), max(1, -(-n // CELLS_A_TASK))
    rows = cells.withColumns({c: F.col("tokens").cast("double") for c in ("fitted", "before")})
    for dimension in DIMENSIONS if total else ():
        rows = rows.join(_goals(cells, dimension, targets, total, fraction * total), dimension,
                         "left")
    # Columns in one order, whatever joins do to it.
    names, written = rows.columns, []

    def stored(frame: DataFrame) -> DataFrame:
        path = shared_dir(spark, "raked")
        frame.select(*names).write.parquet(path)
        if written:
            delete(spark, written.pop())
        written.append(path)
        return spark.read.schema(schema).parquet(path).coalesce(parts)
    schema = rows.schema
    rows = stored(rows)
    for done in range(0, ROUNDS if total else 0, AT_ONCE):
        for _ in range(min(AT_ONCE, ROUNDS - done)):
            rows = rows.withColumn("before", F.col("fitted"))
            for dimension in DIMENSIONS:
                rows = _scaled(rows, dimension, parts)
                rows = rows if parts == 1 else stored(rows)
        rows = stored(rows) if parts == 1 else rows
        if rows.agg(F.max(F.abs(F.col("fitted") - F.col("before")))).first()[0] <= CLOSE * total:
            break
    return rows.select(*DIMENSIONS, F.when(F.col("tokens") > 0, F.col("fitted") / F.col("tokens"))
                       .otherwise(1.0).alias("chance"))


def _drawn(docs: DataFrame, targets: Targets | None, fraction: float, tokens: Column | None,
           topic: Column | None, seed: int) -> tuple[Carried, DataFrame]:
    """The caller's rows with topic, tokens, chance, weight and kept."""
    spark, carried = docs.sparkSession, Carried(docs)
    draw = F.conv(F.substring(F.md5(F.concat_ws(
        ":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
        .cast("binary")), 1, 13), 16, 10).cast("double") / float(16 ** 13)
    named = lambda c: F.coalesce(c.cast("string"), F.lit("(none)"))
    rows = carried.rows(
        source=named(F.col("source")), lang=named(F.col("lang")),
        topic=named(topic if topic is not None else register()),
        tokens=tokens if tokens is not None else word_count(), draw=draw)
    cells = keep(spark, rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    # Cells are as uneven as their categories; adaptive execution sends them out whole where
    # they are few, and splits crowded ones where they are not.
    rows = rows.join(calibrated(cells, targets or {}, fraction), list(DIMENSIONS), "left").withColumn(
        "kept", F.col("draw") < F.col("chance"))
    return carried, rows.withColumn("weight", F.when(F.col("kept"), 1.0 / F.col("chance")))


def mixed(docs: DataFrame, targets: Targets | None = None, fraction: float = FRACTION,
          tokens: Column | None = None, topic: Column | None = None,
          seed: int = SEED) -> DataFrame:
    """`docs` with topic, tokens, chance, weight and kept.

    `fraction` is the share of all tokens to keep, as far as cells that are asked for
    more than they have allow. weight is 1 / chance for documents that stay. Reads
    doc_id, text, source and lang (null: a category of its own, "(none)"); columns with
    the names of the results, in any spelling, are replaced. A null text has no tokens;
    a cell without tokens stays whole. Equal rows share their draw. An empty table gives
    an empty result.
    """
    added = ("topic", "tokens", "chance", "weight", "kept")
    carried, rows = _drawn(docs, targets, fraction, tokens, topic, seed)
    return rows.select(*carried.columns(added), *added)


def sampled(docs: DataFrame, targets: Targets | None = None, fraction: float = FRACTION,
            tokens: Column | None = None, topic: Column | None = None,
            seed: int = SEED) -> DataFrame:
    """The rows of `docs` that the mixture keeps, as they are."""
    carried, rows = _drawn(docs, targets, fraction, tokens, topic, seed)
    return rows.where("kept").select(*carried.columns())
