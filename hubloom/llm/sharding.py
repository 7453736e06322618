"""Sharding by proportional stratified interleaving; the law is `rows`.

Rows of a source are shuffled by a seeded hash and ranked; a row's fraction is
(rank - offset) / (rows of its source). Sorted by fraction, every stretch of rows holds
each source in proportion, so cutting the order into equal stretches gives shards
that match the mixture, with row counts at most one apart.

Sources of one size would have equal fractions and lie next to each other. So they are
ranked by a seeded hash too, and their offsets are spread evenly over 0 to 1: m sources of
one row lie at (j - 1/2) / m, in between the rows of the others.

No rank needs a source, all sources of a size, or all rows in one task: rows are counted by
buckets of the hash (then by ranges of the whole order, so that equal fractions are split
too), the few counts are summed up in order, and rows are numbered within their bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hubloom.session import keep

SHARDS = 24
SEED = 17
#: Least buckets of hashes to a source, as hex digits, and rows of a bucket.
DIGITS, BUCKET_ROWS = 3, 250_000


def _numbered(rows: DataFrame, group: list[str], bucket: str, order: list[str | Column],
              name: str) -> DataFrame:
    """Adds each row's number in its group (from 1), and the group's count.

    Buckets are in the order that is asked for and fit a task.
    """
    counts = rows.groupBy(*group, bucket).agg(F.count("*").alias("__n"))
    by_group = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = by_group.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*(F.col(c).alias(f"__{c}") for c in (*group, bucket)),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                           F.sum("__n").over(by_group).alias(f"n_{name}"))
    inside = Window.partitionBy(*group, bucket).orderBy(*order)
    numbered = rows.withColumn("__row", F.row_number().over(inside))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*group, bucket)]
    met = same[0]
    for s in same[1:]:
        met = met & s
    return (numbered.join(counts, met)
            .withColumn(name, F.col("__before") + F.col("__row"))
            .drop("__row", "__before", *(f"__{c}" for c in (*group, bucket))))


def _ranges(rows: DataFrame) -> DataFrame:
    """Adds __part, the number of the range in the order that a row lies in.

    No two rows have one fraction and source, so any part of the order can be split.
    Written, as ranges are drawn from samples.
    """
    parted = rows.repartitionByRange(*_order()).withColumn("__part", F.spark_partition_id())
    return keep(rows.sparkSession, parted, "ranges")


def _digits(rows: int) -> int:
    """Hex digits of a hash that cut this many rows into buckets that fit a task."""
    digits = DIGITS
    while rows > BUCKET_ROWS * 16 ** digits:
        digits += 1
    return digits


def _offsets(ranked: DataFrame, seed: int) -> DataFrame:
    """of (a source), offset: sources of one size evenly spread, in a seeded order."""
    named = F.md5(F.concat(F.lit(f"{seed}:"), F.when(F.col("of").isNull(), F.lit("n")).otherwise(
        F.concat(F.lit("s"), F.col("of").cast("string")))).cast("binary"))
    sources = keep(ranked.sparkSession, ranked.where("rank = 1").select(
        F.col("source").alias("of"), F.col("n_rank").alias("size_of")).withColumn("name", named),
        "sources")
    sources = sources.withColumn("bucket", F.substring("name", 1, _digits(sources.count())))
    spread = _numbered(sources, ["size_of"], "bucket", ["name"], "nth")
    return spread.select("of", ((F.col("nth") - 0.5) / F.col("n_nth")).alias("offset"))


def _order() -> list[Column]:
    return [F.col("__fraction"), F.col("source").asc_nulls_first(), F.col("__draw")]


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, text_crc32, law, shard, slot, grown_shard for each row.

    Reads doc_id, source and text. size is the text's UTF-8 bytes (0 without a text)
    and 8; text_crc32 is that of no bytes for a null text. slot counts a shard's rows
    from 0. grown_shard is null: under this law more shards move most rows. A null
    source is a source of its own. Rows with one doc_id are told apart by their
    texts' hash and size; rows that are equal in all that take each other's places.
    An empty table gives an empty result.
    """
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("source"),
        (F.length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"))
    drawn = rows.withColumn("__draw", F.md5(F.concat_ws(
        ":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.col("text_crc32"), F.col("size")).cast("binary")))
    drawn = drawn.withColumn("__bucket", F.substring("__draw", 1, _digits(docs.count())))
    ranked = keep(docs.sparkSession, _numbered(
        drawn, ["source"], "__bucket", ["__draw"], "rank").drop("__bucket"), "ranked")
    fraction = (F.col("rank") - F.col("offset")) / F.col("n_rank")
    placed = ranked.join(_offsets(ranked, seed), F.col("source").eqNullSafe(F.col("of")))
    spread = _ranges(placed.withColumn("__fraction", fraction).drop(
        "rank", "n_rank", "of", "offset"))
    placed = _numbered(spread, [], "__part", _order(), "place")
    at = F.col("place") - 1
    # The shard s with s * n div shards <= place - 1 < (s + 1) * n div shards.
    shard = F.expr(f"(place * {shards} - 1) div n_place")
    return (placed.withColumn("shard", shard.cast("int"))
            .withColumn("slot", (at - _first(shards)).cast("long"))
            .select("doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"),
                    "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))


def _first(shards: int) -> Column:
    """The place, from 0, at which a shard starts."""
    return F.expr(f"(shard * n_place) div {shards}")
