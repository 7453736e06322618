"""Joins and lists that stay spread when one key holds a large share of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from hubloom.session import keep

# Tasks a hot key of the left side is spread over before adaptive skew
# splitting divides it further: for every key, and for known hot keys.
SALTS = 8
HOT_SALTS = 64

# A key is hot when it holds more than one row in this many. There can only be
# fewer hot keys than this number, so a list of them is safe to broadcast.
HOT_SHARE = 1000


def key_counts(rows: DataFrame, on: list[str]) -> DataFrame:
    """Rows per key as `n_rows`."""
    return rows.groupBy(*on).agg(F.count(F.lit(1)).alias("n_rows"))


def hot_keys(counts: DataFrame, on: list[str]) -> DataFrame:
    """The hot ones among counted keys: fewer than `HOT_SHARE` rows.

    Both sides of a join look at them, so they are kept as a small table and
    the counting is done once.
    """
    total = counts.agg(F.sum("n_rows")).scalar()
    hot = counts.where(F.col("n_rows") * HOT_SHARE > total).select(*on)
    return keep(counts.sparkSession, hot, "hot-keys")


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner",
                spread_by: list[str] | None = None, hot: DataFrame | None = None) -> DataFrame:
    """Join rows that may crowd on few keys to a narrow per-key summary.

    Left rows get a salt from their own values, so a retried task gives the
    same one, and the right side is repeated once per salt. A plain join on
    `on` would reuse the partitioning of an aggregated right side, and then
    adaptive execution cannot split the hot partition; the salt in the key
    makes both sides plain shuffles, which it can.

    With `hot`, found by `hot_keys` for the key or some of its columns, only those
    are salted and repeated. Give it where the right side is not much smaller than
    the left.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a repeated right side cannot serve a {how} join")
    value = F.xxhash64(*(spread_by or left.columns))
    if hot is None:
        left = left.withColumn("__salt", F.pmod(value, F.lit(SALTS)).cast("int"))
        salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    else:
        marked = list(hot.columns)
        marks = F.broadcast(hot.select(*marked, F.lit(True).alias("__hot")))
        no_key = reduce(Column.__or__, (F.col(c).isNull() for c in on))
        left = left.join(marks, marked, "left").withColumn("__salt", F.when(
            F.col("__hot").isNotNull() | no_key, F.pmod(value, F.lit(HOT_SALTS)).cast("int"),
        ).otherwise(F.lit(0))).drop("__hot")
        right = right.join(marks, marked, "left")
        salts = F.when(F.col("__hot").isNotNull(), F.sequence(
            F.lit(0), F.lit(HOT_SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.withColumn("__salt", F.explode(salts)).drop("__hot")
    return left.join(repeated, [*on, "__salt"], how).drop("__salt")


def _crowded_parts(rows: DataFrame, keys: list[str], member: str, part_size: int) -> DataFrame:
    """Adds `part`, the rank of `member` within its key divided by the part size.

    Rows are dealt out by ranges of key and member, so a crowded key covers many
    partitions, each a stretch of it. Their few counts, summed up, number the rows.
    """
    spread = keep(rows.sparkSession, rows.repartitionByRange(
        *keys, member).withColumn("__range", F.spark_partition_id()), "crowded")
    counts = spread.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    inside = Window.partitionBy(*keys, "__range").orderBy(member)
    row = F.row_number().over(inside)
    return (spread.withColumn("__row", row).join(counts, [*keys, "__range"])
            .withColumn("part", F.expr(f"cast((__before + __row - 1) div {part_size} as int)"))
            .drop("__range", "__row", "__before", "__n"))


def list_parts(rows: DataFrame, keys: list[str], member: str, item: Column, name: str,
               part_size: int, sizes: DataFrame | None = None) -> DataFrame:
    """Collect the items of each key into sorted lists of at most `part_size`.

    A key with at most `part_size` rows gives one row (`part` 0 of `n_parts`
    1). A larger one is cut in the order of the column `member`, which is unique
    within the key and leads the items' order, so no list and no task has to hold
    a whole hot key, and the parts in order are the list. `sizes`, rows per key as
    `n_rows`, saves counting them.
    """
    counts = key_counts(rows, keys) if sizes is None else sizes
    large = keep(rows.sparkSession, counts.where(F.col("n_rows") > part_size).select(
        *keys, F.ceil(F.col("n_rows") / part_size).cast("int").alias("n_parts")), "crowded-keys")

    def listed(numbered: DataFrame) -> DataFrame:
        return numbered.groupBy(*keys, "part", "n_parts").agg(
            F.sort_array(F.collect_list(item)).alias(name))

    if large.isEmpty():
        return listed(rows.withColumns({"part": F.lit(0), "n_parts": F.lit(1)}))
    marked = salted_join(rows, large, keys, "left")
    plain = marked.where(F.col("n_parts").isNull()).withColumns(
        {"part": F.lit(0), "n_parts": F.lit(1)})
    crowded = _crowded_parts(marked.where(F.col("n_parts").isNotNull()), keys, member, part_size)
    return listed(plain).unionByName(listed(crowded))
