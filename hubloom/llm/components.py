"""Connected components of an edge table, by stars that grow and shrink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubloom.session import keep


def _with_least(edges: DataFrame) -> DataFrame:
    """u, v and the least of u and its neighbours in these directed edges."""
    least = edges.groupBy("u").agg(F.min("v").alias("least")).select(
        F.col("u").alias("of"), F.least("u", "least").alias("least"))
    return edges.join(least, F.col("u") == F.col("of")).select("u", "v", "least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour is linked to the least of the neighbourhood."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"),
                                                        F.col("u").alias("v")))
    return (_with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
            .where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _with_least(down)
    return (starred.select(F.explode(F.array(F.struct("u", F.col("least").alias("v")),
                                             F.struct(F.col("v").alias("u"),
                                                      F.col("least").alias("v")))).alias("e"))
            .select("e.*").where("u != v").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
                 .first())


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node reachable) for every node of `edges` but roots.

    `edges` has two columns, u and v, of one ordered type. Minima are combined
    before each shuffle, so a node with many neighbours needs no single task.
    Each round is written to the shared folder; rounds grow with the logarithm
    of the longest chain.
    """
    spark = edges.sparkSession
    edges = keep(spark, edges.where("u != v").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = keep(spark, _small_star(_large_star(edges)), "stars")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
