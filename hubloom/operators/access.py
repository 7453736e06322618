"""Access rights."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hubloom.operators.skew import hot_keys, key_counts, salted_join

EXECUTE = "x"
REF = ["user_id", "kind", "id"]


def grants(permissions: DataFrame, right: str = EXECUTE) -> DataFrame:
    """What users hold a right on, one row per reference."""
    return permissions.where((F.col("right") == right) & F.col("allowed")).select(*REF).distinct()


def check_access(refs: DataFrame, permissions: DataFrame, right: str = EXECUTE) -> DataFrame:
    """Whether each user may use each thing they refer to.

    One answer per distinct `(user_id, kind, id)`; a reference without a
    permission row is refused. Both sides come down to one row per reference
    before they meet, so a reference that very many rows share costs one row.
    """
    held = grants(permissions, right).withColumn("allowed", F.lit(True))
    return (refs.select(*REF).distinct().join(held, REF, "left")
            .select(*REF, F.coalesce("allowed", F.lit(False)).alias("allowed")))


def refused_requests(refs: DataFrame, permissions: DataFrame, request: str = "request_id",
                     right: str = EXECUTE) -> DataFrame:
    """Requests that refer to anything their user may not use, once each.

    References are nearly unique, so a crowd can only come from a user.
    """
    asked = refs.select(request, *REF)
    hot = hot_keys(key_counts(asked, ["user_id"]), ["user_id"])
    refused = salted_join(asked, grants(permissions, right), REF, "left_anti", hot=hot)
    return refused.select(request).distinct()
