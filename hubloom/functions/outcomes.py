"""Outcome of one call to a gateway."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FAILURE_FROM = 300


def is_failure(status: Column) -> Column:
    return status >= FAILURE_FROM


def outcome(status: Column, body: Column) -> Column:
    """`{failed, message}`: a status of 300 or more fails with the body as its
    message, and an empty body is still a failure."""
    failed = is_failure(status)
    return F.struct(
        failed.alias("failed"),
        F.when(failed, F.coalesce(body, F.lit(""))).alias("message"),
    )
