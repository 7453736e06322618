"""Results of actions from outcomes as they arrive, in any order.

What counts for an action is its first failure by `seq`. Each action has a state: how
many outcomes it has had and its first failure, by windows of the time of arrival as long as
an action may be quiet. An outcome behind the failure changes nothing but the number; one
before it takes its place. The state of a window goes once batches have arrived after its
end. What is written is the state of the windows that a batch changed; the newest row of each
window counts, and the windows of an action add up, so an outcome that comes after the closing
is not lost. An action of which nothing has arrived for long is closed, and if nothing failed it
has succeeded. All this runs on the time of arrival, as a watermark on the time of the outcomes
would drop those that come late. States are aggregates, so rows of one action are combined
before the shuffle and a batch costs no call per action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from hubloom.operators.commands import classify_outcomes
from hubloom.operators.skew import hot_keys, key_counts, salted_join
from hubloom.streaming.sinks import Trigger, read_batches, write_batches

QUIET = "10 minutes"
FOUND = ("since timestamp, n long, failed_seq long, status int, message string, "
         "arrived timestamp, open_until timestamp")


def action_results_stream(outcomes: DataFrame, action: list[str], path: str, checkpoint: str,
                          quiet: str = QUIET, trigger: Trigger | None = None) -> StreamingQuery:
    """Write what each batch changes of actions, from `seq, status, body` and `action`.

    An action is closed once batches go on for `quiet` after its last outcome.
    """
    failure = F.struct(F.col("seq").cast("long").alias("seq"),
                       F.col("status").cast("int").alias("status"), "message")
    # The time of the batch; nothing is late by it.
    rows = classify_outcomes(outcomes).select(
        *action, F.when(F.col("failed") & F.col("seq").isNotNull(), failure).alias("__failure"),
        F.current_timestamp().alias("__arrived")).withWatermark("__arrived", "0 seconds")
    found = rows.groupBy(*action, F.window("__arrived", quiet).alias("__window")).agg(
        F.count(F.lit(1)).alias("n"), F.min("__failure").alias("__first"),
        F.max("__arrived").alias("arrived"))
    return write_batches(found.select(
        *action, F.col("__window.start").alias("since"), "n",
        F.col("__first.seq").alias("failed_seq"), F.col("__first.status").alias("status"),
        F.col("__first.message").alias("message"), "arrived",
        (F.col("arrived") + F.expr(f"interval {quiet}")).alias("open_until")),
        path, checkpoint, "update", trigger=trigger)


def read_action_results(spark: SparkSession, path: str, action: StructType) -> DataFrame:
    """Result of each action so far: `n_commands`, `failed_seq`, and its first failure's
    `status` and `message`; status 200 once it is closed without one, null before."""
    schema = StructType([*action.fields, *spark.createDataFrame([], FOUND).schema.fields])
    written = read_batches(spark, path, schema)
    failure = F.when(F.col("failed_seq").isNotNull(), F.struct("failed_seq", "status", "message"))
    # Numbers of a window only grow, so the newest is the largest.
    windows = written.groupBy(*action.names, "since").agg(
        F.max("n").alias("n"), F.min(failure).alias("first"),
        F.max("open_until").alias("open_until"))
    closed = F.col("open_until") < written.agg(F.max("arrived")).scalar()
    return windows.groupBy(*action.names).agg(
        F.sum("n").alias("n_commands"), F.min("first").alias("first"),
        F.max("open_until").alias("open_until")).select(
        *action.names, "n_commands", F.col("first.failed_seq").alias("failed_seq"),
        F.coalesce("first.status", F.when(closed, 200)).alias("status"),
        F.col("first.message").alias("message"))


def attempted(outcomes: DataFrame, results: DataFrame, action: list[str]) -> DataFrame:
    """Adds `attempted` to the outcomes: those up to their action's first failure were."""
    failed = results.where(F.col("failed_seq").isNotNull()).select(*action, "failed_seq")
    joined = salted_join(outcomes, failed, action, "left", [*action, "seq"],
                         hot_keys(key_counts(outcomes, action), action))
    return joined.withColumn("attempted", F.col("failed_seq").isNull() | (
        F.col("seq") <= F.col("failed_seq"))).drop("failed_seq")
