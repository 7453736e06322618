"""Commands to gateways, what came of them, and wanted against synced state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hubloom.functions import is_failure, outcome
from hubloom.operators.skew import hot_keys, key_counts, salted_join
from hubloom.operators.sync import latest_sync

TARGET = ["network_id", "deployment_id"]


def fan_out_commands(actions: DataFrame, metadata: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One command per engine deployment an action's deployment has on its network.

    `metadata` may report an engine deployment more than once; its newest report
    counts. Returns `(commands, no_ops)`. An action without metadata rows sends nothing
    and succeeds. Both inputs of the join are plain rows, so adaptive execution
    can split either side of a crowded deployment.
    """
    known = latest_sync(metadata).select(*TARGET, "engine_id", "seq")
    commands = actions.join(known, TARGET)
    no_ops = actions.join(known.select(*TARGET).distinct(), TARGET, "left_anti")
    return commands, no_ops.withColumn("status", F.lit(200))


def classify_outcomes(outcomes: DataFrame) -> DataFrame:
    """Add `failed` and `message` to rows with `status` and `body`."""
    return (outcomes.withColumn("__outcome", outcome(F.col("status"), F.col("body")))
            .select(*outcomes.columns, "__outcome.failed", "__outcome.message"))


def fail_fast_prefix(outcomes: DataFrame, action: list[str]) -> DataFrame:
    """Add `attempted`: the commands of an action run in `seq` order and stop
    behind the first failure.

    The first failure is an aggregate, not a window, so an action with very
    many commands is not sorted in one task.
    """
    first = (outcomes.where(is_failure(F.col("status")))
             .groupBy(*action).agg(F.min("seq").alias("failed_seq")))
    hot = hot_keys(key_counts(outcomes, action), action)
    joined = salted_join(outcomes, first, action, "left", [*action, "seq"], hot)
    attempted = F.col("failed_seq").isNull() | (F.col("seq") <= F.col("failed_seq"))
    return joined.withColumn("attempted", attempted).drop("failed_seq")


def action_results(outcomes: DataFrame, action: list[str]) -> DataFrame:
    """Result of each action: its first failure, 200 once all its commands have
    succeeded, or null while some have no status yet."""
    failed = classify_outcomes(outcomes)
    failure = F.when(F.col("failed"), F.struct("seq", "status", "message"))
    return (failed.groupBy(*action)
            .agg(F.min(failure).alias("first"), F.count(F.lit(1)).alias("n_commands"),
                 F.count("status").alias("n_answered"))
            .select(*action, "n_commands",
                    F.coalesce("first.status", F.when(
                        F.col("n_answered") == F.col("n_commands"), 200)).alias("status"),
                    F.col("first.message").alias("message")))


def reconcile(wanted: DataFrame, synced: DataFrame) -> DataFrame:
    """State of every deployment that is wanted or synced.

    `synced` may hold many rows per deployment; the newest one by `sync_date`
    and `seq` counts. Both sides go through one aggregation, combined before
    its shuffle, in place of a full outer join that could not be split.
    """
    blank = F.lit(None)
    both = wanted.select(
        *TARGET, F.lit(True).alias("wanted"),
        blank.cast("boolean").alias("is_placeholder"),
        blank.cast("boolean").alias("marked_for_delete"),
        blank.cast(synced.schema["sync_date"].dataType).alias("sync_date"),
        blank.cast(synced.schema["seq"].dataType).alias("seq"),
    ).unionByName(synced.select(
        *TARGET, F.lit(False).alias("wanted"), "is_placeholder",
        "marked_for_delete", "sync_date", "seq"))
    newest = F.when(~F.col("wanted"), F.struct(
        "sync_date", "seq", "is_placeholder", "marked_for_delete"))
    state = both.groupBy(*TARGET).agg(F.max("wanted").alias("wanted"),
                                      F.max(newest).alias("newest"))
    return state.select(*TARGET, F.when(F.col("newest").isNull(), "missing")
                        .when(F.col("newest.marked_for_delete"), "deleting")
                        .when(F.col("newest.is_placeholder"), "placeholder")
                        .when(F.col("wanted"), "in_sync")
                        .otherwise("unexpected").alias("state"))


def reconcile_in_time(sent: DataFrame, synced: DataFrame, now: Column, allowed: str
                      ) -> DataFrame:
    """Whether each command's deployment was synced within the time it is allowed.

    `sent` has `sent_at` for each command to a deployment, `synced` reports with
    `sync_date`. The first live report at or after the command, neither a placeholder nor
    marked for delete, is its answer: `synced_at`. The state is `in_sync` within
    `allowed` (an interval such as `2 seconds`), `late` behind it, and without an answer
    `waiting` until it has passed by `now`, then `late`.

    Both sides lie in one order of time, so a command meets its answer without pairs. A
    deployment is cut by days: the answer is in the day of the command, or the first one of
    a later day, and of a day only the first report is looked at by others.
    """
    blank = F.lit(None)
    live = synced.where(~F.col("is_placeholder") & ~F.col("marked_for_delete"))
    kind = synced.schema["sync_date"].dataType
    both = sent.select(
        *TARGET, F.col("sent_at").cast(kind).alias("at"), blank.cast(kind).alias("answer"),
        F.lit(0).alias("rank")).unionByName(live.select(
            *TARGET, F.col("sync_date").alias("at"), F.col("sync_date").alias("answer"),
            F.lit(1).alias("rank"))).withColumn("day", F.to_date("at"))
    later = Window.partitionBy(*TARGET).orderBy("day").rowsBetween(1, Window.unboundedFollowing)
    days = both.groupBy(*TARGET, "day").agg(F.min("answer").alias("first")).select(
        *(F.col(c).alias(f"of_{c}") for c in (*TARGET, "day")),
        F.first("first", ignorenulls=True).over(later).alias("next"))
    same_day = Window.partitionBy(*TARGET, "day").orderBy("at", "rank").rowsBetween(
        0, Window.unboundedFollowing)
    found = both.withColumn("answer", F.first("answer", ignorenulls=True).over(same_day)).where(
        F.col("rank") == 0).drop("rank")
    met = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in (*TARGET, "day")]
    rows = found.join(days, met[0] & met[1] & met[2], "left").select(
        *TARGET, F.col("at").alias("sent_at"), F.coalesce("answer", "next").alias("synced_at"))
    due = F.col("sent_at") + F.expr(f"interval {allowed}")
    return rows.withColumn("state", F.when(F.col("synced_at") <= due, "in_sync").when(
        F.col("synced_at").isNotNull() | (now > due), "late").otherwise("waiting"))
