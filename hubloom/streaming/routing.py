"""Route deployment commands to their hub or to the rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from hubloom.operators.validation import validate_deployments
from hubloom.plans.create import BODY
from hubloom.sources.json_docs import decode
from hubloom.sources.commands import write_commands
from hubloom.streaming.sinks import Trigger, append_files, write_batches

ACCEPTED, REJECTED = "accepted", "rejected"


def once(messages: DataFrame, remember: str | None = None) -> DataFrame:
    """Each message of a stream once, however often the bus delivers it.

    A message is known by its hub and request id, or by its body where it has no id;
    the stream's state remembers those it has seen. With `remember`, such as `7 days`,
    only as long as that behind the newest arrival in the column `ts`; without, for good.
    """
    known = F.coalesce(F.col("request_id").cast("string"), F.concat(
        F.lit("body "), F.sha2(F.coalesce("body", F.lit("")), 256)))
    keyed = messages.withColumn("__message", F.struct("network_id", known.alias("id")))
    if remember:
        keyed = keyed.withWatermark("ts", remember).dropDuplicatesWithinWatermark(["__message"])
    else:
        keyed = keyed.dropDuplicates(["__message"])
    return keyed.drop("__message")


def route(messages: DataFrame) -> DataFrame:
    """Decode and validate `request_id, network_id, body`; the topic a message
    came on plays no part. `route` tells the sink."""
    records = decode(messages, BODY).select(
        "request_id", "network_id", F.col("status").alias("__status"),
        F.when(F.col("status") == 200, F.col("decoded.version")).alias("version"),
        F.when(F.col("status") == 200, F.col("decoded.deployment")).alias("deployment"))
    checked = validate_deployments(records)
    unreadable = F.col("__status") != 200
    reason = F.when(unreadable, F.lit("unreadable")).otherwise(F.col("reason"))
    return checked.select(
        "request_id", "network_id", reason.alias("reason"),
        F.when(reason.isNull(), F.to_json("deployment", {"ignoreNullFields": "false"})
               ).alias("deployment"),
        F.when(reason.isNull(), ACCEPTED).otherwise(REJECTED).alias("route"))


def accepted_commands(routed: DataFrame) -> DataFrame:
    """Accepted messages as rows of the command table."""
    return routed.where(F.col("route") == ACCEPTED).select(
        F.col("request_id").cast("string").alias("action_id"),
        F.col("network_id").cast("string").alias("network_id"),
        F.get_json_object("deployment", "$.id").alias("deployment_id"),
        F.col("deployment").alias("body"))


def route_commands_stream(messages: DataFrame, path: str, checkpoint: str,
                          commands: str | None = None, trigger: Trigger | None = None,
                          remember: str | None = None) -> StreamingQuery:
    """Accepted and rejected rows are folders of `path`; each message counts once.

    With `commands`, the path of a command table, each batch's accepted rows are
    its deploy commands under the run `route-<batch>` too.
    """
    messages = once(messages, remember)
    if commands is None:
        return append_files(route(messages), path, checkpoint, ("route",), trigger)

    def deploy(batch: DataFrame, batch_id: int) -> None:
        write_commands(accepted_commands(batch), commands, f"route-{batch_id}", "deploy")

    return write_batches(route(messages), path, checkpoint, also=deploy, trigger=trigger)
