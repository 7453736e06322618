"""Start and remove: one action, many commands, the first failure decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hubloom.functions import command_key
from hubloom.operators.commands import action_results, fan_out_commands

ACTION = ["action_id"]


def action_commands(actions: DataFrame, metadata: DataFrame, action: str,
                    inputs: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Commands of start or remove actions with their canonical key, and the
    actions that send nothing."""
    commands, no_ops = fan_out_commands(actions, metadata)
    keyed = commands.withColumn("command_key", command_key(
        F.lit(action), F.col("network_id"), F.col("engine_id"), inputs))
    return keyed, no_ops


def action_report(commands: DataFrame, no_ops: DataFrame, answers: DataFrame) -> DataFrame:
    """Result of every action from the answers (`network_id, engine_id, status,
    body`) so far; actions without commands succeed with none sent."""
    outcomes = commands.join(
        answers.select("network_id", "engine_id", "status", "body"),
        ["network_id", "engine_id"], "left")
    done = action_results(outcomes, ACTION)
    idle = no_ops.select(*ACTION, F.lit(0).cast("bigint").alias("n_commands"), "status",
                         F.lit(None).cast("string").alias("message"))
    return done.unionByName(idle)
