"""Checks a deployment passes before it is sent to its hub."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CURRENT_VERSION = 3

# The message of each refusal.
REASONS = {
    "none": "expect deployment in ProducerReplacement.Produce()",
    "version": "unexpected deployment version",
    "message": "fog process deployments dont support message events. "
               "please use conditional events",
    "import": "fog process deployments dont support imports as selection "
              "for conditional events",
    "imports": "imports not supported for fog processes",
}


def reason_text(code: Column) -> Column:
    """Message of a refusal code, null for an accepted row."""
    text = F.lit(None).cast("string")
    for name, message in REASONS.items():
        text = F.when(code == name, F.lit(message)).otherwise(text)
    return text


def element_reason(element: Column) -> Column:
    """Why one element is refused, or null. An import of "" still refuses:
    only a missing one passes."""
    selected_import = element["conditional_event"]["selection"]["selected_import_id"]
    return F.when(element["message_event"].isNotNull(), F.lit("message")).when(
        element["conditional_event"].isNotNull() & selected_import.isNotNull(),
        F.lit("import"))


def _command_reason(missing: Column, version: Column, first_bad: Column) -> Column:
    return (F.when(missing, F.lit("none"))
            .when(version.isNull() | (version != CURRENT_VERSION), F.lit("version"))
            .otherwise(first_bad))


def validate_deployments(commands: DataFrame) -> DataFrame:
    """Add `reason`, the first failing rule of each command record.

    `commands` holds `version` and a nullable `deployment` with `elements`.
    The first refused element decides, whatever its rule.
    """
    reasons = F.transform(F.col("deployment.elements"), element_reason)
    first_bad = F.get(F.filter(reasons, lambda r: r.isNotNull()), F.lit(0))
    return commands.withColumn("reason", _command_reason(
        F.col("deployment").isNull(), F.col("version"), first_bad))


def validate_element_rows(commands: DataFrame, elements: DataFrame, key: str,
                          order: list[str]) -> DataFrame:
    """The same rules where elements are rows of their own table.

    `elements` holds the key, the ordering columns and `element_reason`. The
    first refused element is a minimum, so it is combined before the shuffle
    and a deployment with very many elements is never brought together.
    A command without element rows has no deployment.
    """
    refused = F.when(F.col("element_reason").isNotNull(),
                     F.struct(*order, "element_reason"))
    first = elements.groupBy(key).agg(F.min(refused).alias("first"))
    return (commands.join(first.withColumn("has_deployment", F.lit(True)), key, "left")
            .withColumn("reason", _command_reason(
                F.col("has_deployment").isNull(), F.col("version"),
                F.col("first.element_reason")))
            .drop("first", "has_deployment"))


def flatten_elements(deployments: DataFrame) -> DataFrame:
    """One row per (deployment, position, element); a deployment without
    elements keeps one row with nulls."""
    kept = [c for c in deployments.columns if c != "elements"]
    return deployments.select(*kept, F.posexplode_outer("elements").alias("position", "element"))


def import_policy(rows: DataFrame, ids: str = "import_ids") -> DataFrame:
    """Imports do not run on a gateway: any id refuses, none passes."""
    allowed = F.coalesce(F.array_size(F.col(ids)), F.lit(0)) == 0
    return (rows.withColumn("imports_allowed", allowed)
            .withColumn("imports_reason", F.when(~allowed, F.lit(REASONS["imports"]))))


def finalize_prepared(deployments: DataFrame, svg: str = "svg") -> DataFrame:
    """Put the model's picture into the diagram and set incident handling to
    notify without a restart."""
    return (deployments
            .withColumn("diagram", F.col("diagram").withField("svg", F.col(svg)))
            .withColumn("incident_handling", F.struct(
                F.lit(False).alias("restart"), F.lit(True).alias("notify"))))
