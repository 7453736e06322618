"""Create: from raw request bodies to deploy commands or refusals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hubloom import schemas
from hubloom.functions import flag_status, strict_bool
from hubloom.operators import access, validation
from hubloom.session import keep
from hubloom.sources.json_docs import CORRUPT, decode

# A message of the route stream; a create request's body is the bare deployment.
BODY = schemas.StructType([
    schemas.DEPLOYMENT_COMMAND["version"], schemas.DEPLOYMENT_COMMAND["deployment"]])

_CHOSEN = "selection: struct<selected_device_id: string>"
REFERENCES = (f"elements array<struct<task: struct<{_CHOSEN}>,"
              f"message_event: struct<{_CHOSEN}>, conditional_event: struct<{_CHOSEN}>>>")
SELECTIONS = ("task", "message_event", "conditional_event")


def records(raw: DataFrame) -> DataFrame:
    """Decode bodies and flags; `version` and `deployment` are null where the
    body cannot be read."""
    decoded = decode(raw, schemas.DEPLOYMENT).withColumnRenamed("status", "__read")
    read = F.col("__read") == 200
    return decoded.select(
        "request_id", "user_id", "network_id",
        *(F.col(c) for c in ("source", "__refused") if c in raw.columns),
        strict_bool(F.col("flag")).alias("optional_service"),
        F.when(read, flag_status(F.col("flag"))).otherwise(F.col("__read")).alias("status"),
        F.when(read, F.col("decoded.version")).alias("version"),
        F.when(read, F.col("decoded").dropFields(CORRUPT)).alias("deployment"))


def device_references(raw: DataFrame) -> DataFrame:
    """Devices the elements of each request select.

    Only their ids are read from the bodies. What a faulty body yields does no
    harm, since its fault is reported before its rights.
    """
    body = F.from_json("body", REFERENCES)
    chosen = F.transform(body["elements"], lambda e: F.coalesce(
        *(e[kind]["selection"]["selected_device_id"] for kind in SELECTIONS)))
    rows = raw.select("request_id", "user_id", F.lit("devices").alias("kind"),
                      F.explode_outer(chosen).alias("id"))
    return rows.where(F.col("id").isNotNull())


def selected_imports(elements: Column) -> Column:
    """Import ids that any selection of some elements names."""
    ids = F.flatten(F.transform(elements, lambda e: F.array(
        *(e[kind]["selection"]["selected_import_id"] for kind in SELECTIONS))))
    return F.filter(ids, lambda i: i.isNotNull() & (i != ""))


def create(spark: SparkSession, raw: DataFrame, permissions: DataFrame) -> DataFrame:
    """Every request with its `status` and `reason`; 200 rows are commands.

    `raw` holds `request_id, user_id, network_id, flag, body` and may hold
    `source`; a body is a bare deployment. The checks run in this order: body,
    flag, rights on the selected devices, imports, deployment rules. Bodies are
    read twice: once for the ids the rights check needs, which are kept as a
    narrow table, and once for the answer, after the text has met the list of
    refused requests, so that no decoded record is shuffled.
    """
    refs = keep(spark, device_references(raw), "device-references")
    refused = access.refused_requests(refs, permissions).withColumn("__refused", F.lit(True))
    decoded = records(raw.join(refused, "request_id", "left"))
    checked = validation.import_policy(validation.validate_deployments(decoded.withColumn(
        "__imports", selected_imports(F.col("deployment.elements")))), "__imports")
    unread, is_refused = F.col("status") != 200, F.col("__refused").isNotNull()
    rule = F.when(~F.col("imports_allowed"), F.lit("imports")).otherwise(F.col("reason"))
    status = (F.when(unread, F.col("status")).when(is_refused, 403)
              .when(rule.isNotNull(), 500).otherwise(200))
    reason = (F.when(unread, "request").when(is_refused, "access").otherwise(rule))
    return checked.withColumns({"status": status, "reason": reason}).drop(
        "__refused", "__imports", "imports_allowed", "imports_reason")


def new_id(run_id: str, request: Column) -> Column:
    """The id a deployment gets: the same one when a run is repeated."""
    digest = F.md5(F.concat(F.lit(f"{run_id}:"), request.cast("string")).cast("binary"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *(F.substring(digest, a, n) for a, n in cuts))


def deploy_commands(created: DataFrame, run_id: str) -> DataFrame:
    """Accepted requests as rows for the command table, under a new id."""
    source = F.col("source") if "source" in created.columns else F.lit(None).cast("string")
    accepted = created.where(F.col("status") == 200).withColumn(
        "deployment_id", new_id(run_id, F.col("request_id")))
    return accepted.select(
        F.col("request_id").cast("string").alias("action_id"),
        F.col("network_id").cast("string").alias("network_id"), "deployment_id",
        source.alias("source"),
        F.to_json(F.col("deployment").withField("id", F.col("deployment_id")),
                  {"ignoreNullFields": "false"}).alias("body"))
