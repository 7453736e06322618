"""Record tables, as services store them, in the column names operators use."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def known_hubs(hubs: DataFrame) -> DataFrame:
    return hubs.select(F.col("id").alias("hub_id"))


def devices(records: DataFrame) -> DataFrame:
    return records.select("local_id", F.col("id").alias("device_id"),
                          F.col("name").alias("device_name"), "device_type_id")


def models(records: DataFrame) -> DataFrame:
    return records.select(F.col("_id").alias("model_id"), "bpmn_xml",
                          F.col("svgXML").alias("svg_xml"))


def sync_rows(records: DataFrame) -> DataFrame:
    """Sync metadata; commands to one deployment go out in engine id order.

    What was deployed is kept as text. `report` decides between reports of one
    engine deployment with equal dates.
    """
    rows = records.select(
        "network_id", F.col("deployment_model.id").alias("deployment_id"),
        F.col("camunda_deployment_id").alias("engine_id"),
        F.col("camunda_deployment_id").alias("seq"),
        "is_placeholder", "marked_for_delete", "sync_date",
        F.to_json("deployment_model").alias("deployment_model"),
        F.to_json("process_parameter").alias("process_parameter"))
    return rows.withColumn("report", F.md5(F.to_json(F.struct(
        "is_placeholder", "marked_for_delete", "deployment_model", "process_parameter"))
        .cast("binary")))
