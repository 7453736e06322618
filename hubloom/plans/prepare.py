"""Prepare: which tasks of a model can run on a hub, for many requests at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hubloom import schemas
from hubloom.operators import models as model_ops
from hubloom.operators import selection
from hubloom.operators.validation import CURRENT_VERSION, finalize_prepared
from hubloom.session import keep
from hubloom.sources.json_docs import decode_json

# What decides a request's answer. Requests that share it are answered once.
PAIR = ["hub_id", "model_id"]


def posted_requests(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Requests that bring their model along, as `(requests, models, rejects)`.

    `raw` holds `request_id, hub_id, body` with XML and SVG in the body; the
    request id serves as model id. Bodies that cannot be read are rejected.
    """
    good, rejects = decode_json(raw, schemas.PREPARE_REQUEST)
    requests = good.select("request_id", "hub_id", F.col("request_id").alias("model_id"))
    models = good.select(F.col("request_id").alias("model_id"), F.col("xml").alias("bpmn_xml"),
                         F.col("svg").alias("svg_xml"))
    return requests, models, rejects


def element_table(spark: SparkSession, models: DataFrame,
                  requests: DataFrame | None = None) -> DataFrame:
    """Model elements as a written table, those of `requests` or of all models.

    A prepare run reads them twice, for the criteria and for the answer, and
    reading XML is the costliest step, so it is done once and kept in the
    shared folder, where it also survives lost executors.
    """
    if requests is not None:
        models = models.join(requests.select("model_id").distinct(), "model_id", "left_semi")
    return keep(spark, model_ops.model_elements(models), "model-elements")


def request_elements(requests: DataFrame, elements: DataFrame, hubs: DataFrame) -> DataFrame:
    """Distinct pairs of hub and model with the elements of the model and a status.

    404 for an unknown model; 500 for an unreadable one and for an unknown hub,
    whose own error code is not passed on. The hub comes first, so that the
    elements of a refused pair are not listed.
    """
    known = hubs.select("hub_id", F.lit(True).alias("__hub"))
    pairs = requests.select(*PAIR).distinct().join(known, "hub_id", "left")
    joined = pairs.join(elements, "model_id", "left")
    status = (F.when(F.col("readable").isNull(), 404)
              .when(~F.col("readable") | F.col("__hub").isNull(), 500)
              .otherwise(200))
    return (joined.withColumn("status", status)
            .withColumn("is_task", (F.col("status") == 200) & F.col("position").isNotNull())
            .drop("readable", "__hub"))


def answered(requests: DataFrame, by_pair: DataFrame, *also: str) -> DataFrame:
    """Every request with what is known of its pair, and with columns of its own."""
    asked = requests.select("request_id", *also, *(F.col(c).alias(f"__{c}") for c in PAIR))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in PAIR]
    return asked.join(by_pair, same[0] & same[1]).select("request_id", *also, *by_pair.columns)


def match(spark: SparkSession, rows: DataFrame, fleet: DataFrame,
          services: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Criteria of the tasks among `rows`, the devices on hubs, and the device
    types that meet each criteria row: `(criteria, fleet, matched)`."""
    fleet = keep(spark, fleet, "fleet")
    criteria = keep(spark, selection.criteria_counts(rows.where("is_task")), "criteria")
    return criteria, fleet, selection.match_types(criteria, fleet, services)


def prepared_elements(rows: DataFrame, criteria: DataFrame, matched: DataFrame) -> DataFrame:
    """Elements with the number of options, the default option and the key
    under which the options are listed."""
    return selection.attach_options(
        selection.with_criteria(rows), selection.option_summary(matched),
        selection.CRITERIA, [*PAIR, "position"], criteria).withColumn(
        "options_key", F.when(F.col("is_task"), selection.options_key()))


def option_lists(matched: DataFrame, fleet: DataFrame) -> DataFrame:
    """The options of every criteria row as lists."""
    sizes = selection.option_summary(matched).withColumnRenamed("n_options", "n_rows")
    return selection.assemble_selectables(
        selection.device_options(matched, fleet), sizes=sizes)


def options_for(keys: DataFrame, matched: DataFrame, fleet: DataFrame) -> DataFrame:
    """The option lists under the `options_key`s of some prepared elements, for the
    caller who is about to choose."""
    wanted = keys.select("options_key").distinct()
    asked = matched.withColumn("options_key", selection.options_key()).join(
        wanted, "options_key", "left_semi").drop("options_key")
    return option_lists(asked, fleet).withColumn("options_key", selection.options_key())


def prepared_headers(elements: DataFrame) -> DataFrame:
    """One row per pair: status, and whether every task has an option."""
    flags = selection.executable_flag(elements, [*PAIR, "status"])
    return flags.withColumn("executable", F.when(F.col("status") == 200, F.col("executable")))


def _element():
    """Element record of a task row; what the request left blank is null."""
    def null(kind):
        return F.lit(None).cast(kind)

    def record(schema, **given):
        return F.struct(*(given.get(f.name, null(f.dataType)).cast(f.dataType).alias(f.name)
                          for f in schema.fields))

    criteria = record(
        schemas.FILTER_CRITERIA, characteristic_id=F.col("characteristic_id"),
        **{c: F.nullif(F.col(c), F.lit("")) for c in selection.CRITERIA[1:]})
    task = record(schemas.TASK, retries=F.col("retries"), parameter=F.col("parameter"),
                  selection=record(schemas.SELECTION, filter_criteria=criteria))
    return record(schemas.ELEMENT, bpmn_id=F.col("bpmn_id"), name=F.col("name"),
                  order=F.lit(0), task=task)


def prepared_deployments(elements: DataFrame, models: DataFrame) -> DataFrame:
    """Deployment records of the successful pairs, with `hub_id, model_id`.

    A record lists the tasks of one model, so its size is that of the model.
    Options are not repeated in every record: `options_keys` holds, for each
    element in turn, the key of its options.
    """
    listed = F.collect_list(F.when(F.col("is_task"), F.struct(
        "position", _element().alias("element"), "options_key")))
    in_order = F.array_sort(listed, lambda a, b: a["position"] - b["position"])
    has_option = F.coalesce(F.col("n_options"), F.lit(0)) > 0
    records = elements.where(F.col("status") == 200).groupBy(*PAIR, "process_id").agg(
        F.transform(in_order, lambda e: e["element"]).alias("elements"),
        F.transform(in_order, lambda e: e["options_key"]).alias("options_keys"),
        F.bool_and(~F.col("is_task") | has_option).alias("executable"))
    ready, _ = model_ops.resolve_model(records, models)
    shaped = finalize_prepared(ready.withColumn("diagram", F.struct(
        F.col("bpmn_xml").alias("xml_raw"), F.lit("").alias("xml_deployed"),
        F.lit("").alias("svg"))), "svg_xml")
    return shaped.select(
        *PAIR, "options_keys", F.lit(CURRENT_VERSION).alias("version"), F.lit("").alias("id"),
        F.col("process_id").alias("name"), F.lit("").alias("description"), "diagram",
        "elements", "executable", "incident_handling")
