"""Registered queries: `(spark, sf_dir) -> DataFrame`, flat and scalar."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hubloom import functions as fn
from hubloom import schemas
from hubloom.operators import access, commands, logs, models, selection, sync, validation
from hubloom.plans import create, lifecycle, prepare
from hubloom.session import keep, shared_dir, tune
from hubloom.sources import driver_tables as dt
from hubloom.sources import json_docs
from hubloom.sources.commands import read_commands, write_commands
from hubloom.sources.tables import read_table
from hubloom.streaming import outcomes as outcome_streams
from hubloom.streaming import routing, sinks, topics
from hubloom.streaming import sync as sync_streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RECONCILE_AT = "2024-01-16"
CHECKED_AT = "2024-01-31"


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir.rstrip("/"))

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return run


# --- the flagship -----------------------------------------------------------

def _fleet(spark: SparkSession, d: str) -> DataFrame:
    """Devices on hubs; the widest step, so it is written once for all its readers."""
    return keep(spark, selection.hub_devices(
        dt.hub_members(spark, d), dt.devices(spark, d)), "fleet")


def _criteria(spark: SparkSession, d: str) -> DataFrame:
    return keep(spark, selection.criteria_counts(dt.tasks(spark, d)), "criteria")


def _tasks_with_options(spark: SparkSession, d: str) -> DataFrame:
    criteria = _criteria(spark, d)
    matched = selection.match_types(criteria, _fleet(spark, d), dt.services(spark, d))
    return selection.attach_options(
        selection.with_criteria(dt.tasks(spark, d)), selection.option_summary(matched),
        selection.CRITERIA, ["deployment_id", *dt.LINE_ORDER], criteria)


@query
def executable_deployments(spark: SparkSession, d: str) -> DataFrame:
    """Which deployments have an option for each of their tasks.

    Only tasks look for options; the commands just name deployments, those
    without elements too.
    """
    tasks = _tasks_with_options(spark, d).select("deployment_id", "is_task", "n_options")
    named = dt.commands(spark, d).select(
        "deployment_id", F.lit(False).alias("is_task"),
        F.lit(None).cast("bigint").alias("n_options"))
    return selection.executable_flag(tasks.unionByName(named), ["deployment_id"])


# --- sources and sinks ------------------------------------------------------

@query
def load_hubs(spark: SparkSession, d: str) -> DataFrame:
    """Typed read of hub records written as JSON."""
    path = shared_dir(spark, "hubs")
    dt.hub_records(spark, d).write.json(path)
    hubs = read_table(spark, "hubs", path, "json")
    return hubs.select("id", "name", "hash",
                       F.array_join("device_local_ids", ",").alias("device_local_ids"))


def _typed(name: str, *columns: str) -> None:
    """Register a typed read of records of one table, written as JSON."""
    def load(spark: SparkSession, d: str) -> DataFrame:
        path = shared_dir(spark, name)
        dt.stored_records(spark, d)[name].write.json(path)
        return read_table(spark, name, path, "json").selectExpr(*columns)

    load.__name__ = f"load_{name}"
    load.__doc__ = f"Typed read of the table {name}, written as JSON."
    query(load)


_REPORTED = ("network_id", "is_placeholder", "marked_for_delete",
             "cast(sync_date as timestamp_ntz) as sync_date")
_typed("devices", "id", "local_id", "name", "device_type_id")
_typed("device_types", "id", "device_class_id", "inline(transform(services, s -> struct("
       "s.id as service_id, array_join(s.function_ids, ',') as function_ids, "
       "array_join(s.aspect_ids, ',') as aspect_ids)))")
_typed("services", "id", "name", "array_join(function_ids, ',') as function_ids",
       "array_join(aspect_ids, ',') as aspect_ids", "rdf_type")
_typed("process_models", "_id", "name", "date", "owner", "svgXML", "publish")
_typed("permissions", "user_id", "kind", "id", "right", "allowed")
_typed("deployments", "id", "version", "name", "array_size(elements) as n_elements",
       "get(elements, 0).task.selection.selected_device_id as device_id", "diagram.xml_raw")
_typed("sync_metadata", "camunda_deployment_id", "deployment_model.id as deployment_id", *_REPORTED)
_typed("process_instances", "id", "businessKey", "ended", *_REPORTED)
_typed("historic_process_instances", "id", "durationInMillis", "state", *_REPORTED)
_typed("topic_messages", "topic", "payload", "cast(ts as timestamp_ntz) as ts")


def _props_bodies(spark: SparkSession, d: str) -> DataFrame:
    """Event properties as bodies; those of errors have lost their brace."""
    cut = F.when(F.col("event_type") == "error", F.rtrim("props", F.lit("}")))
    return dt.load(spark, d, "events").select(
        "event_id", F.coalesce(cut, "props").alias("body"))


_PROPS = schemas.StructType([schemas.StructField("k", schemas.LongType(), True)])


@query
def decoded_bodies(spark: SparkSession, d: str) -> DataFrame:
    return json_docs.decode_json(_props_bodies(spark, d), _PROPS)[0]


@query
def rejected_bodies(spark: SparkSession, d: str) -> DataFrame:
    return json_docs.decode_json(_props_bodies(spark, d), _PROPS)[1]


def _action_commands(spark: SparkSession, d: str, action: str) -> DataFrame:
    return lifecycle.action_commands(
        dt.actions(spark, d), dt.sync_metadata(spark, d), action)[0]


@query
def written_commands(spark: SparkSession, d: str) -> DataFrame:
    """Commands of three actions in one table: the removals written twice, a run
    of starts that a rerun without any empties, and the deployments."""
    path = shared_dir(spark, "commands")
    removals = _action_commands(spark, d, "remove")
    starts = _action_commands(spark, d, "start")
    write_commands(removals, path, "run-1", "remove")
    write_commands(removals, path, "run-1", "remove")
    write_commands(starts, path, "run-1", "start")
    write_commands(starts, path, "run-2", "start")
    write_commands(starts.limit(0), path, "run-2", "start")
    write_commands(create.deploy_commands(_created(spark, d), "run-1"), path, "run-1", "deploy")
    return read_commands(spark, path).drop("body")


# --- validation -------------------------------------------------------------

@query
def validated_records(spark: SparkSession, d: str) -> DataFrame:
    checked = validation.validate_deployments(dt.deployment_records(spark, d))
    return checked.select("request_id", F.coalesce("reason", F.lit("ok")).alias("result"),
                          validation.reason_text(F.col("reason")).alias("message"))


@query
def validated_element_rows(spark: SparkSession, d: str) -> DataFrame:
    checked = validation.validate_element_rows(
        dt.commands(spark, d), dt.element_rules(spark, d), "deployment_id", dt.LINE_ORDER)
    return checked.select("deployment_id", F.coalesce("reason", F.lit("ok")).alias("result"))


@query
def flattened_elements(spark: SparkSession, d: str) -> DataFrame:
    records = dt.deployment_records(spark, d).select("request_id", "deployment.elements")
    rows = validation.flatten_elements(records)
    return rows.select(
        "request_id", "position", F.col("element.bpmn_id").alias("bpmn_id"),
        F.col("element.task").isNotNull().alias("is_task"),
        F.col("element.message_event").isNotNull().alias("is_message"),
        F.col("element.conditional_event.selection.selected_import_id").alias("import_id"))


@query
def import_checks(spark: SparkSession, d: str) -> DataFrame:
    records = dt.deployment_records(spark, d).select(
        "request_id", create.selected_imports(F.col("deployment.elements")).alias("import_ids"))
    return validation.import_policy(records).drop("import_ids")


@query
def finalized_deployments(spark: SparkSession, d: str) -> DataFrame:
    records = (dt.deployment_records(spark, d).where(F.col("deployment").isNotNull())
               .select("request_id", "deployment.*")
               .withColumn("svg", F.concat(F.lit("<svg>"), "name", F.lit("</svg>"))))
    done = validation.finalize_prepared(records, "svg")
    return done.select("request_id", "diagram.xml_raw", F.col("diagram.svg").alias("svg"),
                       "incident_handling.restart", "incident_handling.notify")


@query
def classified_outcomes(spark: SparkSession, d: str) -> DataFrame:
    rows = commands.classify_outcomes(dt.outcomes(dt.load(spark, d, "events")))
    return rows.select("network_id", "seq", "status", "failed", "message")


# --- models -----------------------------------------------------------------

@query
def model_tasks(spark: SparkSession, d: str) -> DataFrame:
    rows, _ = models.extract_elements(dt.process_models(spark, d))
    return rows.withColumns({
        "inputs": F.element_at("parameter", "inputs"),
        "containers": F.array_join("containers", "/")}).drop("parameter")


@query
def unreadable_models(spark: SparkSession, d: str) -> DataFrame:
    return models.extract_elements(dt.process_models(spark, d))[1]


@query
def resolved_models(spark: SparkSession, d: str) -> DataFrame:
    return models.model_lookup(
        dt.prepare_requests(spark, d), dt.process_models(spark, d)).drop("bpmn_xml")


# --- selection --------------------------------------------------------------

@query
def attached_local_devices(spark: SparkSession, d: str) -> DataFrame:
    requests = dt.load(spark, d, "lineitem").select(
        "l_orderkey", *dt.LINE_ORDER[:3], F.col("l_suppkey").cast("string").alias("hub_id"))
    return selection.local_devices(requests, dt.hub_records(spark, d)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "hub_id", "status",
        F.array_join("local_devices", ",").alias("local_devices"))


@query
def devices_of_hubs(spark: SparkSession, d: str) -> DataFrame:
    """Parts on each supplier's lines, shipped or not."""
    members = dt.load(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("hub_id"), dt.local_id("l_partkey"))
    return selection.hub_devices(members, dt.devices(spark, d))


@query
def devices_of_hub_records(spark: SparkSession, d: str) -> DataFrame:
    """The same from hub records, whose lists are unpacked first."""
    devices = dt.devices(spark, d).withColumn("local_id", F.col("local_id").cast("string"))
    return selection.hub_devices(
        selection.hub_members(dt.hub_records(spark, d)), devices)


@query
def selection_request_rows(spark: SparkSession, d: str) -> DataFrame:
    elements = (dt.elements(spark, d)
                .withColumn("bpmn_id", F.concat_ws("_", F.lit("Task"), "l_linenumber", "l_partkey"))
                .drop("is_task"))
    rows = selection.selection_requests(elements)
    return rows.select(
        "deployment_id", "id", "hub_id", F.inline("criteria"), "include_groups",
        "include_imports", "include_devices", "include_id_modified_devices")


def _matched(spark: SparkSession, d: str, fleet: DataFrame) -> DataFrame:
    return selection.match_types(_criteria(spark, d), fleet, dt.services(spark, d))


@query
def matched_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Device and service pairs for each distinct criteria row."""
    fleet = _fleet(spark, d)
    return selection.match_candidates(_matched(spark, d, fleet), fleet)


@query
def assembled_selectables(spark: SparkSession, d: str) -> DataFrame:
    """The lists of options, unpacked again into one row per device."""
    fleet = _fleet(spark, d)
    matched = keep(spark, _matched(spark, d, fleet), "matched")
    lists = prepare.option_lists(matched, fleet)
    return (lists.select(*selection.CRITERIA, F.inline("selectables"))
            .select(*selection.CRITERIA, F.col("device.id").alias("device_id"),
                    F.col("device.name").alias("device_name"),
                    F.array_join(F.transform("services", lambda s: s["id"]), ",")
                    .alias("service_ids")))


@query
def elements_with_options(spark: SparkSession, d: str) -> DataFrame:
    """Every task with the number of its options and the default one."""
    return _tasks_with_options(spark, d).select("deployment_id", *dt.LINE_ORDER, "n_options",
                       "default_device_id", "default_service_id")


@query
def default_options(spark: SparkSession, d: str) -> DataFrame:
    """First device and first service of each distinct criteria row."""
    firsts = selection.first_options(_matched(spark, d, _fleet(spark, d)))
    return selection.default_option(firsts, selection.CRITERIA, ["device_id", "service_id"])


# --- access -----------------------------------------------------------------

@query
def access_answers(spark: SparkSession, d: str) -> DataFrame:
    return access.check_access(dt.device_refs(spark, d), dt.permissions(spark, d))


@query
def refused_deployments(spark: SparkSession, d: str) -> DataFrame:
    refs = keep(spark, dt.device_refs(spark, d), "device-refs")
    return access.refused_requests(refs, dt.permissions(spark, d))


# --- commands ---------------------------------------------------------------

@query
def fanned_out_commands(spark: SparkSession, d: str) -> DataFrame:
    rows, _ = commands.fan_out_commands(dt.actions(spark, d), dt.sync_metadata(spark, d))
    return rows.select("action_id", "network_id", "deployment_id", "engine_id")


@query
def idle_actions(spark: SparkSession, d: str) -> DataFrame:
    _, rows = commands.fan_out_commands(dt.actions(spark, d), dt.sync_metadata(spark, d))
    return rows.select("action_id", "status")


@query
def attempted_commands(spark: SparkSession, d: str) -> DataFrame:
    rows = commands.fail_fast_prefix(
        dt.outcomes(dt.load(spark, d, "events")), ["network_id", "day"])
    return rows.select("network_id", "day", "seq", "status", "attempted")


@query
def command_results(spark: SparkSession, d: str) -> DataFrame:
    return commands.action_results(
        dt.outcomes(dt.load(spark, d, "events")), ["network_id", "day"])


@query
def reconciled_deployments(spark: SparkSession, d: str) -> DataFrame:
    rows = dt.sync_metadata(spark, d)
    at = F.lit(RECONCILE_AT).cast("timestamp_ntz")
    wanted = rows.where(F.col("sync_date") < at).select(*commands.TARGET)
    return commands.reconcile(wanted, rows.where(F.col("sync_date") >= at))


@query
def commands_in_time(spark: SparkSession, d: str) -> DataFrame:
    """Clicks as commands to one of two deployments of a network; what else happens
    there reports it as synced, or as a placeholder or leaving."""
    events = dt.load(spark, d, "events")
    target = [F.col("user_id").alias("network_id"), (F.col("event_id") % 2).alias("deployment_id")]
    click = F.col("event_type") == "click"
    sent = events.where(click).select(*target, F.col("ts").alias("sent_at"))
    synced = events.where(~click).select(
        *target, F.col("ts").alias("sync_date"),
        (F.col("event_type") == "view").alias("is_placeholder"),
        (F.col("event_type") == "signup").alias("marked_for_delete"))
    return commands.reconcile_in_time(
        sent, synced, F.lit(CHECKED_AT).cast("timestamp_ntz"), "36 hours")


# --- sync state -------------------------------------------------------------

@query
def network_states(spark: SparkSession, d: str) -> DataFrame:
    return sync.network_summary(dt.sync_metadata(spark, d), dt.instances(spark, d))


@query
def newest_sync_rows(spark: SparkSession, d: str) -> DataFrame:
    return sync.latest_sync(dt.engine_sync_rows(dt.load(spark, d, "events")))


@query
def process_parameters(spark: SparkSession, d: str) -> DataFrame:
    return sync.explode_parameters(dt.parameters(spark, d))


# --- logs and scalar functions ----------------------------------------------

@query
def requests_per_path(spark: SparkSession, d: str) -> DataFrame:
    rows = logs.requests_by_path(dt.request_log(spark, d))
    return rows.select("path", "chunk", "part", F.array_size("bodies").alias("n_bodies"),
                       F.md5(F.array_join("bodies", "\n").cast("binary")).alias("bodies_md5"))


@query
def prepare_latency(spark: SparkSession, d: str) -> DataFrame:
    return logs.prepare_latency(dt.latency_log(spark, d))


@query
def latency_over_days(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles of each hub, merged from sketches of its days, lie at their ranks."""
    log = dt.load(spark, d, "events").select(
        F.col("user_id").alias("hub_id"), F.to_date("ts").alias("day"), F.col("value").alias("ms"))
    sketches = keep(spark, logs.latency_sketches(log), "latency-sketches")
    quantiles = keep(spark, logs.merged_latency(sketches, ["hub_id"]).drop("n_requests"), "quantiles")
    errors = logs.rank_errors(log, quantiles, ["hub_id"])
    return errors.select("hub_id", "n_requests", *(
        (F.col(f"{name}_error") <= logs.RANK_ERROR).alias(f"{name}_fits")
        for name in logs.QUANTILES))


def _flag_text() -> Column:
    """Flag texts by event type, readable and not."""
    return (F.when(F.col("event_type") == "view", "true")
            .when(F.col("event_type") == "click", "T")
            .when(F.col("event_type") == "signup", "yes")
            .when(F.col("event_type") == "error", "0")
            .otherwise(""))


@query
def strict_flags(spark: SparkSession, d: str) -> DataFrame:
    return dt.load(spark, d, "events").select(
        "event_id", fn.strict_bool(_flag_text()).alias("flag"),
        fn.flag_status(_flag_text()).alias("status"))


@query
def query_parameters(spark: SparkSession, d: str) -> DataFrame:
    values = fn.parse_query(fn.query_of(F.col("url")))
    return (dt.load(spark, d, "pages").select("page_id", F.explode(values).alias("name", "value"))
            .select("page_id", "name", F.col("value").cast("string").alias("value"),
                    F.schema_of_variant("value").alias("kind")))


@query
def canonical_queries(spark: SparkSession, d: str) -> DataFrame:
    return dt.load(spark, d, "pages").select(
        "page_id", fn.canonical_query(fn.query_of(F.col("url"))).alias("query"))


@query
def command_keys(spark: SparkSession, d: str) -> DataFrame:
    """Start keys with inputs that need escaping."""
    inputs = F.create_map(
        F.lit("at"), F.array(F.col("props"), F.col("event_type")),
        F.lit("a b"), F.array(F.concat(F.lit("~*+/"), F.col("value").cast("decimal(10,2)")
                                       .cast("string"))))
    key = fn.command_key(F.lit("start"), F.concat(F.lit("urn:hub:"), "user_id"),
                         F.concat_ws("/ ", F.col("event_type"), F.col("event_id")), inputs)
    return dt.load(spark, d, "events").select("event_id", key.alias("command_key"))


# --- whole request paths ----------------------------------------------------

def _with_options(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    fleet = selection.hub_devices(dt.hub_members(spark, d), dt.devices(spark, d))
    criteria, _, matched = prepare.match(spark, rows, fleet, dt.services(spark, d))
    return prepare.prepared_elements(rows, criteria, matched)


@query
def posted_preparations(spark: SparkSession, d: str) -> DataFrame:
    """Prepare requests with the model in the body."""
    requests, posted, rejects = prepare.posted_requests(dt.posted_bodies(spark, d))
    rows = prepare.request_elements(
        requests, prepare.element_table(spark, posted), dt.known_hubs(spark, d))
    headers = prepare.answered(
        requests, prepare.prepared_headers(_with_options(spark, d, rows))).drop("model_id")
    none = F.lit(None)
    return headers.unionByName(rejects.select(
        "hub_id", "request_id", "status", F.lit(0).cast("bigint").alias("n_tasks"),
        F.lit(0).cast("bigint").alias("n_with_options"), none.cast("boolean").alias("executable")))


def _prepared_elements(spark: SparkSession, d: str) -> DataFrame:
    elements = prepare.element_table(spark, dt.process_models(spark, d))
    rows = prepare.request_elements(
        dt.prepare_requests(spark, d), elements, dt.known_hubs(spark, d))
    return _with_options(spark, d, rows)


@query
def prepared_elements(spark: SparkSession, d: str) -> DataFrame:
    """Elements of each distinct pair of hub and model."""
    return _prepared_elements(spark, d).select(
        "hub_id", "model_id", "status", "bpmn_id", "is_task", "n_options",
        "default_device_id", "default_service_id")


@query
def prepared_requests(spark: SparkSession, d: str) -> DataFrame:
    headers = prepare.prepared_headers(_prepared_elements(spark, d))
    return prepare.answered(dt.prepare_requests(spark, d), headers)


@query
def prepared_for_users(spark: SparkSession, d: str) -> DataFrame:
    """The same requests, each offered only what its user may use."""
    asked = keep(spark, dt.user_requests(spark, d), "asked")
    usable = keep(spark, selection.user_devices(
        dt.hub_members(spark, d), dt.devices(spark, d), access.grants(dt.permissions(spark, d)),
        asked), "usable")
    classes, fleet = selection.permission_classes(usable, asked)
    requests = selection.for_classes(asked, classes)
    known = selection.for_classes(classes.select("hub_id", "user_id").join(
        dt.known_hubs(spark, d), "hub_id"), classes).select("hub_id").distinct()
    rows = prepare.request_elements(
        requests, prepare.element_table(spark, dt.process_models(spark, d)), known)
    criteria, _, matched = prepare.match(spark, rows, fleet, dt.services(spark, d))
    headers = prepare.prepared_headers(prepare.prepared_elements(rows, criteria, matched))
    return prepare.answered(requests, headers, "user_id").select(
        "request_id", "hub_id.hub_id", "user_id", "model_id", "status", "n_tasks",
        "n_with_options", "executable")


@query
def prepared_deployments(spark: SparkSession, d: str) -> DataFrame:
    rows = prepare.answered(dt.prepare_requests(spark, d), prepare.prepared_deployments(
        _prepared_elements(spark, d), dt.process_models(spark, d)))
    criteria = F.transform("elements", lambda e: F.concat_ws(
        "/", e["bpmn_id"], *(e["task"]["selection"]["filter_criteria"][c]
                             for c in selection.CRITERIA[1:])))
    return rows.select("request_id", "hub_id", "model_id", "version", "name", "executable",
                       F.array_join(criteria, ",").alias("elements"),
                       F.size("options_keys").alias("n_options_keys"),
                       F.col("diagram.svg").alias("svg"), "incident_handling.restart",
                       "incident_handling.notify")


def _create_requests(spark: SparkSession, d: str) -> DataFrame:
    return dt.command_bodies(dt.load(spark, d, "orders"), bare=True).select(
        "request_id", F.col("user_id").cast("string").alias("user_id"),
        F.col("user_id").alias("network_id"), "body",
        F.concat(F.lit("source-"), "user_id").alias("source"),
        F.when(F.col("request_id") == F.col("user_id"), "maybe").otherwise("true").alias("flag"))


def _own_devices(spark: SparkSession, d: str) -> DataFrame:
    """Customers in credit may execute the device that bears their number."""
    return dt.load(spark, d, "customer").where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").cast("string").alias("user_id"), F.lit("devices").alias("kind"),
        F.col("c_custkey").cast("string").alias("id"), F.lit("x").alias("right"),
        F.lit(True).alias("allowed"))


def _created(spark: SparkSession, d: str) -> DataFrame:
    return create.create(spark, _create_requests(spark, d), _own_devices(spark, d))


@query
def created_deployments(spark: SparkSession, d: str) -> DataFrame:
    """Raw bodies through all checks of a create request."""
    return _created(spark, d).select(
        "request_id", "optional_service", "status", "reason",
        F.array_size("deployment.elements").alias("n_elements"))


@query
def deploy_command_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = create.deploy_commands(_created(spark, d), "run-1")
    return rows.select("action_id", "network_id", "deployment_id", "source",
                       F.get_json_object("body", "$.id").alias("sent_id"),
                       F.get_json_object("body", "$.name").alias("name"),
                       F.get_json_object("body", "$.elements[0].bpmn_id").alias("first_element"))


def _action_report(spark: SparkSession, d: str, action: str) -> DataFrame:
    keyed, idle = lifecycle.action_commands(
        dt.actions(spark, d), dt.sync_metadata(spark, d), action)
    answers = dt.outcomes(dt.load(spark, d, "events")).withColumnRenamed("seq", "engine_id")
    return lifecycle.action_report(keyed, idle, answers)


@query
def removed_deployments(spark: SparkSession, d: str) -> DataFrame:
    return _action_report(spark, d, "remove")


@query
def started_deployments(spark: SparkSession, d: str) -> DataFrame:
    """Start commands with their inputs in the key."""
    inputs = F.create_map(F.lit("segment"), F.array("segment"))
    rows, _ = lifecycle.action_commands(
        dt.actions(spark, d), dt.sync_metadata(spark, d), "start", inputs)
    return rows.select("action_id", "engine_id", "command_key")


# --- streams ----------------------------------------------------------------

def _stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table as a stream. The glob fits one file and a folder of files."""
    return (spark.readStream.schema(schemas.DRIVER_TABLES[name])
            .parquet(f"{d}/{name}.parquet*"))


def _finish(started) -> None:
    try:
        started.awaitTermination()
    finally:
        started.stop()


@query
def routed_commands_stream(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "routed")
    messages = dt.command_bodies(_stream(spark, d, "orders")).withColumnRenamed(
        "user_id", "network_id")
    _finish(routing.route_commands_stream(messages, f"{path}/out", f"{path}/checkpoint"))
    schema = routing.route(messages).schema
    return sinks.read_files(spark, f"{path}/out", schema).select(
        "request_id", "network_id", F.coalesce("reason", F.lit("ok")).alias("result"), "route")


@query
def redelivered_commands_stream(spark: SparkSession, d: str) -> DataFrame:
    """Messages whose bus delivers them twice, the second time to a stream that has been
    stopped in between, and each twice within one delivery: one command for each."""
    path = shared_dir(spark, "redelivered")
    messages = dt.command_bodies(dt.load(spark, d, "orders")).withColumnRenamed(
        "user_id", "network_id")
    for delivery in (messages.unionAll(messages), messages):
        delivery.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(messages.schema).parquet(f"{path}/in")
        _finish(routing.route_commands_stream(
            stream, f"{path}/out", f"{path}/checkpoint", f"{path}/commands"))
    return read_commands(spark, f"{path}/commands").select(
        F.col("action_id").cast("bigint").alias("request_id"),
        F.col("network_id").cast("bigint").alias("network_id"), "action")


_ACTION = ["network_id", "day"]


def _outcome_deliveries(spark: SparkSession, d: str, path: str) -> DataFrame:
    """Outcomes as they arrive, the stream run after each of three deliveries."""
    events = dt.load(spark, d, "events")
    rows = dt.outcomes(events)
    for part in range(3):
        rows.where(F.pmod(F.xxhash64("seq"), F.lit(3)) == part).write.mode("append").parquet(
            f"{path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
        _finish(outcome_streams.action_results_stream(
            stream, _ACTION, f"{path}/out", f"{path}/checkpoint"))
    return rows


@query
def action_results_stream(spark: SparkSession, d: str) -> DataFrame:
    """The first failure of each action, from outcomes that came in any order."""
    path = shared_dir(spark, "outcomes")
    rows = _outcome_deliveries(spark, d, path)
    results = outcome_streams.read_action_results(
        spark, f"{path}/out", rows.select(*_ACTION).schema)
    return results.select(*_ACTION, "n_commands", "failed_seq", F.when(
        F.col("failed_seq").isNotNull(), F.col("status")).alias("status"), "message")


@query
def attempted_commands_stream(spark: SparkSession, d: str) -> DataFrame:
    """Which of the commands were attempted, once all outcomes have arrived."""
    path = shared_dir(spark, "outcomes")
    rows = _outcome_deliveries(spark, d, path)
    results = outcome_streams.read_action_results(
        spark, f"{path}/out", rows.select(*_ACTION).schema)
    return outcome_streams.attempted(rows, results, _ACTION).select(
        "network_id", "day", "seq", "status", "attempted")


@query
def latest_sync_stream(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "latest-sync")
    rows = dt.engine_sync_rows(_stream(spark, d, "events"))
    _finish(sync_streams.latest_sync_stream(rows, f"{path}/out", f"{path}/checkpoint"))
    sync_streams.compact(spark, f"{path}/out", rows.schema)
    return sync_streams.read_latest(spark, f"{path}/out", rows.schema)


@query
def live_deployments_stream(spark: SparkSession, d: str) -> DataFrame:
    """Twenty engine deployments of each network, reported in three deliveries of any
    order, without those whose newest report marks them for delete."""
    path = shared_dir(spark, "live")
    rows = dt.sync_metadata(spark, d).withColumn("engine_id", F.col("deployment_id"))
    for part in range(3):
        rows.where(F.pmod(F.xxhash64("seq"), F.lit(3)) == part).write.mode("append").parquet(
            f"{path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
        _finish(sync_streams.live_sync_stream(stream, f"{path}/out", f"{path}/checkpoint"))
    live = sync_streams.read_live(
        spark, f"{path}/out", rows.select(*sync_streams.ENGINE_KEY).schema)
    return live.select("network_id", "engine_id", "seq", "is_placeholder",
                       F.col("sync_date").cast("timestamp_ntz").alias("sync_date"))


@query
def topic_activity_stream(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "topics")
    messages = _stream(spark, d, "events").select(
        F.col("event_type").alias("topic"), F.col("ts").cast("timestamp").alias("ts"))
    counted = topics.topic_activity(messages)
    _finish(topics.topic_activity_stream(messages, f"{path}/out", f"{path}/checkpoint"))
    return sinks.read_files(spark, f"{path}/out", counted.schema).select(
        "topic", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "n_messages")
