"""Request paths on small tables, and what plans must not contain."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hubloom.operators import selection
from hubloom.plans import create, prepare
from hubloom.plans.queries import QUERIES
from hubloom.session import inline
from hubloom.sources import driver_tables as dt
from hubloom.sources.tables import save_bucketed
from test_models import DOCUMENTS

EAGER_SINKS = {"written_commands", "routed_commands_stream", "latest_sync_stream",
               "topic_activity_stream", "redelivered_commands_stream", "action_results_stream",
               "attempted_commands_stream", "live_deployments_stream"}


GOLDEN = {
    "version": 3, "id": "", "name": "p", "description": "",
    "diagram": {"xml_raw": DOCUMENTS["one"], "xml_deployed": "", "svg": "<svg>one</svg>"},
    "elements": [{
        "bpmn_id": "T1", "group": None, "name": "set it", "order": 0, "time_event": None,
        "notification": None, "message_event": None, "conditional_event": None,
        "task": {"retries": 2, "parameter": {"inputs": "0"}, "selection": {
            "filter_criteria": {
                "characteristic_id": "celsius", "function_id": "fn-set",
                "device_class_id": "class-thermostat", "aspect_id": None},
            "selection_options": None, "selected_device_id": None, "selected_service_id": None,
            "selected_device_group_id": None, "selected_import_id": None,
            "selected_generic_event_source": None, "selected_path": None}}}],
    "executable": True, "incident_handling": {"restart": False, "notify": True}}


def test_prepare(spark):
    models = spark.createDataFrame(
        [(k, v, f"<svg>{k}</svg>") for k, v in DOCUMENTS.items()],
        "model_id string, bpmn_xml string, svg_xml string")
    services = spark.createDataFrame(
        [("type", "class-thermostat", "s2", "set", ["fn-set"], ["warmth"]),
         ("type", "class-thermostat", "s1", "set too", ["fn-set"], None),
         ("other", "class-lamp", "s3", "set", ["fn-set"], None)],
        "device_type_id string, device_class_id string, service_id string, "
        "service_name string, function_ids array<string>, aspect_ids array<string>")
    devices = spark.createDataFrame(
        [("1", "d2", "x", "type"), ("2", "d1", "y", "type"), ("3", "d0", "lamp", "other")],
        "local_id string, device_id string, device_name string, device_type_id string")
    members = spark.createDataFrame(
        [("h1", "1"), ("h1", "2"), ("h1", "3"), ("h2", "3")], "hub_id string, local_id string")
    hubs = spark.createDataFrame([("h1",), ("h2",)], "hub_id string")
    asked = [("h1", "one"), ("h2", "one"), ("h1", "none"), ("h1", "broken"), ("h1", "unknown"),
             ("h9", "one"), ("h9", "unknown"), ("h1", "nested"), ("h1", "one"), ("h1", None),
             ("h1", "bad payload"), ("h1", "deep")]
    requests = spark.createDataFrame([(i, *pair) for i, pair in enumerate(asked)],
                                     "request_id int, hub_id string, model_id string")

    found = prepare.request_elements(requests, prepare.element_table(spark, models), hubs)
    criteria, fleet, matched = prepare.match(
        spark, found, selection.hub_devices(members, devices), services)
    elements = prepare.prepared_elements(found, criteria, matched)
    headers = prepare.prepared_headers(elements)
    answers = {r.request_id: (r.status, r.n_tasks, r.executable)
               for r in prepare.answered(requests, headers).collect()}
    assert answers == {
        0: (200, 1, True), 1: (200, 1, False), 2: (200, 0, True), 3: (500, 0, None),
        4: (404, 0, None), 5: (500, 0, None), 6: (404, 0, None), 7: (200, 3, True),
        8: (200, 1, True), 9: (404, 0, None), 10: (500, 0, None), 11: (200, 2, True)}
    task = elements.where("hub_id = 'h1' and model_id = 'one'").first()
    assert (task.n_options, task.default_device_id, task.default_service_id) == (2, "d1", "s1")
    listed = prepare.option_lists(matched, fleet).where("hub_id = 'h1'").first()
    assert [(o.device.id, [s.id for s in o.services]) for o in listed.selectables] == [
        ("d1", ["s1", "s2"]), ("d2", ["s1", "s2"])]

    chosen = prepare.options_for(
        elements.where("hub_id = 'h1' and model_id = 'two'"), matched, fleet)
    assert chosen.count() == 0
    chosen = prepare.options_for(elements.where("hub_id = 'h1' and model_id = 'one'"), matched, fleet)
    assert [(r.options_key, r.selectables[0].device.id, r.selectables[0].services[0].id)
            for r in chosen.collect()] == [(task.options_key, "d1", "s1")]

    done = prepare.prepared_deployments(elements, models)
    repeated = prepare.answered(requests, done).where("hub_id = 'h1' and model_id = 'one'")
    assert [(r.request_id, len(r.elements)) for r in repeated.orderBy("request_id").collect()] == [
        (0, 1), (8, 1)]
    keyed = done.where("hub_id = 'h1' and model_id = 'one'").first().options_keys
    assert keyed == [task.options_key] == [
        r[0] for r in matched.where("hub_id = 'h1' and device_class_id != ''")
        .select(selection.options_key()).distinct().collect()]
    assert done.select("hub_id", "model_id", "executable").where("not executable").collect() == [
        ("h2", "one", False)]
    nested = done.where("model_id = 'nested'").first()
    assert [e.bpmn_id for e in nested.elements] == ["T1", "T2", "T3"]
    assert done.where("model_id = 'none'").first().elements == []
    record = done.where("hub_id = 'h1' and model_id = 'one'").select(F.to_json(
        F.struct(*done.columns[3:]), {"ignoreNullFields": "false"})).first()[0]
    assert json.loads(record) == GOLDEN


def body(**deployment):
    return json.dumps({"version": 3, **deployment})


def task(device):
    return {"task": {"selection": {"selected_device_id": device}}}


def test_create(spark):
    requests = [
        ("ok", "u", "", body(name="a", elements=[task("d1")])),
        ("no device", "u", "true", body(name="b", elements=[task(None)])),
        ("bad body", "u", "", "{"),
        ("bad body and flag", "u", "yes", "{"),
        ("bad flag", "u", "yes", body(elements=[task("d9")])),
        ("refused", "u", "", body(elements=[task("d1"), task("d9")])),
        ("refused event", "u", "", body(elements=[
            {"conditional_event": {"selection": {"selected_device_id": "d9"}}}])),
        ("refused and invalid", "u", "", body(elements=[{"message_event": {}}, task("d9")])),
        ("message", "u", "f", body(elements=[{"message_event": {}}])),
        ("import", "u", "", body(elements=[
            {"task": {"selection": {"selected_import_id": "i"}}}, {"message_event": {}}])),
        ("blank import", "u", "", body(elements=[
            {"conditional_event": {"selection": {"selected_import_id": ""}}}])),
        ("refused import", "u", "", body(elements=[
            {"task": {"selection": {"selected_import_id": "i"}}}, task("d9")])),
        ("old", "u", "", '{"version": 2}'), ("null", "u", "", "null"),
    ]
    raw = spark.createDataFrame(
        requests, "request_id string, user_id string, flag string, body string").withColumns(
        {"network_id": F.lit("n"), "source": F.lit("app")})
    permissions = spark.createDataFrame(
        [("u", "devices", "d1", "x", True)],
        "user_id string, kind string, id string, right string, allowed boolean")
    created = create.create(spark, raw, permissions)
    assert {r.request_id: (r.status, r.reason) for r in created.collect()} == {
        "ok": (200, None), "no device": (200, None), "bad body": (400, "request"),
        "bad body and flag": (400, "request"), "bad flag": (400, "request"),
        "refused": (403, "access"), "refused event": (403, "access"),
        "refused and invalid": (403, "access"), "message": (500, "message"),
        "import": (500, "imports"), "blank import": (500, "import"),
        "refused import": (403, "access"), "old": (500, "version"), "null": (400, "request")}
    sent = create.deploy_commands(created, "run").select(
        "action_id", "source", F.get_json_object("body", "$.name"))
    assert rows(sent) == [("no device", "app", "b"), ("ok", "app", "a")]


def test_bucketed_fleet_is_joined_without_shuffle(spark, sf_dir):
    names = ("hubloom_members", "hubloom_devices")
    members = dt.hub_members(spark, sf_dir).drop("owner_id")
    devices = dt.devices(spark, sf_dir).drop("owner_id")
    plain = selection.hub_devices(members, devices)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        save_bucketed(members, names[0], "local_id", 4)
        save_bucketed(devices, names[1], "local_id", 4)
        joined = selection.hub_devices(spark.table(names[0]), spark.table(names[1]))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert rows(joined) == rows(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_what_was_prepared_is_sent_under_a_new_id(spark):
    """A deployment goes out as it came in, executable or not, but for its id."""
    sent = json.loads(json.dumps(GOLDEN)) | {"executable": False}
    chosen = {"selected_device_id": "d1", "selected_service_id": "s1",
              "selected_path": {"path": "temperature.level", "is_void": False}}
    sent["elements"][0]["task"]["selection"] |= chosen
    raw = spark.createDataFrame(
        [("r", "u", "n", "true", json.dumps(sent))],
        "request_id string, user_id string, network_id string, flag string, body string")
    permissions = spark.createDataFrame(
        [("u", "devices", "d1", "x", True)],
        "user_id string, kind string, id string, right string, allowed boolean")
    created = create.create(spark, raw, permissions)
    assert (created.first().status, created.first().optional_service) == (200, True)
    command, again = (create.deploy_commands(created, "run").first() for _ in range(2))
    assert command.deployment_id == again.deployment_id and len(command.deployment_id) == 36
    assert (command.network_id, json.loads(command.body)) == (
        "n", sent | {"id": command.deployment_id})
    other = create.deploy_commands(created, "other run").first()
    assert other.deployment_id != command.deployment_id


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    """Whole physical plans: nothing is written on the way, and no small table is
    broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with inline():
            return {name: build(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
                    for name, build in QUERIES.items() if name not in EAGER_SINKS and not name.startswith("load_")}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_cross_joins_and_no_python(plans):
    for name, plan in plans.items():
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval",
                     "SinglePartition, REPARTITION"):
            assert word not in plan, (name, word)


def test_only_hot_keys_are_broadcast(plans):
    """Fewer than a thousand rows; nothing else is broadcast by a hint."""
    for name, plan in plans.items():
        broadcasts = plan.count("+- BroadcastExchange") + plan.count(":- BroadcastExchange")
        assert broadcasts == plan.count("AS __hot#"), name


def test_filters_and_columns_reach_the_scan(plans):
    plan = plans["executable_deployments"]
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,F)" in plan
    assert "l_comment" not in plan and "l_extendedprice" not in plan
