"""Jobs over record tables written as JSON, from prepare to remove."""

import json

import pytest

from pyspark.sql import functions as F

from conftest import rows
from hubloom import jobs
from hubloom.session import shared_dir
from hubloom.sources import records
from hubloom.sources.commands import read_commands
from hubloom.streaming import routing, sinks
from hubloom.streaming import sync as sync_streams
from test_models import document, task

HUB = "urn:hub:mill-north"
VALVES = ["urn:device:valve-a", "urn:device:valve-b"]
TABLES = {
    "hubs": [{"id": HUB, "name": "north mill", "hash": "0a1b",
              "device_local_ids": ["serial-77", "2"]},
             {"id": "urn:hub:mill-south", "name": "south mill", "hash": "2c3d",
              "device_local_ids": []}],
    "devices": [
        {"id": VALVES[0], "local_id": "serial-77", "name": "inlet", "device_type_id": "valve"},
        {"id": VALVES[1], "local_id": "2", "name": "outlet", "device_type_id": "valve"}],
    "device_types": [{
        "id": "valve", "name": "valve", "device_class_id": "class-thermostat",
        "services": [{"id": "urn:service:open", "name": "open by percent",
                      "interaction": "request", "function_ids": ["fn-set"],
                      "aspect_ids": ["flow"],
                      "inputs": [{"id": "c", "content_variable": {"name": "p", "value": 0}}]}]}],
    "process_models": [{"_id": "model", "name": "open_valve", "date": 1714550400000,
                        "bpmn_xml": document(task("Task_1")), "svgXML": "<svg/>",
                        "publish": False}],
    "permissions": [{"user_id": user, "kind": "devices", "id": VALVES[i],
                     "right": right, "allowed": True} for user, i, right in (
        ("u", 0, "x"), ("v", 0, "x"), ("v", 1, "x"), ("w", 0, "r"))],
    "sync_metadata": [{
        "camunda_deployment_id": f"engine {i}", "network_id": HUB, "is_placeholder": False,
        "marked_for_delete": False, "sync_date": "2024-05-01T08:00:00Z",
        "deployment_model": {"id": "deployment", "version": 3}} for i in (1, 2)],
}


@pytest.fixture(scope="module")
def run(spark):
    base = shared_dir(spark, "test-jobs")

    def put(name, listed):
        spark.createDataFrame([(json.dumps(r),) for r in listed], "value string").write.mode(
            "overwrite").text(f"{base}/{name}")
        return f"{base}/{name}"

    paths = {name: put(name, listed) for name, listed in TABLES.items()}

    def call(job, requests):
        out = f"{base}/out-{job}"
        argv = [job, "--requests", put(f"requests-{job}", requests), "--out", out,
                "--format", "json", "--run-id", "r1"]
        for table in jobs.JOBS[job][1]:
            argv += [f"--{table}", paths[table]]
        jobs.main(argv, spark)
        return out

    return call


def test_prepare(spark, run):
    out = run("prepare", [
        {"request_id": str(i), "user_id": user, "hub_id": hub, "model_id": "model"}
        for i, (user, hub) in enumerate([("u", HUB), ("u", "urn:hub:none"), ("v", HUB),
                                         ("u", HUB), ("w", HUB)])])
    requests = spark.read.parquet(f"{out}/answers")
    assert rows(requests.select("request_id", "status", "executable")) == [
        ("0", 200, True), ("1", 500, None), ("2", 200, True), ("3", 200, True),
        ("4", 200, False)]
    classes = spark.read.parquet(f"{out}/classes")
    of = {r.user_id: r.class_id for r in classes.where(F.col("hub_id") == HUB).collect()}
    assert len(set(of.values())) == 3
    elements = spark.read.parquet(f"{out}/elements").where("is_task")
    assert {r.hub_id.class_id: r.n_options for r in elements.collect()} == {
        of["u"]: 1, of["v"]: 2, of["w"]: None}
    element = elements.where(F.col("hub_id.class_id") == of["v"]).first()
    assert (element.bpmn_id, element.default_device_id, element.default_service_id) == (
        "Task_1", "urn:device:valve-a", "urn:service:open")
    deployments = spark.read.parquet(f"{out}/deployments")
    assert rows(deployments.select("request_id")) == [("0",), ("2",), ("3",), ("4",)]
    deployment = deployments.where("request_id = '2'").first()
    assert (deployment.diagram.svg, deployment.executable) == ("<svg/>", True)
    assert deployment.elements[0].bpmn_id == "Task_1"
    option = spark.read.parquet(f"{out}/options").where(
        F.col("hub_id.class_id") == of["v"]).first()
    assert [option.options_key] == deployment.options_keys == [element.options_key]
    devices = spark.read.parquet(f"{out}/devices").where(
        (F.col("hub_id.class_id") == of["v"]) & (F.col("device_type_id") == option.device_type_id))
    assert rows(devices.select("device_name")) == [("inlet",), ("outlet",)]


def test_create(spark, run):
    def body(device):
        return json.dumps({"version": 3, "name": "d", "elements": [
            {"bpmn_id": "Task_1", "task": {"selection": {"selected_device_id": device}}}]})

    def request(number, text, flag=""):
        return {"request_id": number, "user_id": "u", "network_id": HUB, "source": "app",
                "flag": flag, "body": text}

    out = run("create", [request("1", body("urn:device:valve-a")),
                         request("2", body("urn:device:valve-b")), request("3", "{")])
    assert rows(spark.read.parquet(f"{out}/answers").select("request_id", "status")) == [
        ("1", 200), ("2", 403), ("3", 400)]
    command = read_commands(spark, f"{out}/commands").first()
    assert (command.run_id, command.action, command.network_id, command.source) == (
        "r1", "deploy", HUB, "app")
    assert json.loads(command.body)["id"] == command.deployment_id
    assert json.loads(command.body)["elements"][0]["bpmn_id"] == "Task_1"


@pytest.mark.parametrize("job,query,tail", [
    ("start", "b=2&a=1&a=x+y", "?a=1&a=x+y&b=2"), ("start", "", ""), ("remove", None, "")])
def test_actions(spark, run, job, query, tail):
    def action(number, deployment):
        return {"action_id": number, "network_id": HUB, "deployment_id": deployment,
                "query": query}

    out = run(job, [action("1", "deployment"), action("2", "unknown")])
    got = read_commands(spark, f"{out}/commands").where(F.col("action") == job)
    assert rows(got.select("action_id", "command_key")) == [
        ("1", f"{job}/urn:hub:mill-north/engine%20{i}{tail}") for i in (1, 2)]
    assert rows(spark.read.parquet(f"{out}/idle").select("action_id", "status")) == [("2", 200)]


def test_reconcile(spark, run):
    out = run("reconcile", [{"network_id": HUB, "deployment_id": "deployment"},
                            {"network_id": HUB, "deployment_id": "lost"}])
    assert rows(spark.read.parquet(f"{out}/states").select("deployment_id", "state")) == [
        ("deployment", "in_sync"), ("lost", "missing")]


def test_route(spark, run):
    messages = [
        {"request_id": "1", "network_id": HUB,
         "body": json.dumps({"version": 3, "deployment": {"name": "d", "elements": []}})},
        {"request_id": "2", "network_id": HUB, "body": json.dumps({"version": 3})},
        {"request_id": "3", "network_id": HUB, "body": "{"}]
    out = run("route", messages)
    assert read_commands(spark, f"{out}/commands").count() == 1
    schema = routing.route(
        spark.createDataFrame([], jobs.REQUESTS["route"])).schema
    routed = sinks.read_batches(spark, f"{out}/batches", schema)
    assert rows(routed.select("request_id", "reason", "route")) == [
        ("1", None, "accepted"), ("2", "none", "rejected"), ("3", "unreadable", "rejected")]


def test_sync(spark, run):
    def report(date, deleting):
        return TABLES["sync_metadata"][0] | {"sync_date": date, "marked_for_delete": deleting}

    out = run("sync", [report("2024-05-02T00:00:00Z", True), report("2024-05-01T00:00:00Z", False),
                       TABLES["sync_metadata"][1]])
    schema = records.sync_rows(spark.createDataFrame([], jobs.REQUESTS["sync"])).schema
    latest = sync_streams.read_latest(spark, f"{out}/batches", schema)
    assert rows(latest.select("engine_id", "marked_for_delete")) == [
        ("engine 1", True), ("engine 2", False)]
