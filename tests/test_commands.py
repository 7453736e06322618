from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from conftest import rows
from hubloom.operators import access, commands, sync
from hubloom.plans import lifecycle
from hubloom.schemas import COMMAND
from hubloom.sources.commands import drop_old_versions, read_commands, write_commands
from hubloom.session import shared_dir
from pyspark.sql import functions as F

META = [("n1", "d1", "e1", 1, 1), ("n1", "d3", "e3", 1, 1), ("n1", "d3", "e4", 2, 1),
        ("n1", "d3", "e5", 3, 1), ("n2", "d1", "e9", 1, 1),
        # Reported again, and moved to another deployment.
        ("n1", "d3", "e3", 1, 2), ("n1", "d0", "e5", 3, 0)]


def metadata(spark):
    return spark.createDataFrame(META, "network_id string, deployment_id string, "
                                 "engine_id string, seq int, sync_date int")


def actions(spark):
    return spark.createDataFrame(
        [("a0", "n1", "d0"), ("a1", "n1", "d1"), ("a3", "n1", "d3"), ("a9", "n9", "d1")],
        "action_id string, network_id string, deployment_id string")


def test_fan_out_none_one_and_many(spark):
    sent, idle = commands.fan_out_commands(actions(spark), metadata(spark))
    assert rows(sent.select("action_id", "engine_id")) == [
        ("a1", "e1"), ("a3", "e3"), ("a3", "e4"), ("a3", "e5")]
    assert rows(idle.select("action_id", "status")) == [("a0", 200), ("a9", 200)]


OUTCOMES = [
    ("first", 1, 500, "boom"), ("first", 2, 200, ""), ("first", 3, 404, "late"),
    ("middle", 1, 200, ""), ("middle", 2, 300, ""), ("middle", 3, 200, ""),
    ("last", 1, 200, ""), ("last", 2, 299, ""), ("last", 3, 503, "busy"),
    ("none", 1, 200, ""), ("none", 2, 201, ""),
]


def test_fail_fast(spark):
    frame = spark.createDataFrame(OUTCOMES, "action_id string, seq int, status int, body string")
    tried = commands.fail_fast_prefix(frame, ["action_id"]).where("attempted")
    assert rows(tried.select("action_id", "seq")) == [
        ("first", 1), ("last", 1), ("last", 2), ("last", 3), ("middle", 1), ("middle", 2),
        ("none", 1), ("none", 2)]
    got = commands.action_results(frame, ["action_id"])
    assert rows(got.select("action_id", "status", "message")) == [
        ("first", 500, "boom"), ("last", 503, "busy"), ("middle", 300, ""), ("none", 200, None)]


def test_reconcile(spark):
    wanted = spark.createDataFrame(
        [("n", d) for d in ("ok", "gone", "waiting", "leaving", "back")] + [("n", "ok")],
        "network_id string, deployment_id string")
    synced = spark.createDataFrame(
        [("n", "ok", False, False, 1, 1), ("n", "extra", False, False, 1, 2),
         ("n", "waiting", True, False, 1, 3), ("n", "leaving", True, True, 1, 4),
         ("n", "back", True, False, 1, 5), ("n", "back", False, False, 1, 6),
         ("n", "stray", False, True, 2, 7), ("n", "stray", False, False, 1, 8)],
        "network_id string, deployment_id string, is_placeholder boolean, "
        "marked_for_delete boolean, sync_date int, seq int")
    assert rows(commands.reconcile(wanted, synced).drop("network_id")) == [
        ("back", "in_sync"), ("extra", "unexpected"), ("gone", "missing"),
        ("leaving", "deleting"), ("ok", "in_sync"), ("stray", "deleting"),
        ("waiting", "placeholder")]


def test_reconcile_in_time(spark):
    """Answers of the same day, a later day and never; dead reports are no answers."""
    at = lambda day, hour=0: datetime(2024, 1, day, hour)
    sent = spark.createDataFrame(
        [("n", "a", at(1, 5)), ("n", "a", at(1, 9)), ("n", "a", at(3)), ("n", "b", at(1)),
         ("n", "c", at(9)), ("m", "a", at(1)), ("n", "d", at(2)), (None, "a", at(1)),
         ("n", "a", at(1, 5))],
        "network_id string, deployment_id string, sent_at timestamp_ntz")
    synced = spark.createDataFrame(
        [("n", "a", at(1, 9), False, False), ("n", "a", at(1, 7), True, False),
         ("n", "a", at(1, 8), False, True), ("n", "a", at(20), False, False),
         ("n", "a", at(3, 1), False, False), ("n", "b", at(4), False, False),
         ("n", "d", at(1, 23), False, False), (None, "a", at(2, 1), False, False)],
        "network_id string, deployment_id string, sync_date timestamp_ntz, "
        "is_placeholder boolean, marked_for_delete boolean")
    got = commands.reconcile_in_time(sent, synced, F.lit(at(10)), "2 days")
    assert rows(got) == sorted([
        ("n", "a", at(1, 5), at(1, 9), "in_sync"), ("n", "a", at(1, 5), at(1, 9), "in_sync"),
        ("n", "a", at(1, 9), at(1, 9), "in_sync"), ("n", "a", at(3), at(3, 1), "in_sync"),
        ("n", "b", at(1), at(4), "late"), ("n", "c", at(9), None, "waiting"),
        ("m", "a", at(1), None, "late"), ("n", "d", at(2), None, "late"),
        (None, "a", at(1), at(2, 1), "in_sync")], key=repr)
    assert commands.reconcile_in_time(sent.limit(0), synced, F.lit(at(10)), "2 days").count() == 0


def test_rerun_replaces_its_own_rows(spark):
    path = shared_dir(spark, "test-commands")

    def write(run, action, *keys):
        listed = spark.createDataFrame([("n", k) for k in keys],
                                       "network_id string, command_key string")
        write_commands(listed, path, run, action)

    def read():
        got = read_commands(spark, path)
        assert got.columns == COMMAND.names
        return rows(got.select("run_id", "action", "command_key"))

    write("2024-01-01", "deploy", "a")
    write("2024-01-01", "remove", "b", "c")
    write("a/b=c", "deploy", "c")
    write("2024-01-01", "deploy", "d")
    assert read() == [("2024-01-01", "deploy", "d"), ("2024-01-01", "remove", "b"),
                      ("2024-01-01", "remove", "c"), ("a/b=c", "deploy", "c")]
    write("2024-01-01", "remove", "c")
    write("2024-01-01", "deploy")
    assert read() == [("2024-01-01", "remove", "c"), ("a/b=c", "deploy", "c")]


def test_a_rerun_that_fails_leaves_what_was_there(spark):
    path = shared_dir(spark, "test-versions")
    good = spark.createDataFrame([("n", "a"), ("n", "b")], "network_id string, command_key string")
    assert read_commands(spark, path).columns == COMMAND.names
    assert read_commands(spark, path).count() == 0
    write_commands(good, path, "run", "deploy")
    # The first partition is written, the second one fails.
    half = spark.range(0, 2000, 1, 2).select(
        F.lit("n").alias("network_id"), F.when(F.col("id") < 1900, F.col("id").cast("string"))
        .otherwise(F.raise_error(F.lit("broken"))).alias("command_key"))
    with pytest.raises(PySparkException):
        write_commands(half, path, "run", "deploy")
    read = lambda: rows(read_commands(spark, path).select("command_key"))
    assert read() == [("a",), ("b",)]
    before = read_commands(spark, path)
    write_commands(good.limit(1), path, "run", "deploy")
    assert rows(before.select("command_key")) == [("a",), ("b",)]
    assert len(read()) == 1
    drop_old_versions(spark, path)
    drop_old_versions(spark, path)
    assert len(read()) == 1


def test_access(spark):
    permissions = spark.createDataFrame(
        [("u", "devices", "d1", "x", True), ("u", "devices", "d2", "r", True),
         ("u", "devices", "d3", "x", False), ("u", "devices", "d3", "x", True),
         ("v", "devices", "d4", "x", True), ("u", "hubs", "d5", "x", True)],
        "user_id string, kind string, id string, right string, allowed boolean")
    refs = spark.createDataFrame(
        [("q1", "u", "devices", "d1"), ("q1", "u", "devices", "d3"), ("q2", "u", "devices", "d1"),
         ("q2", "u", "devices", "d2"), ("q3", "u", "devices", "d4"),
         ("q4", "u", "devices", "d5"), ("q5", "v", "devices", "d4")],
        "request_id string, user_id string, kind string, id string")
    answers = access.check_access(refs, permissions)
    assert rows(answers.select("user_id", "id", "allowed")) == [
        ("u", "d1", True), ("u", "d2", False), ("u", "d3", True), ("u", "d4", False),
        ("u", "d5", False), ("v", "d4", True)]
    assert rows(access.refused_requests(refs, permissions)) == [("q2",), ("q3",), ("q4",)]


def test_lifecycle(spark):
    """Deploy, start and remove: synced once, one command each, then gone."""
    wanted = spark.createDataFrame([("n", "d")], "network_id string, deployment_id string")
    state = "network_id string, deployment_id string, engine_id string, " \
            "is_placeholder boolean, marked_for_delete boolean, sync_date int, seq int"
    live = spark.createDataFrame([("n", "d", "e", False, False, 1, 1)], state)
    nothing = spark.createDataFrame([], state)
    assert rows(commands.reconcile(wanted, nothing)) == [("n", "d", "missing")]
    assert rows(commands.reconcile(wanted, live)) == [("n", "d", "in_sync")]
    summary = sync.network_summary(live).first()
    assert (summary.n_deployments, summary.n_live) == (1, 1)

    act = wanted.withColumn("action_id", F.lit("a"))
    answers = spark.createDataFrame([("n", "e", 200, "true")],
                                    "network_id string, engine_id string, status int, body string")
    for action, inputs, key in (
            ("start", F.create_map(F.lit("x"), F.array(F.lit("1"))), "start/n/e?x=1"),
            ("remove", None, "remove/n/e")):
        sent, idle = lifecycle.action_commands(act, live, action, inputs)
        assert [r.command_key for r in sent.collect()] == [key]
        assert rows(lifecycle.action_report(sent, idle, answers)) == [("a", 1, 200, None)]
        assert rows(lifecycle.action_report(sent, idle, answers.limit(0))) == [
            ("a", 1, None, None)]
    sent, idle = lifecycle.action_commands(act, nothing, "remove")
    assert rows(lifecycle.action_report(sent, idle, answers)) == [("a", 0, 200, None)]
    none = wanted.limit(0)
    assert rows(commands.reconcile(none, nothing)) == []
