"""Streams against the batch result over the same files."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hubloom.operators.commands import action_results, fail_fast_prefix
from hubloom.operators.sync import latest_sync
from hubloom.session import shared_dir
from hubloom.sources.commands import read_commands
from hubloom.streaming import outcomes, routing, sinks, topics
from hubloom.streaming import sync as sync_streams

SYNC = "network_id string, engine_id string, sync_date timestamp, seq long, state string"
START = datetime(2024, 1, 1)


def add_file(spark, path, listed, schema):
    spark.createDataFrame(listed, schema).coalesce(1).write.mode("append").parquet(path)


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None and not query.isActive


def sync_batch(n, offset=0):
    return [(f"n{i % 3}", f"e{i % 7}", START + timedelta(minutes=(i * 37 + offset) % 101),
             i + offset, f"state {i + offset}") for i in range(n)]


def test_latest_sync_stream_over_two_runs(spark):
    path = shared_dir(spark, "test-latest")
    source = f"{path}/in"

    def run():
        stream = spark.readStream.schema(SYNC).option("maxFilesPerTrigger", 1).parquet(source)
        finish(sync_streams.latest_sync_stream(stream, f"{path}/out", f"{path}/checkpoint"))

    for offset in (0, 50):
        add_file(spark, source, sync_batch(40, offset), SYNC)
    run()
    add_file(spark, source, sync_batch(30, 500), SYNC)
    run()
    run()
    table = spark.read.schema(SYNC).parquet(source)
    expected = rows(latest_sync(table))
    assert rows(sync_streams.read_latest(spark, f"{path}/out", table.schema)) == expected
    sync_streams.compact(spark, f"{path}/out", table.schema)
    newest, upto = sync_streams._compacted(spark, f"{path}/out")
    assert rows(spark.read.parquet(newest).select(*table.columns)) == expected
    assert sinks.read_batches(spark, f"{path}/out", table.schema, upto).count() == 0
    add_file(spark, source, sync_batch(20, 900), SYNC)
    run()
    expected = rows(latest_sync(spark.read.schema(SYNC).parquet(source)))
    assert rows(sync_streams.read_latest(spark, f"{path}/out", table.schema)) == expected
    sync_streams.compact(spark, f"{path}/out", table.schema)
    sync_streams.compact(spark, f"{path}/out", table.schema)
    assert rows(sync_streams.read_latest(spark, f"{path}/out", table.schema)) == expected


def test_nothing_written_yet(spark):
    schema = spark.createDataFrame([], SYNC).schema
    assert sinks.read_batches(spark, shared_dir(spark, "test-none"), schema).count() == 0


def test_repeated_batch_does_not_double_rows(spark):
    """A second stream over the same files writes the same batch folders."""
    path = shared_dir(spark, "test-repeat")
    add_file(spark, f"{path}/in", sync_batch(20), SYNC)
    for attempt in ("one", "two"):
        stream = spark.readStream.schema(SYNC).parquet(f"{path}/in")
        finish(sinks.write_batches(stream, f"{path}/out", f"{path}/checkpoint-{attempt}"))
    assert sinks.read_batches(spark, f"{path}/out", stream.schema).count() == 20


def test_route_stream(spark):
    path = shared_dir(spark, "test-route")
    schema = "request_id long, network_id string, body string"
    good = '{"version": 3, "deployment": {"name": "d", "elements": []}}'
    add_file(spark, f"{path}/in", [
        (1, "n", good), (2, "n", good.replace("3", "2")), (3, "n", '{"version": 3}'),
        (4, "n", "{bad")], schema)
    add_file(spark, f"{path}/in", [
        (5, "m", '{"version": 3, "deployment": {"elements": [{"message_event": {}}]}}')], schema)
    messages = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    finish(routing.route_commands_stream(messages, f"{path}/out", f"{path}/checkpoint"))
    routed = sinks.read_files(spark, f"{path}/out", routing.route(messages).schema)
    assert rows(routed.select("request_id", "reason", "route")) == [
        (1, None, "accepted"), (2, "version", "rejected"), (3, "none", "rejected"),
        (4, "unreadable", "rejected"), (5, "message", "rejected")]
    sent = routed.where("route = 'accepted'").select(F.get_json_object("deployment", "$.name"))
    assert rows(sent) == [("d",)]
    finish(routing.route_commands_stream(messages, f"{path}/both", f"{path}/other",
                                         f"{path}/commands"))
    again = sinks.read_batches(spark, f"{path}/both", routing.route(messages).schema)
    assert rows(again.drop("batch_id")) == rows(routed)
    commands = read_commands(spark, f"{path}/commands")
    assert rows(commands.select("action", "action_id", "network_id")) == [("deploy", "1", "n")]


GOOD = '{"version": 3, "deployment": {"id": "%s", "name": "d", "elements": []}}'
MESSAGE = "request_id string, network_id string, body string, ts timestamp"


@pytest.mark.parametrize("remember", [None, "1 hour"])
def test_a_message_delivered_again_is_one_command(spark, remember):
    """Within a batch, in the next one and after a restart; ids are those of a hub."""
    path = shared_dir(spark, "test-once")
    batches = [
        [("1", "n", GOOD % "a", START), ("1", "n", GOOD % "a", START), ("1", "m", GOOD % "b", START)],
        [("1", "n", GOOD % "a", START), ("2", "n", GOOD % "c", START), ("3", "n", "{", START)],
        [(None, "n", GOOD % "d", START), (None, "n", GOOD % "e", START),
         (None, "n", GOOD % "d", START), ("3", "n", "{", START), ("2", "n", GOOD % "c", START)]]
    for batch in batches:
        add_file(spark, f"{path}/in", batch, MESSAGE)
        stream = spark.readStream.schema(MESSAGE).parquet(f"{path}/in")
        finish(routing.route_commands_stream(
            stream, f"{path}/out", f"{path}/checkpoint", f"{path}/commands", remember=remember))
    sent = read_commands(spark, f"{path}/commands")
    assert rows(sent.select("deployment_id", "network_id")) == [
        ("a", "n"), ("b", "m"), ("c", "n"), ("d", "n"), ("e", "n")]
    routed = sinks.read_batches(spark, f"{path}/out", routing.route(stream).schema)
    assert routed.where("route = 'rejected'").count() == 1


OUTCOME = "action_id string, seq long, status int, body string"


def test_outcomes_in_any_order(spark):
    path = shared_dir(spark, "test-outcomes")
    listed = [(f"a{i % 4}", i, 500 if i in (13, 22, 9, 33) else 200, f"body {i}") for i in range(40)]
    listed += [(None, 1, 500, ""), (None, 0, 404, None)]
    action = spark.createDataFrame([], OUTCOME).select("action_id").schema

    def run(some, quiet="1 hour"):
        add_file(spark, f"{path}/in", some, OUTCOME)
        stream = spark.readStream.schema(OUTCOME).parquet(f"{path}/in")
        finish(outcomes.action_results_stream(
            stream, ["action_id"], f"{path}/out", f"{path}/checkpoint", quiet))
        return outcomes.read_action_results(spark, f"{path}/out", action)

    for part in (listed[30:], listed[::2], listed[1:30:2][:-1]):
        run(part)
    whole = spark.read.schema(OUTCOME).parquet(f"{path}/in")
    results = run([("a0", 100, 503, "late")], quiet="1 hour")
    table = spark.read.schema(OUTCOME).parquet(f"{path}/in")
    failed = rows(action_results(table, ["action_id"]).where("status != 200"))
    assert rows(results.where("failed_seq is not null").drop("failed_seq")) == failed
    assert {r.action_id: r.status for r in results.collect()}["a3"] is None
    got = outcomes.attempted(whole, results, ["action_id"]).select("action_id", "seq", "attempted")
    want = fail_fast_prefix(whole, ["action_id"]).select("action_id", "seq", "attempted")
    assert rows(got.where("action_id is not null")) == rows(want.where("action_id is not null"))


def test_a_quiet_action_is_closed_and_heard_again(spark):
    path = shared_dir(spark, "test-quiet")
    action = spark.createDataFrame([], OUTCOME).select("action_id").schema

    def run(*some):
        add_file(spark, f"{path}/in", some, OUTCOME)
        stream = spark.readStream.schema(OUTCOME).parquet(f"{path}/in")
        finish(outcomes.action_results_stream(
            stream, ["action_id"], f"{path}/out", f"{path}/checkpoint", "1 millisecond"))
        found = outcomes.read_action_results(spark, f"{path}/out", action)
        return {r.action_id: (r.n_commands, r.failed_seq, r.status) for r in found.collect()}

    assert run(("a", 3, 200, ""), ("b", 2, 500, "")) in (
        {"a": (1, None, None), "b": (1, 2, 500)}, {"a": (1, None, 200), "b": (1, 2, 500)})
    run(("c", 1, 200, ""))
    found = run(("d", 1, 200, ""))
    assert found["a"] == (1, None, 200) and found["b"] == (1, 2, 500)
    found = run(("a", 1, 500, "late"), ("b", 1, 404, ""), ("b", 4, 500, ""))
    assert found["a"] == (2, 1, 500) and found["b"] == (3, 1, 404)


LIVE = ("network_id long, engine_id long, sync_date timestamp, seq long, deployment_id long, "
        "is_placeholder boolean, marked_for_delete boolean")


def test_state_of_quiet_deployments_goes(spark):
    """What is left of the state are those that reported last; the newest rows are all there."""
    path = shared_dir(spark, "test-live")
    key = spark.createDataFrame([], LIVE).select("network_id", "engine_id").schema
    report = lambda n, minutes, deleted=False, seq=0: (
        1, n, START + timedelta(minutes=minutes), seq, n, False, deleted)

    def run(*some):
        add_file(spark, f"{path}/in", some, LIVE)
        stream = spark.readStream.schema(LIVE).parquet(f"{path}/in")
        query = sync_streams.live_sync_stream(
            stream, f"{path}/out", f"{path}/checkpoint", "1 millisecond")
        finish(query)
        return query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]

    def live():
        rows_now = sync_streams.read_live(spark, f"{path}/out", key).collect()
        return {r.engine_id: (r.sync_date - START).seconds // 60 for r in rows_now}

    run(*(report(n, 10) for n in range(30)), report(3, 12), report(3, 11))
    assert live() == {n: 12 if n == 3 else 10 for n in range(30)}
    run(report(1, 20), report(2, 20, True), report(1, 20, True, -1))
    sizes = [run(report(5, 30)), run(report(5, 31)), run(report(5, 29))]
    assert sizes[-1] <= 2
    # Older than what was known before its state went.
    run(report(2, 15), report(1, 5), report(4, 40, True))
    assert live() == {**{n: 10 for n in range(30) if n not in (2, 4)}, 1: 20, 3: 12, 5: 31}


TOPIC = "topic string, ts timestamp"


@pytest.mark.parametrize("late_dropped", [False, True])
def test_topic_activity_closes_windows_and_drops_late_rows(spark, late_dropped):
    path = shared_dir(spark, "test-topics")

    def at(minutes):
        return START + timedelta(minutes=minutes)

    add_file(spark, f"{path}/in", [("a", at(5)), ("a", at(59)), ("b", at(61)),
                                   ("a", at(200 if late_dropped else 65))], TOPIC)
    # The watermark a batch sets drops late rows from the batch after the next.
    add_file(spark, f"{path}/in", [("b", at(66))], TOPIC)
    add_file(spark, f"{path}/in", [("a", at(10)), ("a", at(400))], TOPIC)
    messages = spark.readStream.schema(TOPIC).option("maxFilesPerTrigger", 1).option(
        "latestFirst", "false").parquet(f"{path}/in")
    counted = topics.topic_activity(messages)
    finish(topics.topic_activity_stream(messages, f"{path}/out", f"{path}/checkpoint"))
    got = sinks.read_files(spark, f"{path}/out", counted.schema)
    first = got.where((F.col("topic") == "a") & (F.col("window_start") == F.lit(START))).first()
    assert first.n_messages == (2 if late_dropped else 3)
    assert got.where(F.col("window_end") > F.lit(at(390))).count() == 0


def test_actions_have_a_state_without_python(spark):
    """Groups of many actions cost no Python call each; windows of arrival add up."""
    path = shared_dir(spark, "test-actions-native")
    action = spark.createDataFrame([], OUTCOME).select("action_id").schema
    for part in range(2):
        add_file(spark, f"{path}/in", [
            (f"a{i}", 10 * part + 1, 500 if i == part else 200, f"b{part}") for i in range(50)]
            + [("a0", None, 500, "no number")], OUTCOME)
        stream = spark.readStream.schema(OUTCOME).parquet(f"{path}/in")
        query = outcomes.action_results_stream(
            stream, ["action_id"], f"{path}/out", f"{path}/checkpoint", "1 millisecond")
        finish(query)
        assert query.recentProgress[-1]["stateOperators"][0]["operatorName"] == "stateStoreSave"
    found = {r.action_id: (r.n_commands, r.failed_seq) for r in outcomes.read_action_results(
        spark, f"{path}/out", action).collect()}
    assert found == {f"a{i}": (2, None) for i in range(2, 50)} | {"a0": (4, 1), "a1": (2, 11)}


def test_deployments_have_a_state_without_python(spark):
    """Reports behind the newest known one change nothing and are not written."""
    path = shared_dir(spark, "test-live-native")
    key = spark.createDataFrame([], LIVE).select("network_id", "engine_id").schema
    written = []
    for part, minutes in enumerate((10, 5, 20)):
        add_file(spark, f"{path}/in", [
            (1, n, START + timedelta(minutes=minutes), part, n, False, False)
            for n in range(30)], LIVE)
        stream = spark.readStream.schema(LIVE).parquet(f"{path}/in")
        query = sync_streams.live_sync_stream(
            stream, f"{path}/out", f"{path}/checkpoint", "36500 days")
        finish(query)
        assert query.recentProgress[-1]["stateOperators"][0]["operatorName"] == "stateStoreSave"
        written.append(sinks.read_batches(spark, f"{path}/out", key).count())
    assert written == [30, 30, 60]
    live = sync_streams.read_live(spark, f"{path}/out", key)
    assert {r.seq for r in live.collect()} == {2} and live.count() == 30
