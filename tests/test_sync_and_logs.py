import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hubloom import schemas
from hubloom.operators import logs, sync
from hubloom.session import shared_dir
from hubloom.sources import records
from hubloom.sources.tables import read_table


def test_latest_sync_breaks_ties_by_seq(spark):
    frame = spark.createDataFrame(
        [("n", "e", 1, 1, "old"), ("n", "e", 2, 2, "late but newest"), ("n", "e", 2, 1, "tie"),
         ("n", "f", 1, 9, "only"), ("m", "e", 0, 3, "other network")],
        "network_id string, engine_id string, sync_date int, seq int, state string")
    assert rows(sync.latest_sync(frame).select("network_id", "engine_id", "state")) == [
        ("m", "e", "other network"), ("n", "e", "late but newest"), ("n", "f", "only")]


def test_network_summary_counts_rows_that_are_both(spark):
    frame = spark.createDataFrame(
        [("n", True, True, 1), ("n", False, False, 3), ("n", True, False, 2),
         ("m", False, True, 5)],
        "network_id string, is_placeholder boolean, marked_for_delete boolean, sync_date int")
    instances = spark.createDataFrame([("n", True), ("n", False), ("only instances", False)],
                                      "network_id string, ended boolean")
    assert rows(sync.network_summary(frame, instances)) == [
        ("m", 1, 0, 1, 0, 5, 0, 0), ("n", 3, 2, 1, 1, 3, 2, 1),
        ("only instances", 0, 0, 0, 0, None, 1, 1)]


def test_equal_dates_are_decided_by_the_report(spark):
    record = '{"camunda_deployment_id": "e", "network_id": "n", "is_placeholder": %s, ' \
             '"sync_date": "2024-01-01T00:00:00Z", "deployment_model": {"id": "d"}}'
    got = set()
    for order in (("true", "false"), ("false", "true")):
        path = shared_dir(spark, "test-ties")
        spark.createDataFrame([(record % o,) for o in order], "value string").write.text(path)
        table = records.sync_rows(read_table(spark, "sync_metadata", path, "json"))
        got.add(tuple(sync.latest_sync(table).first()))
    assert len(got) == 1 and '"id":"d"' in next(iter(got))[7]


def test_parameters_are_cast_by_declared_type(spark):
    variables = {"long": ("42", "Long"), "text as long": ('"7"', "Long"), "bad": ('"x"', "Long"),
                 "double": ("1.5", "Double"), "flag": ("true", "Boolean"),
                 "text": ('"hi"', "String"), "nothing": ("null", "String"),
                 "undeclared": ('{"a":1}', "Json")}
    struct = ", ".join(
        f"'{k}', named_struct('value', parse_json('{v}'), 'type', '{t}', "
        "'valueInfo', cast(null as variant))" for k, (v, t) in variables.items())
    frame = spark.sql(f"select 'e' as engine_id, map({struct}) as process_parameter")
    got = {r.name: (r.value_long, r.value_double, r.value_boolean, r.value_string)
           for r in sync.explode_parameters(frame).collect()}
    assert got == {
        "long": (42, None, None, None), "text as long": (7, None, None, None),
        "bad": (None,) * 4, "double": (None, 1.5, None, None), "flag": (None, None, True, None),
        "text": (None, None, None, "hi"), "nothing": (None,) * 4, "undeclared": (None,) * 4}


def test_requests_by_path_keeps_order_across_chunks(spark):
    rng = random.Random(2)
    log = [(rng.choice(["/hot", "/hot", "/cold"]), i, f" body {i}\n") for i in range(95)]
    shuffled = rng.sample(log, len(log))
    frame = spark.createDataFrame(shuffled, "path string, seq long, body string")
    for size in (1 << 20, 20, 1):
        got = logs.requests_by_path(frame, 10, size).orderBy("path", "chunk", "part").collect()
        assert max(len(r.bodies) for r in got) <= min(10, size // 6 + 1)
        for path in ("/hot", "/cold"):
            assert [b for r in got if r.path == path for b in r.bodies] == [
                f"body {i}" for p, i, _ in log if p == path]


def test_prepare_latency_is_exact(spark):
    rng = random.Random(3)
    times = {"h1": [rng.uniform(0, 300) for _ in range(997)], "h2": [5.9], "h3": [1.0, 2.0]}
    frame = spark.createDataFrame(
        [(h, ms) for h, listed in times.items() for ms in listed], "hub_id string, ms double")
    got = {r.hub_id: r for r in logs.prepare_latency(frame).collect()}
    for hub, listed in times.items():
        whole = sorted(int(ms) for ms in listed)
        at = [whole[-(-len(whole) * p // 100) - 1] for p in (50, 95)]
        assert [got[hub].p50_ms, got[hub].p95_ms, got[hub].max_ms] == [*at, whole[-1]]
        assert got[hub].avg_ms == pytest.approx(sum(whole) / len(whole))


def test_typed_tables_round_trip(spark):
    path = shared_dir(spark, "test-tables")
    now = datetime(2024, 1, 2, 3, 4, 5)
    frame = spark.createDataFrame(
        [("i", "n", now)], "id string, network_id string, sync_date timestamp")
    frame.write.json(f"{path}/json")
    frame.write.parquet(f"{path}/parquet")
    for kind in ("json", "parquet"):
        table = read_table(spark, "process_instances", f"{path}/{kind}", kind)
        assert table.schema == schemas.PROCESS_INSTANCE
        assert table.select("id", "sync_date", "ended").first() == ("i", now, None)
    with pytest.raises(KeyError):
        read_table(spark, "nothing", path)


def test_recursive_content_stays_a_variant(spark):
    path = shared_dir(spark, "test-services")
    body = ('{"id": "s", "function_ids": ["f"], "inputs": [{"id": "c", "content_variable": '
            '{"name": "t", "sub_content_variables": [{"name": "level", "value": 0}]}}]}')
    spark.createDataFrame([(body,)], "value string").write.text(path)
    services = read_table(spark, "services", path, "json")
    level = F.variant_get(F.col("inputs")[0]["content_variable"],
                          "$.sub_content_variables[0].name", "string")
    assert services.select("id", level).first() == ("s", "level")


@pytest.mark.parametrize("n", [20_000, 200_000])
def test_rank_error_of_merged_sketches(spark, n):
    """Ten times the rows, one hub with a third of them, leave the error where it is."""
    log = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5).alias("hub_id"),
        (F.col("id") % 30).alias("day"),
        F.pow(F.pmod(F.xxhash64("id"), F.lit(10_000)) / 100, F.lit(2)).alias("ms"))
    sketches = logs.latency_sketches(log)
    assert sketches.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    quantiles = logs.merged_latency(sketches, ["hub_id"])
    assert {r.hub_id: r.n_requests for r in quantiles.collect()} == {
        r.hub_id: r["count"] for r in log.groupBy("hub_id").count().collect()}
    errors = logs.rank_errors(log, spark.createDataFrame(
        quantiles.drop("n_requests").collect()), ["hub_id"]).collect()
    assert len(errors) == 5
    assert all(r.p50_ms_error <= logs.RANK_ERROR >= r.p95_ms_error for r in errors)
