"""Selection against hand-made tables, golden values and brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from conftest import join_rows, rows
from hubloom import schemas
from hubloom.operators import selection
from hubloom.operators.skew import HOT_SHARE, hot_keys, key_counts, salted_join

HUBS = [
    ("hub-1", "test-hub", "hash", ["long-local-id-43", "2"]),
    ("hub-2", "empty", "hash", []),
    ("hub-3", "shares a device", "hash", ["2", "gone"]),
    ("hub-4", "null", "hash", None),
]


@pytest.fixture(scope="module")
def hubs(spark):
    return spark.createDataFrame(HUBS, schemas.HUB)


@pytest.fixture(scope="module")
def devices(spark):
    return spark.createDataFrame(
        [("long-local-id-43", "device-60", "radiator", "type-1"),
         ("2", "device-61", "second", "type-1"), ("9", "device-62", "elsewhere", "type-1")],
        "local_id string, device_id string, device_name string, device_type_id string")


def test_hub_list_replaces_what_a_request_carried(spark, hubs):
    requests = spark.createDataFrame(
        [("T1", "hub-1", ["old"]), ("T2", "hub-1", None), ("T3", "hub-2", None),
         ("T4", "hub-9", ["x"]), ("T5", "hub-4", None)],
        "id string, hub_id string, local_devices array<string>")
    attached, rejects = selection.attach_local_devices(requests, hubs)
    assert {r.id: r.local_devices for r in attached.collect()} == {
        "T1": ["long-local-id-43", "2"], "T2": ["long-local-id-43", "2"], "T3": [], "T5": []}
    assert rows(rejects.select("id", "status")) == [("T4", 500)]


def test_hub_devices(hubs, devices):
    got = selection.hub_devices(selection.hub_members(hubs), devices)
    assert rows(got.select("hub_id", "device_id")) == [
        ("hub-1", "device-60"), ("hub-1", "device-61"), ("hub-3", "device-61")]


def test_local_ids_that_owners_share(spark):
    members = spark.createDataFrame(
        [(f"h{i}", "2", f"o{i % 2}") for i in range(4)],
        "hub_id string, local_id string, owner_id string")
    devices = spark.createDataFrame(
        [(f"d{i}", "2", f"o{i}", "x", "t") for i in range(3)],
        "device_id string, local_id string, owner_id string, device_name string, "
        "device_type_id string")
    assert rows(selection.hub_devices(members, devices).select("hub_id", "device_id")) == [
        (f"h{i}", f"d{i % 2}") for i in range(4)]


def test_selection_request_golden(spark):
    """The aspect becomes "", the characteristic goes, groups follow the kind."""
    elements = spark.createDataFrame(
        [("hub-1", "Task_1", "fn", "class", None, "celsius", False),
         ("hub-1", "Event_1", "fn", None, "aspect", "celsius", True)],
        "hub_id string, bpmn_id string, function_id string, device_class_id string, "
        "aspect_id string, characteristic_id string, is_event boolean")
    first, second = selection.selection_requests(elements).orderBy(F.desc("id")).collect()
    assert first.asDict(recursive=True) == {
        "hub_id": "hub-1", "id": "Task_1",
        "criteria": [{"function_id": "fn", "device_class_id": "class", "aspect_id": ""}],
        "include_groups": True, "include_imports": False, "include_devices": True,
        "include_id_modified_devices": False}
    assert (second.id, second.include_groups, second.criteria[0].device_class_id) == (
        "Event_1", False, "")


def test_options_for_another_id_leave_null_options(spark):
    elements = spark.createDataFrame([("d", "Task_1", True)],
                                     "deployment_id string, id string, is_task boolean")
    answers = spark.createDataFrame([("bulk-id-1", 2)], "id string, n_options int")
    prepared = selection.attach_options(elements, answers, ["id"])
    assert prepared.first().n_options is None
    assert selection.executable_flag(prepared, ["deployment_id"]).first().executable is False


def test_executable_flag(spark):
    elements = spark.createDataFrame(
        [("all", True, 1), ("all", True, 3), ("all", False, None), ("one short", True, 1),
         ("one short", True, 0), ("null", True, None), ("no tasks", False, None)],
        "deployment_id string, is_task boolean, n_options int")
    got = selection.executable_flag(elements, ["deployment_id"])
    assert rows(got.select("deployment_id", "executable")) == [
        ("all", True), ("no tasks", True), ("null", False), ("one short", False)]


def test_type_services_unpacks_records(spark):
    service = {f.name: None for f in schemas.SERVICE.fields} | {
        "id": "s", "name": "set", "function_ids": ["f"], "aspect_ids": ["a", "b"]}
    types = spark.createDataFrame([("t", "type", "class", [service]), ("u", "bare", "class", [])],
                                  schemas.DEVICE_TYPE)
    assert [tuple(r) for r in selection.type_services(types).collect()] == [
        ("t", "class", "s", "set", ["f"], ["a", "b"])]


def make_fleet(seed, n_hubs=4, n_devices=60):
    rng = random.Random(seed)
    functions, classes, aspects = "fgh", "xyz", "abc"
    services = []
    for t in range(6):
        for s in range(rng.randint(0, 3)):
            services.append((f"t{t}", rng.choice(classes), f"s{t}{s}", f"name {s}",
                             rng.sample(functions, rng.randint(0, 2)),
                             rng.choice([None, rng.sample(aspects, rng.randint(0, 3))])))
    devices = [(f"l{i}", f"d{i:03}", f"device {i}", f"t{rng.randrange(6)}")
               for i in range(n_devices)]
    members = [(f"h{rng.choice([0, 0, 0, *range(n_hubs)])}", f"l{rng.randrange(n_devices + 5)}")
               for _ in range(150)]
    blank = [None, ""]
    requests = [
        (f"h{rng.randrange(n_hubs + 1)}", rng.choice([*functions, *blank]),
         rng.choice([*classes, *blank, *blank]), rng.choice([*aspects, *blank, *blank]))
        for _ in range(60)]
    return services, devices, members, requests


def brute_force(services, devices, members, requests):
    found = set()
    for hub, f, c, a in requests:
        for m_hub, local in members:
            for d_local, device, name, kind in devices:
                if m_hub != hub or d_local != local:
                    continue
                for s_kind, klass, service, s_name, functions, aspects in services:
                    if s_kind == kind and (not f or f in functions) and (
                            not c or c == klass) and (not a or a in (aspects or [])):
                        found.add((hub, f or "", c or "", a or "", device, name, service, s_name))
    return found


def frames(spark, services, devices, members, requests):
    return (
        spark.createDataFrame(services, "device_type_id string, device_class_id string, "
                              "service_id string, service_name string, "
                              "function_ids array<string>, aspect_ids array<string>"),
        spark.createDataFrame(devices, "local_id string, device_id string, device_name string, "
                              "device_type_id string"),
        spark.createDataFrame(members, "hub_id string, local_id string"),
        spark.createDataFrame(requests, "hub_id string, function_id string, "
                              "device_class_id string, aspect_id string"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_candidates_against_brute_force(spark, seed):
    data = make_fleet(seed)
    expected = brute_force(*data)
    services, devices, members, requests = frames(spark, *data)
    fleet = selection.hub_devices(members, devices)
    matched = selection.match_types(selection.criteria_counts(requests), fleet, services).cache()
    assert rows(selection.match_candidates(matched, fleet)) == sorted(expected)

    summary = {tuple(r)[:4]: tuple(r)[4:] for r in selection.option_summary(matched).collect()}
    by_key = {}
    for row in sorted(expected):
        by_key.setdefault(row[:4], []).append(row[4:])
    assert summary == {
        k: (len({d[0] for d in v}), v[0][0], min(d[2] for d in v if d[0] == v[0][0]))
        for k, v in by_key.items()}


@pytest.mark.parametrize("part_size", [1, 3, 1000])
def test_lists_are_whole_at_any_part_size(spark, part_size):
    data = make_fleet(7)
    services, devices, members, requests = frames(spark, *data)
    fleet = selection.hub_devices(members, devices)
    matched = selection.match_types(selection.criteria_counts(requests), fleet, services)
    lists = selection.assemble_selectables(
        selection.device_options(matched, fleet), part_size=part_size).collect()
    unpacked = [(*r[:4], o.device.id, o.device.name, s.id, s.name)
                for r in lists for o in r.selectables for s in o.services]
    assert sorted(unpacked) == sorted(brute_force(*data))
    parts = {}
    for r in sorted(lists, key=lambda r: r.part):
        assert 0 <= r.part < r.n_parts and len(r.selectables) <= part_size
        parts.setdefault(tuple(r[:4]), []).extend(o.device.id for o in r.selectables)
    assert all(listed == sorted(listed) for listed in parts.values())
    for r in lists:
        assert r.n_parts == -(-len(parts[tuple(r[:4])]) // part_size)


def test_default_option_order(spark):
    options = spark.createDataFrame(
        [("k", 2, "a", "s1"), ("k", 1, "b", "s2"), ("k", 1, "b", "s1"), ("j", 5, "c", "s9")],
        "key string, position int, device_id string, service_id string")
    got = selection.default_option(options, ["key"], ["position", "device_id", "service_id"])
    assert rows(got) == [("j", 5, "c", "s9"), ("k", 1, "b", "s1")]


def test_salted_join_equals_plain_join(spark):
    left = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 1500)).alias("k"), "id")
    right = spark.range(900).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"),
        F.col("id").alias("v"))
    hot = hot_keys(key_counts(left, ["k"]), ["k"])
    assert "hot" in {r.k for r in hot.collect()}
    for how, marks in itertools.product(("inner", "left", "left_semi", "left_anti"), (None, hot)):
        salted = salted_join(left, right, ["k"], how, hot=marks)
        assert rows(salted) == rows(left.join(right, ["k"], how)), (how, marks)
    with pytest.raises(ValueError):
        salted_join(left, right, ["k"], "full_outer")


def test_hot_keys_are_bounded(spark):
    rng = random.Random(5)
    counts = spark.createDataFrame(
        [(i, rng.choice([1, 1, 1, 5000])) for i in range(20000)], "k int, n_rows long")
    assert hot_keys(counts, ["k"]).count() < HOT_SHARE


# --- users

MEMBERS = "hub_id string, local_id string"
DEVICES = "device_id string, local_id string, device_name string, device_type_id string"
GRANTS = "user_id string, kind string, id string"
USERS = "hub_id string, user_id string"


def test_a_local_id_that_many_hubs_and_devices_share(spark):
    """Every owner asks for their own hub; no step meets all hubs with all devices."""
    n = 500
    members = spark.createDataFrame([(f"h{i}", "2") for i in range(n)], MEMBERS)
    devices = spark.createDataFrame([(f"d{i}", "2", "x", "t") for i in range(n)], DEVICES)
    grants = spark.createDataFrame([(f"u{i}", "devices", f"d{i}") for i in range(n)], GRANTS)
    users = spark.createDataFrame([(f"h{i}", f"u{i}") for i in range(n)], USERS)
    found = selection.user_devices(members, devices, grants, users)
    assert max(join_rows(found)) <= 2 * n
    assert rows(found.select("hub_id", "user_id", "device_id")) == sorted(
        (f"h{i}", f"u{i}", f"d{i}") for i in range(n))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_user_devices_against_brute_force(spark, seed):
    draw = random.Random(seed)
    pick = lambda letter, n: f"{letter}{min(draw.randrange(n), draw.randrange(n))}"
    members = [(pick("h", 9), pick("l", 6)) for _ in range(40)]
    devices = [(f"d{i}", pick("l", 8), "x", "t") for i in range(30)]
    grants = [(pick("u", 9), draw.choice(["devices", "devices", "locations"]), pick("d", 30))
              for _ in range(120)]
    users = [(pick("h", 10), pick("u", 10)) for _ in range(60)]
    want = {(h, u, d) for h, u in users for d, local, *_ in devices
            if (h, local) in members and (u, "devices", d) in grants}
    found = selection.user_devices(
        spark.createDataFrame(members, MEMBERS), spark.createDataFrame(devices, DEVICES),
        spark.createDataFrame(grants, GRANTS), spark.createDataFrame(users, USERS))
    assert rows(found.select("hub_id", "user_id", "device_id")) == sorted(want)

    asked = spark.createDataFrame(users, USERS)
    classes, fleet = selection.permission_classes(found, asked)
    of = {(r.hub_id, r.user_id): r.class_id for r in classes.collect()}
    assert set(of) == set(users)
    sets = {pair: frozenset(d for h, u, d in want if (h, u) == pair) for pair in of}
    for a, b in itertools.combinations(of, 2):
        if a[0] == b[0]:
            assert (of[a] == of[b]) == (sets[a] == sets[b])
    assert {(r.hub_id.hub_id, r.hub_id.class_id, r.device_id) for r in fleet.collect()} == {
        (*(h, of[h, u]), d) for h, u, d in want}
    assert fleet.count() == fleet.distinct().count()


def test_matches_follow_classes_not_users(spark):
    """Three hundred users of one hub hold one of two sets of devices, or none."""
    members = spark.createDataFrame([("h", f"l{i}") for i in range(10)], MEMBERS)
    devices = spark.createDataFrame([(f"d{i}", f"l{i}", "x", f"t{i}") for i in range(10)], DEVICES)
    grants = [(f"u{u}", "devices", f"d{i}") for u in range(300) for i in range(10)
              if (u % 3 == 0 and i < 4) or u % 3 == 1]
    users = spark.createDataFrame([("h", f"u{u}") for u in range(300)], USERS)
    services = spark.createDataFrame(
        [(f"t{i}", "c", "s", "s", ["f"], ["a"]) for i in range(10)],
        "device_type_id string, device_class_id string, service_id string, service_name string, "
        "function_ids array<string>, aspect_ids array<string>")
    usable = selection.user_devices(members, devices, spark.createDataFrame(grants, GRANTS), users)
    classes, fleet = selection.permission_classes(usable, users)
    requests = selection.for_classes(users.withColumns(
        {"function_id": F.lit("f"), "device_class_id": F.lit(""), "aspect_id": F.lit("a")}), classes)
    criteria = selection.criteria_counts(requests)
    assert {r.n_rows for r in criteria.collect()} == {100} and criteria.count() == 3
    assert selection.match_types(criteria, fleet, services).count() == 4 + 10


# --- leads

def test_the_rarest_criterion_leads(spark):
    """All types have the function, one the aspect, each its own class."""
    services = spark.createDataFrame(
        [(f"t{i}", f"c{i % 10}", "s", "s", ["common"], ["rare"] if i == 7 else [f"a{i % 2}"])
         for i in range(100)],
        "device_type_id string, device_class_id string, service_id string, service_name string, "
        "function_ids array<string>, aspect_ids array<string>")
    fleet = spark.createDataFrame([("h", f"d{i}", "x", f"t{i}") for i in range(100)],
                                  "hub_id string, device_id string, device_name string, "
                                  "device_type_id string")
    asked = [("common", "", "rare"), ("common", "c7", "a1"), ("common", "c7", "rare"),
             ("", "c7", "rare"), ("common", "", ""), ("common", "c7", "missing"), ("", "", "")]
    criteria = selection.criteria_counts(spark.createDataFrame(
        [("h", *a) for a in asked], "hub_id string, function_id string, device_class_id string, "
        "aspect_id string"))
    types = fleet.groupBy("hub_id", "device_type_id").agg(
        F.count(F.lit(1)).alias("n_devices"), F.min("device_id").alias("first_device_id"))
    met = {tuple(r)[:3]: r["count"] for r in selection.met_types(
        criteria, types, selection.offered_services(services)).groupBy(
        *selection.CRITERIA[1:]).count().collect()}
    assert met == {("common", "", "rare"): 1, ("common", "c7", "a1"): 10, ("common", "c7", "rare"): 1,
                   ("", "c7", "rare"): 1, ("common", "", ""): 100, ("", "", ""): 100}
    kept = selection.match_types(criteria, fleet, services)
    assert sum(met.values()) <= 2 * kept.count()


def test_pairs_before_the_other_criteria_follow_what_is_kept(spark, sf_dir):
    from hubloom.plans import queries
    from hubloom.sources import driver_tables as dt
    criteria, fleet = queries._criteria(spark, sf_dir), queries._fleet(spark, sf_dir)
    types = fleet.groupBy("hub_id", "device_type_id").agg(
        F.count(F.lit(1)).alias("n_devices"), F.min("device_id").alias("first_device_id"))
    met = selection.met_types(
        criteria, types, selection.offered_services(dt.services(spark, sf_dir))).count()
    kept = selection.match_types(criteria, fleet, dt.services(spark, sf_dir)).count()
    assert kept <= met <= 2 * kept


def test_types_are_not_posted_under_leads_that_nobody_takes(spark):
    """All types on all hubs have the function asked for, each its own class: what meets is
    one type a hub, and no join writes more than the smaller side of a lead."""
    services = spark.createDataFrame(
        [(f"t{i}", f"c{i}", "s", "s", ["common"], ["a"]) for i in range(100)],
        "device_type_id string, device_class_id string, service_id string, service_name string, "
        "function_ids array<string>, aspect_ids array<string>")
    types = spark.range(5000).select(
        F.expr("id div 100").alias("hub_id"),
        F.concat(F.lit("t"), F.col("id") % 100).alias("device_type_id"),
        F.lit(1).alias("n_devices"), F.lit("d").alias("first_device_id"))
    asked = [(h, "common", f"c{h}", "") for h in range(50)] + [(0, "common", "", "")]
    criteria = selection.criteria_counts(spark.createDataFrame(
        asked, "hub_id long, function_id string, device_class_id string, aspect_id string"))
    met = selection.met_types(criteria, types, selection.offered_services(services))
    assert met.count() == 150
    assert max(join_rows(met)) <= 300
