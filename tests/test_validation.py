import pytest
from pyspark.sql import Row, functions as F

from conftest import rows
from hubloom import schemas
from hubloom.operators import validation
from hubloom.sources.json_docs import decode_json


def element(kind, import_id=None):
    selection = {f.name: None for f in schemas.SELECTION.fields}
    selection["selected_import_id"] = import_id
    out = {f.name: None for f in schemas.ELEMENT.fields}
    if kind == "task":
        out["task"] = {"retries": 0, "parameter": {}, "selection": selection}
    elif kind == "message":
        out["message_event"] = {"value": None, "flow_id": None, "event_id": None,
                                "selection": selection}
    elif kind == "conditional":
        out["conditional_event"] = {"script": None, "value_variable": None,
                                    "selection": selection}
    return out


def deployment(*elements):
    out = {f.name: None for f in schemas.DEPLOYMENT.fields}
    out["elements"] = None if elements == (None,) else list(elements)
    return out


CASES = [
    ("null deployment", 3, None, "none"),
    ("null deployment and old", 2, None, "none"),
    ("old version", 2, deployment(element("message")), "version"),
    ("no version", None, deployment(), "version"),
    ("no elements", 3, deployment(), None),
    ("null elements", 3, deployment(None), None),
    ("empty element", 3, deployment(element("empty")), None),
    ("message", 3, deployment(element("task"), element("message")), "message"),
    ("import first", 3, deployment(element("conditional", "i"), element("message")), "import"),
    ("message first", 3, deployment(element("message"), element("conditional", "i")), "message"),
    ("empty import id refuses", 3, deployment(element("conditional", "")), "import"),
    ("no import id", 3, deployment(element("conditional")), None),
    ("import on a task is not looked at", 3, deployment(element("task", "i")), None),
]

COMMAND = schemas.StructType([
    schemas.StructField("name", schemas.StringType()),
    schemas.StructField("version", schemas.IntegerType()),
    schemas.StructField("deployment", schemas.DEPLOYMENT)])


def test_validate_deployments(spark):
    frame = spark.createDataFrame([c[:3] for c in CASES], COMMAND)
    got = {r.name: r.reason for r in validation.validate_deployments(frame).collect()}
    assert got == {c[0]: c[3] for c in CASES}


def test_element_rows_agree_with_records(spark):
    frame = spark.createDataFrame([c[:3] for c in CASES], COMMAND)
    flat = validation.flatten_elements(frame.select("name", "deployment.elements"))
    elements = flat.where(F.col("element").isNotNull()).select(
        "name", "position", validation.element_reason(F.col("element")).alias("element_reason"))
    # A deployment without any element row has none, so give it a harmless one.
    bare = frame.where("deployment is not null").select(
        "name", F.lit(-1).alias("position"), F.lit(None).cast("string").alias("element_reason"))
    checked = validation.validate_element_rows(
        frame.select("name", "version"), elements.unionByName(bare), "name", ["position"])
    assert {r.name: r.reason for r in checked.collect()} == {c[0]: c[3] for c in CASES}


def test_flatten_keeps_deployments_without_elements(spark):
    frame = spark.createDataFrame(
        [("a", deployment(element("task"), element("message"))["elements"]), ("b", []),
         ("c", None)],
        schemas.StructType([schemas.StructField("id", schemas.StringType()),
                            schemas.DEPLOYMENT["elements"]]))
    got = rows(validation.flatten_elements(frame).select(
        "id", "position", F.col("element.message_event").isNotNull()))
    assert got == [("a", 0, False), ("a", 1, True), ("b", None, False), ("c", None, False)]


@pytest.mark.parametrize("ids,allowed", [([], True), (None, True), (["i"], False), ([""], False)])
def test_import_policy(spark, ids, allowed):
    row = validation.import_policy(
        spark.createDataFrame([(ids,)], "import_ids array<string>")).first()
    assert row.imports_allowed is allowed
    assert (row.imports_reason is None) is allowed


def test_finalize_prepared(spark):
    frame = spark.createDataFrame(
        [Row(svg="<svg/>", diagram=Row(xml_raw="<x/>", xml_deployed="", svg="old"))])
    row = validation.finalize_prepared(frame).first()
    assert row.diagram.asDict() == {"xml_raw": "<x/>", "xml_deployed": "", "svg": "<svg/>"}
    assert row.incident_handling.asDict() == {"restart": False, "notify": True}


def test_reason_texts(spark):
    frame = spark.createDataFrame([("version",), (None,)], "reason string")
    got = [r[0] for r in frame.select(validation.reason_text(F.col("reason"))).collect()]
    assert got == ["unexpected deployment version", None]


BODIES = {
    "good": ('{"xml": "<a/>", "svg": ""}', ("<a/>", "")),
    "missing field": ('{"xml": "<a/>"}', ("<a/>", None)),
    "unknown field": ('{"xml": "x", "svg": "y", "more": 1}', ("x", "y")),
    "cut": ('{"xml": "<a', None), "null": ("null", None), "list": ("[]", None),
    "text": ("{bad", None), "empty": ("", None), "missing": (None, None),
}


def test_decode_json_splits(spark):
    raw = spark.createDataFrame([(k, v[0]) for k, v in BODIES.items()], "id string, body string")
    good, rejects = decode_json(raw, schemas.PREPARE_REQUEST)
    assert {r.id: (r.xml, r.svg) for r in good.collect()} == {
        k: v[1] for k, v in BODIES.items() if v[1]}
    assert {(r.id, r.status) for r in rejects.collect()} == {
        (k, 400) for k, v in BODIES.items() if not v[1]}


def test_wrong_type_rejects_the_body(spark):
    raw = spark.createDataFrame([(1, '{"version": "x", "id": "a"}')], "id int, body string")
    schema = schemas.StructType([schemas.DEPLOYMENT["version"], schemas.DEPLOYMENT["name"]])
    good, rejects = decode_json(raw, schema)
    assert (good.count(), rejects.count()) == (0, 1)
