"""Process models: lookup by id and the tasks written in their XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

PAYLOAD = "payload"
CORRUPT = "_corrupt"

_TASK = (
    "array<struct<_id:string,_name:string,_topic:string,"
    "extensionElements:struct<inputOutput:struct<"
    "inputParameter:array<struct<_name:string,_VALUE:string>>>>>>"
)
_TASKS = f"struct<process:array<struct<_id:string,serviceTask:{_TASK}>>,{CORRUPT}:string>"
_IDS = f"struct<process:array<struct<_id:string>>,{CORRUPT}:string>"
_READING = {"mode": "PERMISSIVE", "ignoreNamespace": "true",
            "columnNameOfCorruptRecord": CORRUPT, "rowTag": "definitions"}

# Text that may look like tags: comments, CDATA and processing instructions.
_VERBATIM = r"<!--(?s:.*?)-->|<!\[CDATA\[(?s:.*?)\]\]>|<\?(?s:.*?)\?>"
_ATTRIBUTES = r"(?:\s(?:[^>\"'/]++|/(?!>)|\"[^\"]*+\"|'[^']*+')*+)?"
# Tags of the elements that hold tasks of their own, and start tags of tasks.
_HOLDERS = "subProcess|transaction|adHocSubProcess"
_CONTAINER = rf"</?(?:[A-Za-z_][\w.-]*:)?(?:{_HOLDERS}){_ATTRIBUTES}\s*/?>"
_TASK_TAG = rf"<(?:[A-Za-z_][\w.-]*:)?serviceTask{_ATTRIBUTES}\s*/?>"
_ID = (r"^<[^\s/>]+(?:\s+(?!id\s*=)[^\s=]+\s*=\s*(?:\"[^\"]*+\"|'[^']*+'))*+"
       r"\s+id\s*=\s*[\"']([^\"']*)")


def _without_containers(xml: Column) -> Column:
    """The text without the tags of containers, but for those in verbatim text."""
    return F.regexp_replace(xml, F.lit(f"({_VERBATIM})|{_CONTAINER}"), F.lit("$1"))


def _places(xml: Column) -> Column:
    """`id, containers` of each task tag: the ids of the containers around it, outermost
    first. Tags are taken in document order with a stack of the open containers.
    """
    tags = F.regexp_extract_all(
        xml, F.lit(f"({_VERBATIM}|{_CONTAINER}|{_TASK_TAG})"), F.lit(1))
    tag_id = lambda t: F.regexp_extract(t, _ID, 1)
    names = F.array().cast("array<string>")
    start = F.struct(names.alias("open"), F.array().cast(
        "array<struct<id:string,containers:array<string>>>").alias("places"))

    def step(state: Column, tag: Column) -> Column:
        alone, task = tag.endswith("/>"), F.regexp_like(tag, F.lit("^<[^/\\s>]*serviceTask"))
        stack = (F.when(tag.startswith("<!") | tag.startswith("<?") | alone | task, state["open"])
                 .when(tag.startswith("</"), F.slice(
                     state["open"], 1, F.greatest(F.size(state["open"]) - 1, F.lit(0))))
                 .otherwise(F.concat(state["open"], F.array(tag_id(tag)))))
        places = F.when(task, F.concat(state["places"], F.array(F.struct(
            tag_id(tag).alias("id"), state["open"].alias("containers"))))).otherwise(
            state["places"])
        return F.struct(stack.alias("open"), places.alias("places"))
    return F.aggregate(tags, start, step)["places"]


def _tasks_of_all_levels(xml: Column) -> Column:
    """The document with the tags of its containers taken out, parsed.

    What they hold then belongs to the process, so tasks are found at any depth,
    in document order. Taking tags out could hide that they do not match, so a
    document with containers is also parsed as it is.
    """
    flat = F.from_xml(_without_containers(xml), _TASKS, _READING)
    as_it_is = F.from_xml(F.when(F.regexp_like(xml, F.lit(_CONTAINER)), xml), _IDS, _READING)
    return F.when(as_it_is[CORRUPT].isNull(), flat)


def _is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT<")


def _understood(parsed: Column) -> Column:
    """Whether a parsed payload says what its task asks for: an object whose criteria are
    null, absent, or objects with a text as `id`. A blank criterion means no constraint, so
    one that is misread would match any device."""
    def given(name: str) -> Column:
        value = F.try_variant_get(parsed, f"$.{name}", "variant")
        ids = F.schema_of_variant(F.try_variant_get(parsed, f"$.{name}.id", "variant"))
        return (value.isNull() | F.is_variant_null(value)
                | F.coalesce(_is_object(value) & (ids == "STRING"), F.lit(False)))
    return F.coalesce(_is_object(parsed) & given("function") & given("device_class")
                      & given("aspect"), F.lit(False))


def model_lookup(requests: DataFrame, models: DataFrame) -> DataFrame:
    """Attach XML and SVG to prepare requests by model id; `status` is 404 for
    an unknown model."""
    joined = requests.join(
        models.select("model_id", "bpmn_xml", "svg_xml", F.lit(True).alias("__found")),
        "model_id", "left")
    found = F.col("__found").isNotNull()
    return joined.withColumn("status", F.when(found, F.lit(200)).otherwise(F.lit(404))
                             ).drop("__found")


def resolve_model(requests: DataFrame, models: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`model_lookup` split into `(resolved, rejects)`."""
    both = model_lookup(requests, models)
    return (both.where(F.col("status") == 200).drop("status"),
            both.where(F.col("status") != 200).drop("bpmn_xml", "svg_xml"))


def model_elements(models: DataFrame) -> DataFrame:
    """Tasks of `model_id, bpmn_xml` rows, read from the XML once.

    One row per service task that carries a payload, however deep it lies; a
    model without such a task keeps one row with a null position. `readable` is
    false for a document that cannot be read (`from_xml` puts it aside, where an
    `xpath` call on it would end the job) and for one with a payload that does not say
    what its task asks for. `containers` has the ids of the containers around a task,
    outermost first. Of input parameters with one name the first counts.
    """
    none = F.array().cast(_TASK)

    def params(task):
        listed = task["extensionElements"]["inputOutput"]["inputParameter"]
        return F.coalesce(listed, F.array().cast("array<struct<_name:string,_VALUE:string>>"))

    def payload(task):
        return F.get(F.filter(params(task), lambda p: p["_name"] == PAYLOAD), F.lit(0))["_VALUE"]

    parsed = models.select("model_id", _tasks_of_all_levels(F.col("bpmn_xml")).alias("parsed"),
                           F.when(F.regexp_like("bpmn_xml", F.lit(_CONTAINER)), _places(
                               F.col("bpmn_xml"))).alias("places"))
    tasks = F.flatten(F.transform(F.coalesce(F.col("parsed.process"), F.array().cast(
        f"array<struct<_id:string,serviceTask:{_TASK}>>")),
        lambda p: F.coalesce(p["serviceTask"], none)))
    listed = parsed.select(
        "model_id", "parsed", "places", F.filter(tasks, lambda t: F.exists(
            params(t), lambda p: p["_name"] == PAYLOAD)).alias("tasks"))
    # Parsed once each; within one lambda it would be for every look at it.
    payloads = F.transform("tasks", lambda t: F.try_parse_json(F.coalesce(payload(t), F.lit(""))))
    understood = ~F.exists(payloads, lambda p: ~_understood(p))
    rows = (listed.select(
        "model_id", (F.col("parsed").isNotNull() & F.col(f"parsed.{CORRUPT}").isNull()
                     & understood).alias("readable"),
        F.get("parsed.process", F.lit(0))["_id"].alias("process_id"), "tasks", "places")
            .select("model_id", "readable", "process_id", "places",
                    F.posexplode_outer(F.when(F.col("readable"), F.col("tasks")))
                    .alias("position", "task"))
            .withColumn("inputs", params(F.col("task")))
            .withColumn("payload", payload(F.col("task"))))

    def field(path: str):
        return F.get_json_object("payload", path)

    others = F.filter("inputs", lambda p: p["_name"].isNotNull() & (p["_name"] != PAYLOAD))
    names = F.transform(others, lambda p: p["_name"])
    firsts = F.filter(others, lambda p, i: F.array_position(names, p["_name"]) == i + 1)
    place = F.get(F.filter("places", lambda p: p["id"] == F.col("task._id")), F.lit(0))
    return rows.select(
        "model_id", "readable", "process_id", "position",
        F.col("task._id").alias("bpmn_id"),
        F.col("task._name").alias("name"),
        F.col("task._topic").alias("topic"),
        F.when(F.col("task").isNotNull(), F.coalesce(
            place["containers"], F.array().cast("array<string>"))).alias("containers"),
        field("$.function.id").alias("function_id"),
        field("$.device_class.id").alias("device_class_id"),
        field("$.aspect.id").alias("aspect_id"),
        field("$.characteristic_id").alias("characteristic_id"),
        F.coalesce(F.expr("try_cast(get_json_object(payload, '$.retries') as bigint)"),
                   F.lit(0)).alias("retries"),
        F.map_from_entries(F.transform(
            firsts, lambda p: F.struct(p["_name"], F.coalesce(p["_VALUE"], F.lit("")))),
        ).alias("parameter"))


def extract_elements(models: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Service tasks of `model_id, bpmn_xml` rows.

    Returns `(elements, rejects)`; models that cannot be read go to the rejects.
    """
    rows = model_elements(models)
    elements = rows.where(F.col("position").isNotNull()).drop("readable", "process_id")
    # A model that cannot be read has no position. Without it in the condition, that would be
    # moved below the reading and read each text again, once for every look at it.
    rejects = rows.where(F.when(F.col("position").isNull(), ~F.col("readable"))).select(
        "model_id", F.lit(500).alias("status"))
    return elements, rejects
