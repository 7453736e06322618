"""Fleet tables derived from the sales, event and page tables at hand.

| fleet table | built from |
| --- | --- |
| hub members | local ids of parts a supplier shipped on `F` lines, by owner |
| hub records | suppliers, with the same local ids as a list |
| devices | parts, two of which share a local id; type = brand and type |
| services | one per type and size band, with two functions and aspects |
| elements | line items: `A` task, `N` conditional event, `R` message event |
| deployment records | orders, with three elements told by status and priority |
| process models | an XML text per part |
| permissions | parts a customer has on `F` orders, of two kinds, some denied |
| sync rows, outcomes, messages | events; network = user |
| request log | pages |

Every mapping is a projection, a filter by value or an equi-join, so its work
grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hubloom import schemas

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"]
DEPLOYMENTS_PER_NETWORK = 20
BROKEN_ABOVE_SIZE = 40
GARBLED_UP_TO_SIZE = 5
LEVELS = 9
LARGE_ABOVE = 45
#: Payloads that say nothing of a task, by the size of the `ECONOMY` part that has them.
SHAPELESS = ("123", "[]", "null", '{"function": "x"}', '{"aspect": {"id": 7}}')
CROSSED_FROM_SIZE = 48


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.DRIVER_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows over all tasks, for narrow rows of few file splits that long texts are made of.

    A number of partitions that is given is not merged by adaptive execution, which looks
    at the size of the rows as they are. The hash keeps joins on the key as they are.
    """
    spark = rows.sparkSession
    return rows.repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(key))


def size_band() -> Column:
    return F.expr("cast((p_size - 1) div 10 as string)")


def _device_type_id() -> Column:
    return F.concat_ws("/", "p_brand", "p_type")


# --- hubs and devices -------------------------------------------------------

def local_id(part: str) -> Column:
    """Two parts share a local id; they have different owners."""
    return F.expr(f"{part} div 2").alias("local_id")


def owner_id(key: str) -> Column:
    return (F.col(key) % 2).alias("owner_id")


def hub_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (load(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == "F")
            .select(F.col("l_suppkey").alias("hub_id"), local_id("l_partkey"),
                    owner_id("l_suppkey")))


def hub_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in credit as hub records; the others are not registered.

    A hub lists the parts it shipped on `F` lines, so the lists are of all
    sizes; a supplier without such lines has none.
    """
    listed = (hub_members(spark, sf_dir).select("hub_id", "local_id").distinct().groupBy("hub_id")
              .agg(F.sort_array(F.collect_list("local_id")).alias("local_ids")))
    none = F.array().cast("array<bigint>")
    return (load(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= 0)
            .join(listed, F.col("s_suppkey") == F.col("hub_id"), "left").select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"),
        F.md5(F.col("s_name").cast("binary")).alias("hash"),
        F.coalesce("local_ids", none).cast("array<string>").alias("device_local_ids")))


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        local_id("p_partkey"), owner_id("p_partkey"), F.col("p_partkey").alias("device_id"),
        F.col("p_name").alias("device_name"), _device_type_id().alias("device_type_id"))


def _second_function() -> Column:
    """A function that types of all brands share."""
    return F.concat_ws("-", F.lit("fn"), size_band(), "p_type")


def _second_aspect() -> Column:
    """An aspect that types of one brand share."""
    return F.concat_ws("-", F.lit("area"), size_band(), "p_brand")


def services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A service per device type and size band. The brand is a function of it and the
    band an aspect; it has another one of both."""
    return (load(spark, sf_dir, "part")
            .select(_device_type_id().alias("device_type_id"),
                    F.col("p_type").alias("device_class_id"), "p_brand",
                    size_band().alias("band"), _second_function().alias("function"),
                    _second_aspect().alias("aspect")).distinct()
            .select("device_type_id", "device_class_id",
                    F.concat(F.lit("service-"), "band").alias("service_id"),
                    F.concat_ws(" ", "p_brand", "band").alias("service_name"),
                    F.array("p_brand", "function").alias("function_ids"),
                    F.array("band", "aspect").alias("aspect_ids")))


# --- deployments as rows ----------------------------------------------------

def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One create command per order."""
    old = F.col("o_orderpriority") == "5-LOW"
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("deployment_id"), F.col("o_custkey").alias("user_id"),
        F.when(old, F.lit(2)).otherwise(F.lit(3)).alias("version"))


def element_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements with what the validation looks at."""
    flag = F.col("l_returnflag")
    reason = F.when(flag == "R", F.lit("message")).when(
        (flag == "N") & (F.col("l_linestatus") == "O"), F.lit("import"))
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("deployment_id"), *LINE_ORDER,
        reason.alias("element_reason"))


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements with their hub and criteria.

    The criteria come from the part: brand as function, type as class, and on
    `O` lines the size band as aspect. Untaxed lines leave the function open and
    undiscounted ones the class; large ones ask for the second function and aspect.
    """
    parts = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", size_band().alias("band"),
        _second_function().alias("function"), _second_aspect().alias("aspect"))
    large = F.col("l_quantity") > LARGE_ABOVE
    kind, status = F.col("l_returnflag"), F.col("l_linestatus")
    return load(spark, sf_dir, "lineitem").join(parts, "l_partkey").select(
        F.col("l_orderkey").alias("deployment_id"), *LINE_ORDER,
        F.col("l_suppkey").alias("hub_id"),
        (kind == "A").alias("is_task"), (kind == "N").alias("is_event"),
        F.when(F.col("l_tax") > 0, F.when(large, F.col("function")).otherwise(
            F.col("p_brand"))).alias("function_id"),
        F.when(F.col("l_discount") > 0, F.col("p_type")).alias("device_class_id"),
        F.when(status == "O", F.when(large, F.col("aspect")).otherwise(
            F.col("band"))).alias("aspect_id"),
        F.concat(F.lit("characteristic-"), "band").alias("characteristic_id"))


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return elements(spark, sf_dir).where("is_task")


# --- deployments as records -------------------------------------------------

def _null(kind) -> Column:
    return F.lit(None).cast(kind)


def _selection(**given: Column) -> Column:
    return F.struct(*(
        given.get(f.name, _null(f.dataType)).alias(f.name) for f in schemas.SELECTION.fields))


def _element(bpmn_id: str, **given: Column) -> Column:
    given = {"bpmn_id": F.concat(F.lit(f"{bpmn_id}_"), "o_orderkey"), **given}
    return F.struct(*(
        given.get(f.name, _null(f.dataType)).alias(f.name) for f in schemas.ELEMENT.fields))


def _conditional(import_id: Column) -> Column:
    return F.struct(F.lit("x > 0").alias("script"), F.lit("x").alias("value_variable"),
                    _selection(selected_import_id=import_id).alias("selection"))


def _message() -> Column:
    return F.struct(F.lit("v").alias("value"), F.lit("f").alias("flow_id"),
                    F.lit("e").alias("event_id"), _selection().alias("selection"))


def _orders_as_deployments(orders: DataFrame) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    device = F.col("o_custkey").cast("string")
    task = _element("Task", name=priority, order=F.lit(0).cast("bigint"), task=F.struct(
        F.lit(0).cast("bigint").alias("retries"),
        F.create_map(F.lit("inputs"), F.lit("0")).alias("parameter"),
        _selection(
            selected_import_id=F.when((status == "F") & (priority == "3-MEDIUM"),
                                      F.lit("import-0")),
            filter_criteria=F.struct(
                _null("string").alias("characteristic_id"), priority.alias("function_id"),
                status.alias("device_class_id"), _null("string").alias("aspect_id")),
            selected_device_id=device, selected_service_id=priority).alias("selection")))
    by_status = _element(
        "Status", name=status, order=F.lit(1).cast("bigint"),
        message_event=F.when(status == "P", _message()),
        conditional_event=F.when(status == "O", _conditional(F.lit(""))).when(
            status == "F", _conditional(_null("string"))))
    by_priority = _element(
        "Priority", name=priority, order=F.lit(2).cast("bigint"),
        message_event=F.when(priority == "1-URGENT", _message()),
        conditional_event=F.when(priority == "2-HIGH", _conditional(F.lit("import-1"))))
    listed = F.when((status == "O") & (priority == "3-MEDIUM"),
                    F.array().cast(schemas.DEPLOYMENT["elements"].dataType)).when(
        F.col("o_totalprice") > 250000, F.array(task, by_priority, by_status)).otherwise(
        F.array(task, by_status, by_priority))
    given = {
        "version": F.when(priority == "5-LOW", F.lit(2)).otherwise(F.lit(3)),
        "id": F.col("o_orderkey").cast("string"),
        "name": F.concat(F.lit("deployment "), "o_orderkey"),
        "description": F.lit(""),
        "diagram": F.struct(F.lit("<raw/>").alias("xml_raw"), F.lit("").alias("xml_deployed"),
                            F.lit("").alias("svg")),
        "elements": listed,
        "executable": F.lit(False),
        "incident_handling": F.struct(F.lit(True).alias("restart"), F.lit(False).alias("notify")),
    }
    fields = [given[f.name].alias(f.name) for f in schemas.DEPLOYMENT.fields]
    missing = (status == "F") & (priority == "4-NOT SPECIFIED")
    return orders.select(
        F.col("o_orderkey").alias("request_id"), F.col("o_custkey").alias("user_id"),
        given["version"].alias("version"),
        F.when(~missing, F.struct(*fields)).alias("deployment"))


def deployment_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create commands `request_id, user_id, version, deployment`."""
    return _orders_as_deployments(load(spark, sf_dir, "orders"))


def command_bodies(orders: DataFrame, bare: bool = False) -> DataFrame:
    """The same commands as JSON text, or their bare deployments; those of partly
    filled urgent orders are cut off before their closing braces."""
    records = _orders_as_deployments(orders)
    none = F.struct(F.col("version").alias("version"))
    body = F.to_json(F.struct("version", "deployment")) if not bare else F.coalesce(
        F.to_json("deployment"), F.to_json(none))
    cut = F.get("deployment.elements", F.lit(0))["name"] == "1-URGENT"
    partly = F.exists("deployment.elements", lambda e: e["name"] == "P")
    text = F.when(cut & partly, F.rtrim(body, F.lit("}"))).otherwise(body)
    return records.select("request_id", "user_id", text.alias("body"))


# --- process models ---------------------------------------------------------

def _task_xml(number: int, name: Column, payload: Column | None) -> Column:
    """A task; its input `inputs` comes twice, of which the first counts."""
    def parameter(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'<camunda:inputParameter name="{name}">'), value,
                        F.lit("</camunda:inputParameter>"))
    params = [parameter("inputs", F.col("p_size").cast("string")),
              parameter("inputs", F.lit("again"))]
    if payload is not None:
        params.insert(0, parameter("payload", payload))
    return F.concat(
        F.lit('<bpmn:serviceTask id="Task_'), "p_partkey", F.lit(f'_{number}" name="'), name,
        F.lit('" camunda:type="external" camunda:topic="field-job">'
              "<bpmn:extensionElements><camunda:inputOutput>"),
        *params,
        F.lit("</camunda:inputOutput></bpmn:extensionElements></bpmn:serviceTask>"))


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def _at_depth(depth: Column, inner: Column) -> Column:
    """`inner` within that many containers, of three kinds in turn, behind text that
    only looks like tags."""
    kinds = [("subProcess", "transaction", "adHocSubProcess")[k % 3] for k in range(LEVELS)]
    opening = F.array(*(F.lit(f'<bpmn:{kind} id="Sub_{k}">') for k, kind in enumerate(kinds)))
    closing = F.array(*(F.lit(f"</bpmn:{kind}>") for kind in kinds))
    verbatim = F.lit('<bpmn:documentation><![CDATA[<bpmn:subProcess id="no"> & <bpmn:serviceTask '
                     'id="no"/>]]></bpmn:documentation><!-- </bpmn:transaction> -->')
    return F.concat(F.array_join(F.slice(opening, 1, depth), ""), verbatim, inner,
                    F.array_join(F.reverse(F.slice(closing, 1, depth)), ""))


def process_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An XML text per part: a task, for `SMALL` a second one in up to nine
    containers by size, for `MEDIUM` one without payload. Large `PROMO` texts
    break off; the payloads of the smallest `LARGE` ones are no JSON and those of the
    smallest `ECONOMY` ones say nothing; containers of the largest `STANDARD` ones cross."""
    first = F.concat(
        F.lit('{"function": {"id": '), _quoted(F.col("p_brand")),
        F.lit('}, "device_class": {"id": '), _quoted(F.col("p_type")),
        F.lit('}, "aspect": null, "characteristic_id": '), _quoted(size_band()),
        F.lit(', "input": 0, "retries": '), F.col("p_size").cast("string"),
        F.when((F.col("p_type") == "LARGE") & (F.col("p_size") <= GARBLED_UP_TO_SIZE),
               F.lit("")).otherwise(F.lit("}")))
    shapeless = F.get(F.array(*map(F.lit, SHAPELESS)), F.col("p_size") - 1)
    first = F.when(F.col("p_type") == "ECONOMY", F.coalesce(shapeless, first)).otherwise(first)
    second = F.concat(
        F.lit('{"function": {"id": '), _quoted(F.col("p_brand")),
        F.lit('}, "device_class": null, "aspect": {"id": '), _quoted(size_band()),
        F.lit('}, "characteristic_id": "c", "retries": 0}'))
    extra = F.when(F.col("p_type") == "SMALL", _at_depth(
        F.col("p_size") % (LEVELS + 1), _task_xml(1, F.lit("inner"), second))).when(
        F.col("p_type") == "MEDIUM", _task_xml(2, F.lit("plain"), None)).when(
        (F.col("p_type") == "STANDARD") & (F.col("p_size") >= CROSSED_FROM_SIZE), F.lit(
            '<bpmn:subProcess id="a"><bpmn:transaction id="b"></bpmn:subProcess>'
            "</bpmn:transaction>")).otherwise(F.lit(""))
    broken = (F.col("p_type") == "PROMO") & (F.col("p_size") > BROKEN_ABOVE_SIZE)
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>'
              '<bpmn:definitions xmlns:bpmn="http://www.omg.org/spec/BPMN/20100524/MODEL" '
              'xmlns:camunda="http://camunda.org/schema/1.0/bpmn" id="defs">'
              '<bpmn:process id="process" isExecutable="true"><bpmn:startEvent id="Start"/>'),
        _task_xml(0, F.col("p_name"), first), extra,
        F.when(broken, F.lit("")).otherwise(F.lit("</bpmn:process>")),
        F.lit("</bpmn:definitions>"))
    return _spread(load(spark, sf_dir, "part"), "p_partkey").select(
        F.col("p_partkey").alias("model_id"), xml.alias("bpmn_xml"),
        F.concat(F.lit("<svg>"), "p_name", F.lit("</svg>")).alias("svg_xml"))


def posted_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models posted to each hub that shipped them on untaxed lines; bodies of
    `LARGE` models of the biggest size lack their closing brace."""
    body = F.to_json(F.struct(F.col("bpmn_xml").alias("xml"), F.col("svg_xml").alias("svg")))
    sizes = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("model_id"),
        ((F.col("p_type") == "LARGE") & (F.col("p_size") == 50)).alias("cut"))
    models = process_models(spark, sf_dir).join(sizes, "model_id").select(
        "model_id", F.when(F.col("cut"), F.rtrim(body, F.lit("}"))).otherwise(body).alias("body"))
    posts = load(spark, sf_dir, "lineitem").where(F.col("l_tax") == 0).select(
        _request_id(), F.col("l_suppkey").alias("hub_id"), F.col("l_partkey").alias("model_id"))
    return posts.join(models, "model_id").select("request_id", "hub_id", "body")


def _request_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
        "request_id")


def prepare_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model asked for on a hub by each `O` line; untaxed lines ask for one
    that does not exist."""
    asked = F.when(F.col("l_tax") == 0, -1 - F.col("l_partkey")).otherwise(F.col("l_partkey"))
    return load(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == "O").select(
        _request_id(), F.col("l_suppkey").alias("hub_id"), asked.alias("model_id"))


def user_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same requests by the customers whose orders they are on."""
    customers = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("__order"), F.col("o_custkey").alias("user_id"))
    requests = prepare_requests(spark, sf_dir).withColumn(
        "__order", F.substring_index("request_id", "-", 1))
    return requests.join(customers, "__order").drop("__order")


def known_hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (load(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= 0)
            .select(F.col("s_suppkey").alias("hub_id")))


# --- rights -----------------------------------------------------------------

def _order_parts(spark: SparkSession, sf_dir: str, only_filled: bool) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    if only_filled:
        orders = orders.where(F.col("o_orderstatus") == "F")
    return load(spark, sf_dir, "lineitem").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.lit("devices").alias("kind"),
        F.col("l_partkey").alias("id"), "l_orderkey", "l_linestatus", "l_linenumber", "l_tax")


def device_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices each deployment selects: the parts of its order."""
    return _order_parts(spark, sf_dir, False).select(
        F.col("l_orderkey").alias("request_id"), "user_id", "kind", "id")


def permissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users may execute the parts on their `F` orders, unless it was an `O`
    line, which only grants reading, or an untaxed one, which grants nothing. Every
    fifth line grants a right on a location of that number."""
    return _order_parts(spark, sf_dir, True).select(
        "user_id", F.when(F.col("l_linenumber") % 5 == 0, F.lit("locations")).otherwise(
            F.col("kind")).alias("kind"), "id",
        F.when(F.col("l_linestatus") == "F", F.lit("x")).otherwise(F.lit("r")).alias("right"),
        (F.col("l_tax") > 0).alias("allowed"))


# --- sync state, outcomes, messages -----------------------------------------

def sync_rows(events: DataFrame) -> DataFrame:
    """Events as sync rows; `engine_id` is the event."""
    return events.select(
        F.col("user_id").alias("network_id"),
        (F.col("event_id") % DEPLOYMENTS_PER_NETWORK).alias("deployment_id"),
        F.col("event_id").alias("engine_id"), F.col("event_id").alias("seq"),
        (F.col("event_type") == "view").alias("is_placeholder"),
        (F.col("event_type") == "signup").alias("marked_for_delete"),
        F.col("ts").alias("sync_date"))


def sync_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync_rows(load(spark, sf_dir, "events"))


def engine_sync_rows(events: DataFrame) -> DataFrame:
    """Events as repeated reports of one engine deployment per event type."""
    return events.select(
        F.col("user_id").alias("network_id"), F.col("event_type").alias("engine_id"),
        F.col("event_id").alias("seq"), F.col("ts").alias("sync_date"),
        F.col("props").alias("deployment_model"))


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as process instances; expensive ones have ended. Those of odd
    number run on networks that report nothing else."""
    network = F.when(F.col("event_id") % 2 == 1, -1 - F.col("user_id")).otherwise(F.col("user_id"))
    return load(spark, sf_dir, "events").select(
        network.alias("network_id"), (F.col("value") > 10).alias("ended"))


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One action per customer, ten to a network; it may hit no, one or many
    metadata rows."""
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("action_id"), F.expr("c_custkey div 10").alias("network_id"),
        F.col("c_nationkey").cast("bigint").alias("deployment_id"),
        F.col("c_mktsegment").alias("segment"))


def outcomes(events: DataFrame) -> DataFrame:
    """Events as answers to commands: an action is one network and day."""
    failed = F.col("event_type") == "error"
    return events.select(
        F.col("user_id").alias("network_id"), F.to_date("ts").alias("day"),
        F.col("event_id").alias("seq"),
        F.when(failed, F.lit(500)).otherwise(F.lit(200)).alias("status"),
        F.when(failed, F.col("props")).otherwise(F.lit("true")).alias("body"))


def parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three process parameters per event, one of them of the wrong type."""
    def variable(value: Column, declared: str) -> Column:
        return F.struct(value.alias("value"), F.lit(declared).alias("type"),
                        F.lit(None).cast("variant").alias("valueInfo"))

    k = F.variant_get(F.parse_json("props"), "$.k", "variant")
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("network_id"), F.col("event_id").alias("engine_id"),
        F.create_map(
            F.lit("k"), variable(k, "Long"),
            F.lit("kind"), variable(F.col("event_type").cast("variant"), "String"),
            F.lit("bad"), variable(F.col("event_type").cast("variant"), "Double"),
        ).alias("process_parameter"))


# --- logs -------------------------------------------------------------------

def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as logged requests: host as path, page number as arrival."""
    return load(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("path"),
        F.col("page_id").alias("seq"), F.col("html").alias("body"))


def latency_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("hub_id"), F.col("value").alias("ms"))


# --- records as services store them -----------------------------------------

def stored_records(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Rows of the record tables by name, as far as the tables at hand fill them."""
    parts, events = load(spark, sf_dir, "part"), load(spark, sf_dir, "events")
    part, event = F.col("p_partkey").cast("string"), F.col("event_id").cast("string")
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    network = F.col("user_id").cast("string").alias("network_id")
    reported = [network, (F.col("event_type") == "view").alias("is_placeholder"),
                (F.col("event_type") == "signup").alias("marked_for_delete"),
                at.alias("sync_date")]
    service = F.struct(
        F.col("service_id").alias("id"), F.col("service_name").alias("name"), "function_ids",
        "aspect_ids")
    return {
        "devices": parts.select(
            part.alias("id"), F.concat(F.lit("local "), part).alias("local_id"),
            F.col("p_name").alias("name"), _device_type_id().alias("device_type_id")),
        "device_types": services(spark, sf_dir).groupBy(
            F.col("device_type_id").alias("id"), "device_class_id").agg(
            F.sort_array(F.collect_list(service)).alias("services")),
        "services": services(spark, sf_dir).select(
            F.concat_ws("/", "device_type_id", "service_id").alias("id"),
            F.col("service_name").alias("name"), "function_ids", "aspect_ids"),
        "process_models": parts.select(
            part.alias("_id"), F.col("p_name").alias("name"),
            F.col("p_size").cast("bigint").alias("date"), F.col("p_brand").alias("owner"),
            F.concat(F.lit("<svg>"), "p_name", F.lit("</svg>")).alias("svgXML"),
            (F.col("p_size") > 25).alias("publish")),
        "permissions": permissions(spark, sf_dir).select(
            F.col("user_id").cast("string").alias("user_id"), "kind",
            F.col("id").cast("string").alias("id"), "right", "allowed").distinct(),
        "deployments": deployment_records(spark, sf_dir).where(
            F.col("deployment").isNotNull()).select("deployment.*"),
        "sync_metadata": events.select(
            event.alias("camunda_deployment_id"), *reported, F.struct(F.concat(
                F.lit("deployment "), F.col("event_id") % DEPLOYMENTS_PER_NETWORK).alias("id"))
            .alias("deployment_model")),
        "process_instances": events.select(
            event.alias("id"), F.col("event_type").alias("businessKey"),
            (F.col("value") > 10).alias("ended"), *reported),
        "historic_process_instances": events.select(
            event.alias("id"), F.col("value").alias("durationInMillis"),
            F.col("event_type").alias("state"), *reported),
        "topic_messages": events.select(
            F.col("event_type").alias("topic"), F.col("props").alias("payload"), at.alias("ts")),
    }
