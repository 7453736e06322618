"""Which devices of which hub can run which task.

Requests that name the same hub and the same criteria have the same options.
Matching is therefore done once per distinct `(hub, function, class, aspect)`,
and requests look their options up by those four columns; the candidates of a
crowded hub are never written out once per request.

Whether a service fits depends on the device type alone, so the match runs on
`(hub, device type)` and devices come in last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hubloom.operators.skew import hot_keys, key_counts, list_parts, salted_join
from hubloom.session import keep

CRITERIA = ["hub_id", "function_id", "device_class_id", "aspect_id"]
PART_SIZE = 1000


def local_devices(requests: DataFrame, hubs: DataFrame) -> DataFrame:
    """Give every element of a request the local ids of its hub, in hub order,
    in place of any it carried.

    `status` is 200, or 500 for the requests of an unknown hub. This is the
    form for hub records; for hubs too large to be one record, keep members as
    rows and join them by hub.
    """
    listed = hubs.select(F.col("id").alias("hub_id"), F.lit(True).alias("__known"),
                         F.col("device_local_ids").alias("local_devices"))
    joined = requests.drop("local_devices").join(listed, "hub_id", "left")
    known = F.col("__known").isNotNull()
    none = F.array().cast("array<string>")
    return (joined
            .withColumn("local_devices", F.when(known, F.coalesce("local_devices", none)))
            .withColumn("status", F.when(known, F.lit(200)).otherwise(F.lit(500)))
            .drop("__known"))


def attach_local_devices(requests: DataFrame, hubs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`local_devices` split into `(attached, rejects)`."""
    both = local_devices(requests, hubs)
    return (both.where(F.col("status") == 200).drop("status"),
            both.where(F.col("status") != 200).drop("local_devices"))


def hub_members(hubs: DataFrame) -> DataFrame:
    """Hub records as `(hub_id, local_id)` rows."""
    return hubs.select(F.col("id").alias("hub_id"),
                       F.explode("device_local_ids").alias("local_id"))


def requested_hubs(hubs: DataFrame, requests: DataFrame) -> DataFrame:
    """Hub records that some request names.

    Worth its join when few hubs are asked for; a run over the whole fleet
    needs all of them anyway.
    """
    asked = requests.select(F.col("hub_id").alias("id")).distinct()
    return hubs.join(asked, "id", "left_semi")


def type_services(device_types: DataFrame) -> DataFrame:
    """Device type records as one row per service."""
    return device_types.select(
        F.col("id").alias("device_type_id"), "device_class_id",
        F.explode("services").alias("service"),
    ).select("device_type_id", "device_class_id",
             F.col("service.id").alias("service_id"),
             F.col("service.name").alias("service_name"),
             F.col("service.function_ids").alias("function_ids"),
             F.col("service.aspect_ids").alias("aspect_ids"))


def hub_devices(members: DataFrame, devices: DataFrame) -> DataFrame:
    """Devices whose local id a hub lists; a hub without local ids has none.

    Local ids are not unique across owners. Where both sides have an `owner_id`,
    a hub only has the devices of its owner.
    """
    on = ["local_id"] + ["owner_id"] * (
        "owner_id" in members.columns and "owner_id" in devices.columns)
    listed = members.select("hub_id", *on).distinct()
    return listed.join(devices, on).select(
        "hub_id", "device_id", "device_name", "device_type_id")


def user_devices(members: DataFrame, devices: DataFrame, grants: DataFrame,
                 users: DataFrame) -> DataFrame:
    """Devices of hubs that users may choose: `hub_id, user_id` and the device.

    `users` has the pairs of hub and user that are asked for, `grants` rows of
    `user_id, kind, id`. Many hubs may list a local id and many users hold devices of
    that id, so for each local id the cheaper side comes first: its hubs meet the
    devices, or, where that gives more pairs, the hubs that the devices' users ask for
    do and are then looked up in the lists. A step makes at most the smaller number.
    """
    held = grants.where(F.col("kind") == "devices").select(
        "user_id", F.col("id").alias("device_id")).distinct()
    asked = users.select("hub_id", "user_id").distinct()
    own = devices.join(held, "device_id").join(
        asked.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_hubs")), "user_id")
    listed = members.select("hub_id", "local_id").distinct()
    sides = own.groupBy("local_id").agg(
        F.count(F.lit(1)).alias("n_own"), F.sum("n_hubs").alias("n_asked")).join(
        listed.groupBy("local_id").agg(F.count(F.lit(1)).alias("n_listed")), "local_id").select(
        "local_id", (F.col("n_own") * F.col("n_listed") > F.col("n_asked")).alias("heavy"))
    own = salted_join(own, sides, ["local_id"], spread_by=["device_id", "user_id"])
    light = own.where(~F.col("heavy")).join(listed, "local_id").join(
        asked, ["hub_id", "user_id"], "left_semi")
    heavy = own.where("heavy").join(asked, "user_id").join(
        listed, ["hub_id", "local_id"], "left_semi")
    return light.unionByName(heavy).select(
        "hub_id", "user_id", "device_id", "device_name", "device_type_id")


def permission_classes(usable: DataFrame, users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Users of a hub who may use the same of its devices, as one class.

    What a user may choose depends on that set alone. `usable` has rows as
    `user_devices` gives them, `users` the pairs that are asked for. Returns
    `(classes, fleet)`: the class of each pair, and the devices of each class with
    `hub_id` a struct of hub and class. A class is named by a digest of its set: number,
    sums and exclusive ors of the devices' digests, which combine before the shuffle, so
    no set is ever gathered.
    """
    digest = F.md5(F.col("device_id").cast("string"))
    halves = [F.conv(F.substring(digest, i, 16), 16, -10).cast("long") for i in (1, 17)]
    rows = usable.select("hub_id", "user_id", *(h.alias(f"h{i}") for i, h in enumerate(halves)))
    sets = rows.groupBy("hub_id", "user_id").agg(
        F.count(F.lit(1)).alias("n"), *(f(c).alias(f"{n}_{c}") for c in ("h0", "h1") for n, f in (
            ("all", lambda c: F.sum(F.col(c).cast("decimal(20,0)"))), ("xor", F.bit_xor))))
    named = F.md5(F.concat_ws(":", *sets.columns[2:]).cast("binary"))
    asked = users.select("hub_id", "user_id").distinct()
    classes = asked.join(sets, ["hub_id", "user_id"], "left").select(
        "hub_id", "user_id", F.when(F.col("n").isNotNull(), named).otherwise(
            F.lit("none")).alias("class_id"))
    classes = keep(users.sparkSession, classes, "classes")
    first = classes.groupBy("hub_id", "class_id").agg(F.min("user_id").alias("user_id"))
    fleet = usable.join(first, ["hub_id", "user_id"]).select(
        F.struct("hub_id", "class_id").alias("hub_id"), "device_id", "device_name",
        "device_type_id")
    return classes, fleet


def for_classes(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of hubs and users with `hub_id` as the hub of a class, a struct of both."""
    return rows.join(classes, ["hub_id", "user_id"]).withColumn(
        "hub_id", F.struct("hub_id", "class_id")).drop("class_id")


def selection_requests(elements: DataFrame, groups_for_tasks: bool = True,
                       groups_for_events: bool = False) -> DataFrame:
    """One selection request per element, in the shape the selection expects.

    A missing criterion becomes "" and the characteristic is left out.
    `is_event` tells which of the two group settings counts for an element.
    """
    def text(name: str):
        return F.coalesce(F.col(name), F.lit("")).alias(name)

    criterion = F.struct(*(text(c) for c in CRITERIA[1:]))
    groups = F.when(F.col("is_event"), F.lit(groups_for_events)).otherwise(
        F.lit(groups_for_tasks))
    kept = [c for c in elements.columns
            if c not in (*CRITERIA[1:], "bpmn_id", "is_event", "characteristic_id")]
    return elements.select(
        *kept, F.col("bpmn_id").alias("id"),
        F.array(criterion).alias("criteria"),
        groups.alias("include_groups"),
        F.lit(False).alias("include_imports"),
        F.lit(True).alias("include_devices"),
        F.lit(False).alias("include_id_modified_devices"))


def with_criteria(rows: DataFrame) -> DataFrame:
    """Blank criteria as "", so that rows can be joined on them."""
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in CRITERIA[1:]})


def criteria_counts(requests: DataFrame) -> DataFrame:
    """Distinct criteria rows and how many requests share each, as `n_rows`.

    Matching reads this several times and it is far smaller than the requests,
    so `keep` it before a large run.
    """
    return key_counts(with_criteria(requests), CRITERIA)


def options_key() -> Column:
    """Names the options of a criteria row, blanks filled in."""
    return F.md5(F.to_json(F.struct(*CRITERIA)).cast("binary"))


def _pair(function: Column, device_class: Column) -> Column:
    return F.concat(function, F.lit("\x1f"), device_class)


def _lead(kind: str, value: Column) -> Column:
    """A lead as a number, which is small to shuffle. Leads of one number are one lead: what
    answers to it is looked at in full, so that makes pairs to look at, not options."""
    return F.hash(F.lit(kind), value)


def _given_leads() -> Column:
    """All a criteria row may be looked up by: what it gives, or nothing if it is blank."""
    function, device_class, aspect = (F.col(c) for c in CRITERIA[1:])
    blank = (function == "") & (device_class == "") & (aspect == "")
    return F.array_distinct(F.array_compact(F.array(
        F.when((function != "") & (device_class != ""), _lead("both", _pair(function, device_class))),
        F.when(function != "", _lead("function", function)),
        F.when(device_class != "", _lead("class", device_class)),
        F.when(aspect != "", _lead("aspect", aspect)),
        F.when(blank, _lead("any", F.lit(""))))))


def offered_services(services: DataFrame) -> DataFrame:
    """Device types with all their services, from one row per type and service."""
    nothing = F.array().cast("array<string>")
    service = F.struct(
        F.col("service_id").alias("id"), F.col("service_name").alias("name"),
        F.coalesce("function_ids", nothing).alias("functions"),
        F.coalesce("device_class_id", F.lit("")).alias("class"),
        F.coalesce("aspect_ids", nothing).alias("aspects"))
    return services.groupBy("device_type_id").agg(F.collect_set(service).alias("offered"))


def type_leads(types: DataFrame) -> DataFrame:
    """Device types under each lead they answer to.

    A type answers to each of its functions, with and without its class, to its class,
    its aspects and to no criterion at all, so its rows are the sum of these, not their
    product. They name the type alone; what it offers is joined to what is met.
    """
    def leads(kind: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda v: v.isNotNull() & (v != "")),
                           lambda v: _lead(kind, v))

    answers = F.array_distinct(F.concat(
        F.array(_lead("any", F.lit(""))),
        leads("both", F.flatten(F.transform("offered", lambda s: F.transform(
            s["functions"], lambda f: F.when(s["class"] != "", _pair(f, s["class"])))))),
        leads("function", F.flatten(F.transform("offered", lambda s: s["functions"]))),
        leads("class", F.transform("offered", lambda s: s["class"])),
        leads("aspect", F.flatten(F.transform("offered", lambda s: s["aspects"])))))
    return types.select("device_type_id", F.explode(answers).alias("lead"))


def rarest_leads(criteria: DataFrame, offers: DataFrame, types_on_hubs: DataFrame) -> DataFrame:
    """Distinct criteria without their hub with the `lead` fewest types on hubs answer to.

    Criteria that give a lead no type on any hub answers to have no options and are left out.
    `by_type` tells which side of the lead is the smaller: the types on hubs that answer to it,
    or its criteria rows with each type that does. Both are counted over all hubs, so what is
    shuffled for this is of the size of the catalogue and of the distinct criteria.
    """
    on_hubs = types_on_hubs.groupBy("device_type_id").agg(F.count(F.lit(1)).alias("n_hubs"))
    counts = offers.join(on_hubs, "device_type_id").groupBy("lead").agg(
        F.sum("n_hubs").alias("n_posted"), F.count(F.lit(1)).alias("n_types"))
    wanted = key_counts(criteria, CRITERIA[1:])
    found = wanted.withColumn("lead", F.explode(_given_leads())).join(counts, "lead").groupBy(
        *CRITERIA[1:], "n_rows").agg(
        F.count(F.lit(1)).alias("n_found"), F.min(F.struct("n_posted", "lead", "n_types")).alias(
            "least")).where(F.col("n_found") == F.size(_given_leads()))
    asked = found.groupBy(F.col("least.lead").alias("lead")).agg(F.sum("n_rows").alias("n_asked"))
    return found.select(*CRITERIA[1:], "least.*").join(asked, "lead").select(
        *CRITERIA[1:], "lead",
        (F.col("n_posted") <= F.col("n_asked") * F.col("n_types")).alias("by_type"))


def met_types(criteria: DataFrame, types_on_hubs: DataFrame, offered: DataFrame) -> DataFrame:
    """Criteria rows with the types on their hub that answer to their rarest lead.

    For each lead the smaller side is written out: types on hubs under it meet criteria on hub
    and lead, or criteria with the types under it meet those on hubs on hub and type.
    """
    offers = type_leads(offered)
    chosen = keep(criteria.sparkSession, rarest_leads(criteria, offers, types_on_hubs), "leads")
    asked = criteria.select(*CRITERIA).join(chosen, CRITERIA[1:])
    used = chosen.where("by_type").select("lead").distinct()
    posted = types_on_hubs.join(offers.join(used, "lead", "left_semi"), "device_type_id")
    by_type = asked.where("by_type").join(posted, ["hub_id", "lead"])
    by_criteria = asked.where(~F.col("by_type")).join(offers, "lead").join(
        types_on_hubs, ["hub_id", "device_type_id"])
    return by_type.unionByName(by_criteria).drop("lead", "by_type")


def match_types(criteria: DataFrame, fleet: DataFrame, services: DataFrame) -> DataFrame:
    """Device types that meet each distinct criteria row, with the services that
    do, the number of devices of the type on the hub and the first of them.

    Types meet criteria on the hub and the rarest lead; the other criteria are looked at
    in the pairs that gives.
    """
    def meets(service) -> Column:
        return (((F.col("function_id") == "")
                 | F.array_contains(service["functions"], F.col("function_id")))
                & ((F.col("device_class_id") == "") | (service["class"] == F.col("device_class_id")))
                & ((F.col("aspect_id") == "")
                   | F.array_contains(service["aspects"], F.col("aspect_id"))))

    # Types on hubs and the catalogue are looked at from several ends.
    types = keep(criteria.sparkSession, fleet.groupBy("hub_id", "device_type_id").agg(
        F.count(F.lit(1)).alias("n_devices"), F.min("device_id").alias("first_device_id")), "types")
    offered = keep(criteria.sparkSession, offered_services(services), "offered")
    met = met_types(criteria, types, offered).join(offered, "device_type_id").withColumn(
        "services", F.sort_array(F.array_distinct(F.transform(
            F.filter("offered", meets), lambda s: F.struct(s["id"], s["name"])))))
    return met.where(F.size("services") > 0).select(
        *CRITERIA, "device_type_id", "services", "n_devices", "first_device_id")


def device_options(matched: DataFrame, fleet: DataFrame) -> DataFrame:
    """Devices of a hub that meet each distinct criteria row, with `services`.

    A device is on a hub once, so rows come out once without a distinct.
    """
    types = matched.select(*CRITERIA, "device_type_id", "services")
    return (fleet.join(types, ["hub_id", "device_type_id"])
            .select(*CRITERIA, "device_id", "device_name", "services"))


def match_candidates(matched: DataFrame, fleet: DataFrame) -> DataFrame:
    """The same as device and service pairs."""
    return (device_options(matched, fleet)
            .withColumn("service", F.explode("services"))
            .select(*CRITERIA, "device_id", "device_name",
                    F.col("service.id").alias("service_id"),
                    F.col("service.name").alias("service_name")))


def first_options(matched: DataFrame) -> DataFrame:
    """The first device and service of each matched type. Devices of a type
    share their services, so the first option of a criteria row is among them."""
    return matched.select(
        *CRITERIA, "n_devices", F.col("first_device_id").alias("device_id"),
        F.get("services", F.lit(0))["id"].alias("service_id"))


def option_summary(matched: DataFrame) -> DataFrame:
    """Per criteria row: number of devices to choose from, and the default."""
    return first_options(matched).groupBy(*CRITERIA).agg(
        F.sum("n_devices").alias("n_options"),
        F.min(F.struct("device_id", "service_id")).alias("default"),
    ).select(*CRITERIA, "n_options",
             F.col("default.device_id").alias("default_device_id"),
             F.col("default.service_id").alias("default_service_id"))


def assemble_selectables(options: DataFrame, keys: list[str] | None = None,
                         part_size: int = PART_SIZE,
                         sizes: DataFrame | None = None) -> DataFrame:
    """Device options as `selectables`, a list of `{device, services[]}` per key.

    The services of one device are few. The devices of one key need not be, so
    a key with more than `part_size` devices gets several rows, numbered
    `part` of `n_parts`: the list in device order, cut.
    """
    item = F.struct(
        F.struct(F.col("device_id").alias("id"), F.col("device_name").alias("name"))
        .alias("device"), "services")
    return list_parts(options, keys or CRITERIA, "device_id", item, "selectables",
                      part_size, sizes)


def attach_options(elements: DataFrame, options: DataFrame, on: list[str],
                   spread_by: list[str] | None = None,
                   counts: DataFrame | None = None) -> DataFrame:
    """Attach options to elements by request key.

    An element nobody answered keeps its row with null options. `counts`, the
    elements per key, tells which keys are hot; without it they are counted.
    """
    counts = key_counts(elements, on) if counts is None else counts
    return salted_join(elements, options, on, "left", spread_by, hot_keys(counts, on))


def default_option(options: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First option of each key by an explicit order, as a minimum."""
    return (options.groupBy(*keys).agg(F.min(F.struct(*order)).alias("first"))
            .select(*keys, "first.*"))


def executable_flag(elements: DataFrame, deployment: list[str]) -> DataFrame:
    """A deployment can run when each of its tasks has an option; one without
    tasks can run too. `is_task` and `n_options` are columns of the elements."""
    has_option = F.coalesce(F.col("n_options"), F.lit(0)) > 0
    return elements.groupBy(*deployment).agg(
        F.count_if("is_task").alias("n_tasks"),
        F.count_if(F.col("is_task") & has_option).alias("n_with_options"),
    ).withColumn("executable", F.col("n_tasks") == F.col("n_with_options"))
