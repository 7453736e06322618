"""Jobs for `spark-submit`: prepare, create, start, remove, reconcile, and the
streams route, sync and topics, which read the files at hand and stop.

Every argument that names a table is the path of a parquet folder (`--format`
for others) with the schema of the same name in `hubloom.schemas`.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from hubloom import schemas
from hubloom.functions import query_values
from hubloom.operators import access, commands, selection
from hubloom.plans import create, lifecycle, prepare
from hubloom.session import build_session, keep, scratch
from hubloom.sources import records
from hubloom.sources.commands import write_commands
from hubloom.sources.tables import read_table
from hubloom.streaming import routing, topics
from hubloom.streaming import sync as sync_streams

REQUESTS = {
    "prepare": "request_id string, user_id string, hub_id string, model_id string",
    "create": "request_id string, user_id string, network_id string, source string, "
              "flag string, body string",
    "start": "action_id string, network_id string, deployment_id string, query string",
    "remove": "action_id string, network_id string, deployment_id string",
    "reconcile": "network_id string, deployment_id string",
    "route": "request_id string, network_id string, body string",
    "sync": schemas.SYNC_METADATA,
    "topics": schemas.TOPIC_MESSAGE,
}
STREAMS = ("route", "sync", "topics")


def _table(spark: SparkSession, args, name: str) -> DataFrame:
    return read_table(spark, name, getattr(args, name), args.format)


def run_prepare(spark: SparkSession, args, requests: DataFrame) -> None:
    """Write the answer to every request and its `deployments`; for distinct hubs of
    permission classes and models the `elements`; and the options of elements at the
    level they are found on: `options` has, by options key, the device types with their
    services, `devices` the devices of each type on a hub that the class may use.
    `classes` has the class of every hub and user asked for. `hub_id` is a struct of hub
    and class in all but that."""
    hubs = selection.requested_hubs(_table(spark, args, "hubs"), requests)
    models = records.models(_table(spark, args, "process_models"))
    usable = keep(spark, selection.user_devices(
        selection.hub_members(hubs), records.devices(_table(spark, args, "devices")),
        access.grants(_table(spark, args, "permissions")), requests), "usable")
    classes, fleet = selection.permission_classes(usable, requests)
    requests = selection.for_classes(requests, classes)
    rows = prepare.request_elements(
        requests, prepare.element_table(spark, models, requests),
        selection.for_classes(classes.select("hub_id", "user_id").join(
            records.known_hubs(hubs), "hub_id"), classes).select("hub_id").distinct())
    criteria, fleet, matched = prepare.match(
        spark, rows, fleet, selection.type_services(_table(spark, args, "device_types")))
    matched = keep(spark, matched, "matched")
    elements = keep(spark, prepare.prepared_elements(rows, criteria, matched), "prepared")
    for name, frame in (
            ("classes", classes), ("elements", elements),
            ("answers", prepare.answered(
                requests, prepare.prepared_headers(elements), "user_id")),
            ("deployments", prepare.answered(
                requests, prepare.prepared_deployments(elements, models), "user_id")),
            ("options", matched.withColumn("options_key", selection.options_key())),
            ("devices", fleet.repartition("hub_id", "device_type_id").sortWithinPartitions(
                "hub_id", "device_type_id"))):
        frame.write.mode("overwrite").parquet(f"{args.out}/{name}")


def run_create(spark: SparkSession, args, requests: DataFrame) -> None:
    """Write deploy `commands` and the answer to every request."""
    created = keep(spark, create.create(
        spark, requests, _table(spark, args, "permissions")), "created")
    write_commands(create.deploy_commands(created, args.run_id), f"{args.out}/commands",
                   args.run_id, "deploy")
    created.select("request_id", "status", "reason").write.mode("overwrite").parquet(
        f"{args.out}/answers/run_id={args.run_id}")


def run_action(spark: SparkSession, args, requests: DataFrame) -> None:
    """Write start or remove `commands` and the actions that send none."""
    inputs = query_values(F.col("query")) if args.job == "start" else None
    sent, idle = lifecycle.action_commands(
        requests, records.sync_rows(_table(spark, args, "sync_metadata")), args.job, inputs)
    write_commands(sent, f"{args.out}/commands", args.run_id, args.job)
    idle.select("action_id", "status").write.mode("overwrite").parquet(
        f"{args.out}/idle/run_id={args.run_id}")


def run_reconcile(spark: SparkSession, args, requests: DataFrame) -> None:
    """Write the state of every wanted or synced deployment."""
    synced = records.sync_rows(_table(spark, args, "sync_metadata"))
    commands.reconcile(requests, synced).write.mode("overwrite").parquet(f"{args.out}/states")


def run_stream(spark: SparkSession, args, messages: DataFrame) -> None:
    """Write new files' results to `batches`; `checkpoint` remembers what was read.
    Accepted messages are written to `commands` too; sync changes are compacted."""
    trigger = {"processingTime": args.every} if args.every else {"availableNow": True}
    path, checkpoint = f"{args.out}/batches", f"{args.out}/checkpoint"
    if args.job == "route":
        routing.route_commands_stream(messages, path, checkpoint, f"{args.out}/commands",
                                      trigger).awaitTermination()
    elif args.job == "topics":
        topics.topic_activity_stream(messages, path, checkpoint,
                                     trigger=trigger).awaitTermination()
    else:
        rows = records.sync_rows(messages)
        sync_streams.latest_sync_stream(rows, path, checkpoint, trigger).awaitTermination()
        sync_streams.compact(spark, path, rows.schema)


JOBS = {
    "prepare": (run_prepare, ("hubs", "devices", "device_types", "process_models",
                             "permissions")),
    "create": (run_create, ("permissions",)),
    "start": (run_action, ("sync_metadata",)),
    "remove": (run_action, ("sync_metadata",)),
    "reconcile": (run_reconcile, ("sync_metadata",)),
    **{name: (run_stream, ()) for name in STREAMS},
}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="hubloom.jobs", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, (run, tables) in JOBS.items():
        job = jobs.add_parser(name, help=run.__doc__)
        job.add_argument("--requests", required=True, help=(
            REQUESTS[name] if isinstance(REQUESTS[name], str) else REQUESTS[name].simpleString()))
        for table in tables:
            job.add_argument(f"--{table}", required=True)
        job.add_argument("--out", required=True)
        job.add_argument("--run-id", default="run")
        job.add_argument("--format", default="parquet")
        if name in STREAMS:
            job.add_argument("--files-per-batch", default="1000")
            job.add_argument("--bytes-per-batch", help="soft bound, in place of files")
            job.add_argument("--every", help="run on, with a batch so often, like '1 minute'")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parse(argv)
    spark = spark or build_session(f"hubloom-{args.job}")
    reader = spark.read
    if args.job in STREAMS:
        bound = (("maxBytesPerTrigger", args.bytes_per_batch) if args.bytes_per_batch
                 else ("maxFilesPerTrigger", args.files_per_batch))
        reader = spark.readStream.option(*bound)
    requests = reader.schema(REQUESTS[args.job]).format(args.format).load(args.requests)
    with scratch(spark):
        JOBS[args.job][0](spark, args, requests)


if __name__ == "__main__":
    main()
