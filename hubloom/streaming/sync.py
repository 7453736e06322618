"""Newest sync row per engine deployment, kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from hubloom.operators.sync import ENGINE_KEY, latest_sync
from hubloom.streaming.sinks import Trigger, read_batches, read_files, write_batches


def latest_sync_stream(rows: DataFrame, path: str, checkpoint: str,
                       trigger: Trigger | None = None) -> StreamingQuery:
    """Each batch writes the deployments whose newest row changed.

    State is one row per deployment and is never dropped: a deployment that has
    not reported for long is still the newest known state.
    """
    return write_batches(latest_sync(rows, ENGINE_KEY), path, checkpoint, "update",
                         trigger=trigger)


def _compacted(spark: SparkSession, path: str) -> tuple[str | None, int]:
    """The newest whole compaction of `path` and the last batch in it."""
    base = spark._jvm.org.apache.hadoop.fs.Path(f"{path}-compacted")
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in files.listStatus(base)] if files.exists(base) else []
    done = [(int(p.getName().partition("=")[2]), p.toString()) for p in found
            if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    upto, newest = max(done, default=(-1, None))
    return newest, upto


def read_latest(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The current state: the newest of the last compaction and all changes since."""
    newest, upto = _compacted(spark, path)
    rows = read_batches(spark, path, schema, upto).drop("batch_id")
    if newest:
        rows = rows.unionByName(read_files(spark, newest, schema))
    return latest_sync(rows, ENGINE_KEY)


def compact(spark: SparkSession, path: str, schema: StructType) -> None:
    """Write the current state beside the changes; readers then leave out the
    batches in it. Changes of later batches are not lost: they are read as before."""
    last = read_batches(spark, path, schema).agg(F.max("batch_id")).first()[0]
    if last is None or last <= _compacted(spark, path)[1]:
        return
    newest, upto = _compacted(spark, path)
    rows = read_batches(spark, path, schema, upto).where(F.col("batch_id") <= last).drop("batch_id")
    if newest:
        rows = rows.unionByName(read_files(spark, newest, schema))
    (latest_sync(rows, ENGINE_KEY).sortWithinPartitions("network_id")
     .write.mode("overwrite").parquet(f"{path}-compacted/upto={last}"))


# --- with a removal policy --------------------------------------------------

REPORT = "at long, seq long, deployment_id long, is_placeholder boolean, marked_for_delete boolean"


def live_sync_stream(rows: DataFrame, path: str, checkpoint: str, keep_for: str = "1 day",
                     trigger: Trigger | None = None) -> StreamingQuery:
    """Each batch writes the newest reports of deployments that have changed.

    `rows` has the engine key, `sync_date`, `seq`, `deployment_id` and the two flags, with
    numbers as ids. The state of a deployment is its newest report among those that arrived in
    one window of `keep_for`. It goes once batches have arrived after the window's end, so
    the state holds what has been heard of lately, not all there ever was. It is an
    aggregate: a deployment that reports all the time is small before it is brought to its
    state. A deployment marked for delete writes that as its last row. A report that is older
    than what was written before its state went is written again, and loses against that when
    the rows are read.
    """
    # The time of the batch; nothing is late by it.
    reports = rows.select(
        *ENGINE_KEY, F.unix_micros(F.col("sync_date").cast("timestamp")).alias("at"),
        F.col("seq").cast("long").alias("seq"), "deployment_id", "is_placeholder",
        "marked_for_delete", F.current_timestamp().alias("__arrived")).withWatermark(
        "__arrived", "0 seconds")
    # Of reports of one date and number the first to arrive stays.
    newest = F.max(F.struct("at", "seq", (-F.unix_micros("__arrived")).alias("behind"),
                            "deployment_id", "is_placeholder", "marked_for_delete"))
    changes = reports.groupBy(*ENGINE_KEY, F.window("__arrived", keep_for).alias("__window")).agg(
        newest.alias("__newest"), F.max("__arrived").alias("__last")).where(
        F.col("__newest.behind") == -F.unix_micros("__last")).select(
        *ENGINE_KEY, F.col("__newest.at").alias("at"), F.col("__newest.seq").alias("seq"),
        F.col("__newest.deployment_id").cast("long").alias("deployment_id"),
        F.col("__newest.is_placeholder").alias("is_placeholder"),
        F.col("__newest.marked_for_delete").alias("marked_for_delete"))
    return write_batches(changes, path, checkpoint, "update", trigger=trigger)


def read_live(spark: SparkSession, path: str, key: StructType) -> DataFrame:
    """The newest row of each deployment whose newest row does not mark it for delete."""
    schema = StructType([*key.fields, *spark.createDataFrame([], REPORT).schema.fields])
    rows = read_batches(spark, path, schema).withColumn(
        "sync_date", F.timestamp_micros("at")).drop("at", "batch_id")
    return latest_sync(rows, ENGINE_KEY).where(~F.col("marked_for_delete"))
