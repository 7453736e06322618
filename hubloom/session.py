"""Session settings the jobs rely on, and the shared folder they write to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Times are UTC; windows are cut on UTC hours.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more shuffle later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A repeated key in a JSON object keeps its last value instead of failing.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Keyed stream state lives on disk, not on the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch uploads what changed in the state, not the whole of it.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "hubloom", master: str | None = None,
                  **settings: str) -> SparkSession:
    """Session for jobs, tests and the bench; `settings` use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


class _Folders:
    """Where kept rows go: the folder to use where the session names none, the
    folders made since a job began, and whether rows are kept at all."""

    fallback: str | None = None
    made: list[str] | None = None
    inline = False


def use_folder(path: str) -> None:
    """Folder for sessions without `spark.checkpoint.dir`: tests and local runs."""
    _Folders.fallback = path


def has_folder(spark: SparkSession) -> bool:
    return bool(spark.conf.get("spark.checkpoint.dir", None) or _Folders.fallback)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder that every executor can reach.

    It lies in the folder the cluster names in `spark.checkpoint.dir`.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _Folders.fallback
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    path = f"{base.rstrip('/')}/hubloom/{name}-{uuid.uuid4().hex}"
    if _Folders.made is not None:
        _Folders.made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the shared folders a job made once it has ended.

    Not for code that returns a frame, which may still read them.
    """
    outer, _Folders.made = _Folders.made, []
    try:
        yield
    finally:
        made, _Folders.made = _Folders.made, outer
        for path in made:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a shared folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def inline() -> Iterator[None]:
    """Plan kept rows in place, so that a query's plan shows all of it."""
    _Folders.inline = True
    try:
        yield
    finally:
        _Folders.inline = False


def keep(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back.

    For a result that several parts of a job need: it is computed once, lost
    executors do not bring it back, and readers still prune its columns.
    """
    if _Folders.inline:
        return rows
    path = shared_dir(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
