"""Command tables."""

from __future__ import annotations

import time
import uuid
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hubloom.schemas import COMMAND
from hubloom.session import delete

FOLDERS = ("run_id", "action", "version")
MARKS = "run_id string, action string, version string, written_at long"


def _folder(path: str, *values: str) -> str:
    return "/".join([path, *(f"{name}={quote(value, safe='')}" for name, value in
                             zip(FOLDERS, values, strict=True))])


def write_commands(commands: DataFrame, path: str, run_id: str, action: str) -> None:
    """Write the commands of one action of a run as a new version.

    A rerun's version lies beside the one before, also with fewer commands or none. Once
    it is whole, a row in the table of marks names it, which a file makes visible at
    once; readers follow the newest mark. So a run that fails half-way leaves the old
    commands, and a reader meets either all of one version or all of the other. Every
    row has all columns of the command table. Files are sorted by hub, so a reader that
    wants one hub skips row groups. No shuffle: a crowded hub is written by many tasks.
    """
    spark = commands.sparkSession
    columns = [
        (F.col(f.name) if f.name in commands.columns else F.lit(None)).cast(f.dataType)
        .alias(f.name) for f in COMMAND.fields if f.name not in FOLDERS]
    version = uuid.uuid4().hex
    commands.select(*columns).sortWithinPartitions("network_id").write.parquet(
        _folder(path, run_id, action, version))
    mark = spark.createDataFrame([(run_id, action, version, time.time_ns())], MARKS)
    mark.coalesce(1).write.mode("append").parquet(f"{path}-marks")


def _marks(spark: SparkSession, path: str) -> DataFrame:
    """All versions that are whole, with the newest of their run and action."""
    marks = spark.read.schema(MARKS).parquet(f"{path}-marks")
    newest = marks.groupBy("run_id", "action").agg(
        F.max(F.struct("written_at", "version"))["version"].alias("newest"))
    return marks.join(newest, ["run_id", "action"])


def read_commands(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version of each run and action; none before the first."""
    try:
        valid = _marks(spark, path).where("version = newest").select(*FOLDERS)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMAND)
    schema = StructType([*COMMAND.fields, StructField("version", StringType())])
    rows = spark.read.schema(schema).parquet(path)
    return rows.join(valid, list(FOLDERS), "left_semi").select(*COMMAND.names)


def drop_old_versions(spark: SparkSession, path: str) -> None:
    """Delete the versions that newer ones have replaced, when no reader needs them.

    Versions without a mark, of runs that failed or are under way, are left alone.
    """
    old = _marks(spark, path).where("version != newest").select(*FOLDERS)
    for row in old.toLocalIterator():
        delete(spark, _folder(path, *row))
