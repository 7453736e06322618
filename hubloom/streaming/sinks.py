"""Batch folders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

Trigger = dict[str, str | bool]
AVAILABLE_NOW: Trigger = {"availableNow": True}


def append_files(stream: DataFrame, path: str, checkpoint: str,
                 partition_by: tuple[str, ...] = (),
                 trigger: Trigger | None = None) -> StreamingQuery:
    """Append rows with the file sink, whose log makes a repeated batch count once.

    Readers find what counts through `_spark_metadata`, so read it with Spark.
    """
    return (stream.writeStream.outputMode("append").format("parquet")
            .option("path", path).option("checkpointLocation", checkpoint)
            .partitionBy(*partition_by).trigger(**(trigger or AVAILABLE_NOW)).start())


def write_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "append",
                  also: Callable[[DataFrame, int], None] | None = None,
                  trigger: Trigger | None = None) -> StreamingQuery:
    """Write each micro-batch to its own `batch_id=` folder, which a repeated batch
    overwrites; `also` is called with every batch.

    For what the file sink cannot take: update mode, or a second table. Batch
    numbers come from the checkpoint, so a checkpoint and a path belong together:
    a new checkpoint needs a new path.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(f"{path}/batch_id={batch_id}"))
        if also:
            also(batch, batch_id)

    return (stream.writeStream.outputMode(mode).foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or AVAILABLE_NOW)).start())


def read_batches(spark: SparkSession, path: str, schema: StructType,
                 above: int = -1) -> DataFrame:
    """Batches written so far with a number over `above`, none before the first,
    each row with its `batch_id`."""
    numbered = StructType([*schema.fields, StructField("batch_id", LongType())])
    return read_files(spark, path, numbered).where(f"batch_id > {int(above)}")


def read_files(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What `append_files` has written so far; none before the first batch."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
