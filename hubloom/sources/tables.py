"""Typed table reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hubloom import schemas


def read_table(spark: SparkSession, name: str, path: str, file_format: str = "parquet",
               **options: str) -> DataFrame:
    """Read a fleet table with its fixed schema, so no file is opened to infer
    one and filters and columns are pushed into the scan."""
    if name not in schemas.TABLES:
        raise KeyError(f"unknown table {name}; known: {', '.join(sorted(schemas.TABLES))}")
    reader = spark.read.schema(schemas.TABLES[name])
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.format(file_format).load(path)


def save_bucketed(rows: DataFrame, table: str, key: str, buckets: int) -> None:
    """Save a table in buckets of one key.

    For tables that are joined run after run: hub members and devices in the
    same number of buckets of `local_id` are made distinct and joined without
    a shuffle. Choose the number so that a bucket fits one task.
    """
    (rows.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .format("parquet").saveAsTable(table))
