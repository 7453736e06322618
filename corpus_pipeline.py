"""From documents to sharded training rows, in stages that are stored one by one.

1. quality: documents the rule ensemble rejects go.
2. near_duplicates: one document of each group of near copies stays.
3. decontamination: documents that hold a window of a benchmark item go.
4. mixing: documents are sampled to even out sources, languages and topics.
5. sharding: every document that is left gets a shard and a slot in it.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last pick
rows of `docs` and return them as they are, with every column and its values. `run`
writes each stage's rows as Parquet to the shared folder and reads them back for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hubloom.llm import decontaminate, mixing, quality
from hubloom.llm.near_duplicates import one_of_each
from hubloom.llm.sharding import sharded
from hubloom.session import keep


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be of good quality."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, labels)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group, that of the least doc_id; documents without words too."""
    return one_of_each(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    tests = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, tests)


def sampled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn towards the target mixture."""
    return mixing.sampled(docs)


def placed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document."""
    return sharded(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good), ("near_duplicates", distinct), ("decontamination", clean),
    ("mixing", sampled), ("sharding", placed)]

#: A fitted classifier decides the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
