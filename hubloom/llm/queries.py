"""The registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from hubloom.llm.decontaminate import matched
from hubloom.llm.html_text import extracted
from hubloom.llm.mixing import mixed
from hubloom.llm.near_duplicates import near_duplicates
from hubloom.llm.negatives import hard_negatives
from hubloom.llm.packing import packed
from hubloom.llm.pii import personal_data
from hubloom.llm.prefix_trie import prefix_trie
from hubloom.llm.quality import scored
from hubloom.llm.repeats import without_repeats
from hubloom.llm.search import top_k
from hubloom.llm.sharding import sharded
from hubloom.llm.token_counts import section_tokens


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return section_tokens(_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents a mixture with evened-out sources, languages, topics keeps."""
    rows = mixed(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "source", "lang", "topic", "tokens", "chance", "weight", "kept")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(_table(spark, sf_dir, "pages"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicates(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(_table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                  _table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "held_out", "score", "predicted")


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharded(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard",
                       "source")


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(_table(spark, sf_dir, "documents"), texts=False)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = matched(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                   _table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
                       "longest_match", "match_word")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every document's tokens lie in sequences of 4,096."""
    rows = packed(_table(spark, sf_dir, "documents"),
                  vocabulary=public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                       "doc_tokens", "sequence_id", "offset")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every hundredth vector; every seventh counts under the next label."""
    rows = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations rebuilt on a head of every fifth one, as a trie."""
    conv_id = F.col("conv_id")
    rows = prefix_trie(_table(spark, sf_dir, "conversations"), conv_id - conv_id % 5,
                       F.crc32(conv_id.cast("string").cast("binary")) % 9, 8)
    return rows.drop("last_conv_id", "last_position")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_mixing": op2_mixing,
    "op3_html_text": op3_html_text,
    "op4_top_k": op4_top_k,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_personal_data": op6_personal_data,
    "op7_quality": op7_quality,
    "op8_shards": op8_shards,
    "op9_repeats": op9_repeats,
    "op10_decontamination": op10_decontamination,
    "op11_packing": op11_packing,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_prefix_trie": op13_prefix_trie,
    "pipeline": corpus_pipeline.run,
}
