"""The operators' queries over the whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import curriculum, kmeans_tree, language_id, line_dedup, minhash, packing, pivot_index, suffix_dedup, tool_calls, toxicity
from tidemark.llm.common import read

def asked() -> Column:
    """The query set of both searches: every vector whose id is divisible by 50, against all vectors."""
    return F.expr("vec_id % 50 = 0")


def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(read(spark, sf_dir, "documents"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.exact_topk(read(spark, sf_dir, "embeddings"), queries=asked()).selectExpr("id AS vec_id", "rank", "neighbor AS neighbor_id")


def op3_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.format_conversations(read(spark, sf_dir, "conversations"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(read(spark, sf_dir, "documents"))


def op6_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.positions(read(spark, sf_dir, "documents")).orderBy("position", "doc_id", "epoch")


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.approximate_topk(read(spark, sf_dir, "embeddings"), queries=asked()).selectExpr("id AS vec_id", "rank", "neighbor AS neighbor_id", "distance")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_lines": op1_lines,
    "op2_topk": op2_topk,
    "op3_tools": op3_tools,
    "op4_minhash": op4_minhash,
    "op5_toxicity": op5_toxicity,
    "op6_dedup": op6_dedup,
    "op6_suffix": op6_suffix,
    "op7_mixing": op7_mixing,
    "op8_ann": op8_ann,
    "op9_packing": op9_packing,
    "op10_language": op10_language,
}

ORACLE: dict[str, str] = {
    "op1_lines": line_dedup.ORACLE_SQL,
    "op2_topk": pivot_index.ORACLE_SQL,
    "op3_tools": tool_calls.ORACLE_SQL,
    "op6_suffix": suffix_dedup.ORACLE_SQL,
    "op7_mixing": curriculum.ORACLE_SQL,
}
