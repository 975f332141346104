"""The corpus pipeline: toxicity, line dedup, near-dedup, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents, whatever others docs has beside them too.  `run` writes each stage's result as Parquet to the shared folder that
spark.checkpoint.dir names and rereads it for the next one, so that a lost executor costs one
stage's tasks and no stage is computed twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import curriculum, line_dedup, minhash, packing, toxicity
from tidemark.llm.common import read, shared_checkpoints


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the classifier, fitted to the labelled ones among them, doesn't call toxic.

    Every row, repeated or without an id, is judged by its own whole text.  Null, empty and word-free texts stay;
    a score at the threshold is toxic.  Without labels of both classes, and in an empty table, nothing goes.
    """
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows without the blocks of lines that an earlier one, by id, has; wholly repeated texts go.

    Rows that share an id are texts of their own, in the order of their content, so of equal rows one stays.  Null,
    empty and blank texts and rows without an id stay as they are.  Long texts are read whole, in linear time.  An
    empty table stays empty.
    """
    return line_dedup.line_dedup(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the first by id, and every row that is in no group.

    Rows that share an id are texts of their own; equal ones are a group.  Null, empty and word-free texts and rows
    without an id are in no group.  Long texts are compared whole.  An empty table stays empty.
    """
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in training order, from natural to flattened source weights; rows of scarce sources repeat.

    Every row is used at least once, rows that share an id each for itself.  A null source is one of its own.  Null
    and empty texts have no tokens and the place of the next token; rows without an id come last.  Ties don't
    occur: a source's rows are ordered by the hash of their id.  An empty table stays empty.
    """
    return curriculum.mix(docs)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of tokens: every token of every row with an id in one bin, of rows that share one each for itself.

    Null, empty and blank texts have no tokens; a text longer than a bin fills bins of its own; ties in size go by
    id.  An empty table gives no bins.
    """
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_bins),
]

#: Classifier, alignment and local search can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over the documents of sf_dir."""
    folder = f"{shared_checkpoints(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, old = read(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        if old:
            path = spark._jvm.org.apache.hadoop.fs.Path(old)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        old = out
    return docs
