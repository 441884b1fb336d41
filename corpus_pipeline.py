"""From raw documents to packed training sequences, stage by stage.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. ``run`` writes what a stage
returns as Parquet in the shared folder and hands the reread table to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepool.llm import decontamination, packing, quality, secrets, simhash
from tidepool.llm.common import table
from tidepool.llm.queries import MAX_BITS, QUALITY_CUT, SEQUENCE, SHINGLE_WORDS, TOKENS, held_out
from tidepool.shared import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = table(spark, sf_dir, "labels").where(~held_out(5, 0))
    return quality.good_documents(docs, quality.train(docs, labels, QUALITY_CUT))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return simhash.one_of_each_group(docs, MAX_BITS, SHINGLE_WORDS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontamination.clean_documents(spark, docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are masked."""
    return secrets.masked_documents(docs, secrets.learn(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and place in it."""
    return packing.pack(spark, packing.pieces(docs, TOKENS, SEQUENCE), SEQUENCE)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: SQL can't express the fitted classifier or the packing plan; tests check each stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
