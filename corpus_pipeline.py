"""From raw documents to token files: the stages of the corpus pipeline, in order.

Every stage works on what the one before kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm import balancing, decontamination, near_duplicates, quality, token_files
from quern.llm.common import documents, table
from quern.llm.queries import vocabulary
from quern.session import fresh_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be good, learned from those among ``docs`` that have a label."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_duplicates.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.without_contamination(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return balancing.repeated(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, described per document (a document taken twice appears twice)."""
    return token_files.token_output(docs, vocabulary())


STAGES = [
    ("quality", quality_stage),
    ("near-duplicates", duplicate_stage),
    ("benchmark", benchmark_stage),
    ("source mix", mixing_stage),
    ("token files", token_stage),
]

#: The first stage learns a model, so the rows cannot be written in SQL; tests check each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
