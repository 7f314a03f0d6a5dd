"""Corpus pipeline: quality, line dedup, near-dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run`
writes it as Parquet to the shared folder and reads it again as the next
stage's documents.  All stages but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.llm.decontaminate import clean_documents
from vigil.llm.frames import freeze
from vigil.llm.line_dedup import dedup_lines
from vigil.llm.near_dedup import distinct_documents
from vigil.llm.pieces import encode
from vigil.llm.quality import good_documents
from vigil.session import ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts are scored like any other, a score of 0.5 stays, repeated rows
    are judged each by itself; without labels of both kinds all share one score.
    """
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; text and n_chars are those of the lines that stay.

    A document that loses all its text with them goes as well.  Null and blank texts
    stay as they are, a line stays in the smallest doc_id (null first), rows that repeat
    are cut alike.
    """
    return dedup_lines(docs, keep_emptied=False)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the smallest doc_id stays (null first).

    Null and blank texts are alike to nothing and stay; rows that share a doc_id are one
    document.
    """
    return distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts are clean; rows that share a doc_id share the verdict; with an
    empty benchmark all stay.
    """
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of what is left.

    Null and empty texts have no pieces; repeated rows give each its row, an empty table none.
    """
    return encode(docs)


def _shipped(stage):
    """The package reaches the Python workers before the stage starts."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


STAGES = [(name, _shipped(stage)) for name, stage in (
    ("quality classifier", quality), ("line dedup", line_dedup), ("near dedup", near_dedup),
    ("benchmark decontamination", decontamination), ("piece encoding", encoding))]

# a fitted model, links followed over several rounds and a Viterbi search: not a SQL query
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = freeze(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
