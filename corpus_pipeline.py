"""The corpus pipeline: quality, toxicity, near duplicates, benchmark leaks, then token digests.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with their columns
as they are; the last returns digests of the token ids. A stage works on all that the one before
kept. Every stage has its counterpart by brute force in the tests, and none can be said in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import bpe, decontaminate, near_copies, quality, toxicity
from tidegate.llm.common import table, without_scratch
from tidegate.llm.queries import BYTE_BPE

QUALITY, TOXIC = 0.3, 0.5
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of QUALITY or more."""
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, "doc_id", "text", "quality")
    scored = quality.with_scores(docs, "text", model, "__score")
    return scored.where(F.col("__score") >= QUALITY).drop("__score")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below TOXIC."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, "doc_id", "text", "toxic")
    scored = toxicity.with_scores(docs, "text", model, "__score")
    return scored.where(F.col("__score") < TOXIC).drop("__score")


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return near_copies.without_near_copies(docs, "doc_id", "text")


def no_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.without_leaks(
        docs, "text", table(spark, sf_dir, "benchmark"), "item_id", "text"
    )


def token_digests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document and back: counts and digests of both."""
    return bpe.round_trip(docs, "doc_id", "text", BYTE_BPE)


STAGES = [
    ("quality classifier", good_quality),
    ("toxicity", not_toxic),
    ("near duplicates", no_near_copies),
    ("benchmark decontamination", no_leaks),
    ("byte-pair encoding", token_digests),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = step(stage, spark, docs, sf_dir, name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


def step(stage, spark: SparkSession, docs: DataFrame, sf_dir: str, label: str) -> DataFrame:
    """What a stage keeps, as a table; the tables that it made on the way are removed."""
    return without_scratch(lambda: stage(spark, docs, sf_dir), spark, label)
