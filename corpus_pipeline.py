"""From raw documents to a training mix: each stage reads what the one before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, with the columns of
``documents`` except for the last, which adds what the mix takes. ``run`` writes each stage as Parquet to the shared
folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenetrail.llm.common import table
from scenetrail.llm.decontaminate import contamination
from scenetrail.llm.line_dedup import drop_lines
from scenetrail.llm.mix import mixed_documents
from scenetrail.llm.near_dedup import deduplicate
from scenetrail.llm.quality import classify
from scenetrail.session import cut


def _only(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return _only(classify(docs).filter("keep"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines similar to an earlier line; those that lose all their lines go."""
    return _only(drop_lines(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return _only(found.filter(~F.col("contaminated")), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the words that it takes of each."""
    return mixed_documents(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

ORACLE_SQL = None  # SQL cannot express the trained classifier; tests/llm compares the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
