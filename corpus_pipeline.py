"""A training corpus from ``documents``: stages that are written and read again in turn."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spendfall.llm.line_dedup import line_dedup
from spendfall.llm.near_duplicates import drop_near_duplicates
from spendfall.llm.packing import pack
from spendfall.llm.quality_rules import quality_rules
from spendfall.llm.queries import HELD_OUT
from spendfall.llm.store import dropped, stored
from spendfall.llm.toxicity import fit, score


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3; learned from the labelled ones that are not held out."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), learn=f"not ({HELD_OUT})")
    return score(docs, model).where("score < 0.3").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality_rules(docs).where("kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less repeated passages, with their new length; those of which nothing is left go."""
    cleaned = line_dedup(docs).where("n_deleted = 0 or n_deleted < n_words")
    return cleaned.selectExpr(*("if(n_deleted > 0, length(text), n_chars) as n_chars" if name == "n_chars" else f"`{name}`" for name in docs.columns))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near-duplicates."""
    return drop_near_duplicates(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the texts in training sequences."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality rules", quality),
    ("line dedup", lines),
    ("near-dedup", near),
    ("packing", packing),
]

#: Compression lengths and signatures have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's table is deleted when the next one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
            dropped(before if k else None)
    return docs
