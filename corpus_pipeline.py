"""From raw documents to packed sequences: each stage is written and read again before the next.

Quality rules drop documents, line dedup drops lines (and documents of which no word is left), near-dedup keeps one
document of each class, mixing repeats or leaves out documents, packing returns the pieces of sequences. All stages but
the last return the columns of documents; n_chars follows the text. An empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepanel.llm.common import read, ship, stored
from tidepanel.llm.lines import dedup_lines
from tidepanel.llm.mixing import mixed_rows
from tidepanel.llm.neardup import one_of_each
from tidepanel.llm.packing import pack
from tidepanel.llm.quality import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    left = dedup_lines(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixed_rows(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
