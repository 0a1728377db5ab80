"""The corpus pipeline: quality rules, line removal, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; what it returns is written as Parquet, and the
next stage reads that. All but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import bin_slack, line_spread, ngram_join, quality_rules
from rollbook.llm.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, as they are."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that spread over sites; ``n_chars`` follows the text."""
    return line_spread.without_spread(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates (80 percent of five-word shingles), that with the least id."""
    return ngram_join.keep_first(docs, single=True, percent=80, size=5)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 1024 tokens."""
    return bin_slack.pack(docs)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("ngram_join", near_duplicates), ("packing", packing)]

#: Tokenizing and packing have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
