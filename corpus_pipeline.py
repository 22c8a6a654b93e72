"""A corpus pipeline of five stages over the documents table, each written as Parquet and read again.

language ID -> near-duplicate removal -> benchmark decontamination -> source mixing -> sharding

A stage works on all that its predecessor kept.  All but the last return the columns of documents; the last adds shard and slot.
Stage functions take (spark, docs, sf_dir) and return a DataFrame.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from segkit.llm import jaccard_rtree, kn_langid, mixing, shard_shuffle, winnowing  # noqa: E402
from segkit.session import scratch_path, ship_package  # noqa: E402


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told: no letter, or a text unlike all learned languages, goes."""
    ship_package(spark)
    return kn_langid.identified_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 3-word shingles link at a Jaccard index of 0.9 or more."""
    ship_package(spark)
    return jaccard_rtree.first_documents(docs, n=3, percent=90)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than 5 % of the words lie in 13-word windows of the benchmark."""
    ship_package(spark)
    return winnowing.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    ship_package(spark)
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard and the slot that a uniform shuffle gives them."""
    ship_package(spark)
    return shard_shuffle.shuffled_documents(docs, shards=40)


STAGES = [("language ID", language), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontaminate),
          ("mixing sources", mix), ("sharding", shard)]

#: SQL can't express the language model; tests/llm/test_pipeline.py checks three stages' rows against plain Python, language ID and mixing by bounds.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
