"""Queries of the subpackage: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segkit.llm import sql
from segkit.session import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark, sf_dir):
    """Main text of every page."""
    from segkit.llm.html_blocks import digest
    return digest(_table(spark, sf_dir, "pages"))


def op2_lm_score(spark, sf_dir):
    """Bigram Kneser-Ney score of every document."""
    from segkit.llm.kn_words import digest
    return digest(_table(spark, sf_dir, "documents"), order=2)


def op3_jaccard_join(spark, sf_dir):
    """Near-duplicate components of documents: 3-word shingles, Jaccard of 0.9 or more."""
    from segkit.llm.jaccard_rtree import similar_components
    return similar_components(_table(spark, sf_dir, "documents"), n=3, percent=90).drop("mark")


def op4_decontaminate(spark, sf_dir):
    """Words of documents inside 13-word windows of benchmark items."""
    from segkit.llm.winnowing import digest
    return digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_language(spark, sf_dir):
    """Predicted language of every document."""
    from segkit.llm.kn_langid import digest
    return digest(_table(spark, sf_dir, "documents"))


def op6_fingerprints(spark, sf_dir):
    """Syncmer fingerprints of documents and of their edited texts."""
    from segkit.llm.syncmers import digest
    return digest(_table(spark, sf_dir, "documents"))


def op7_mix(spark, sf_dir):
    """Words of each document that the mix takes."""
    from segkit.llm.mixing import digest
    return digest(_table(spark, sf_dir, "documents"))


def op8_training_order(spark, sf_dir):
    """Token sequences of all documents in keyed random order, written as fixed-stride shards."""
    from segkit.llm.materialise import digest
    return digest(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    from segkit.llm.toxicity import digest
    return digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_shards(spark, sf_dir):
    """Uniform shuffle of documents into 40 shards of exact row counts."""
    from segkit.llm.shard_shuffle import digest
    return digest(_table(spark, sf_dir, "documents"))


def op11_importance(spark, sf_dir):
    """Importance-resampled documents after the distribution of the benchmark's word n-grams."""
    from segkit.llm.importance import digest
    return digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_spelling(spark, sf_dir):
    """Spelling variants of the documents' words: near words, form and root."""
    from segkit.llm.spelling import digest
    return digest(_table(spark, sf_dir, "documents"))


def op13_urls(spark, sf_dir):
    """Host, path, rule and verdict of every page's url."""
    from segkit.llm.url_trees import digest
    return digest(_table(spark, sf_dir, "pages"))


def edited_texts(spark, sf_dir):
    """What op6 compares each document with: its length, and the hash of its edited text."""
    return op6_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def mix_targets(spark, sf_dir):
    """What op7 aims at: each document's words, its source's words and target."""
    return op7_mix(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


def shard_slots(spark, sf_dir):
    """What op10 promises: rows of each shard, and its slots from the first to the last."""
    return op10_shards(spark, sf_dir).groupBy("shard").agg(
        F.count("*").alias("rows"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"), F.count_distinct("slot").alias("slots"))


QUERIES = {f.__name__: f for f in (op1_main_text, op2_lm_score, op3_jaccard_join, op4_decontaminate, op5_language, op6_fingerprints,
                                   op7_mix, op8_training_order, op9_toxicity, op10_shards, op11_importance, op12_spelling, op13_urls,
                                   edited_texts, mix_targets, shard_slots)}
ORACLE: dict[str, str] = {"op4_decontaminate": sql.CONTAMINATION, "op11_importance": sql.IMPORTANCE, "op12_spelling": sql.SPELLING,
                          "edited_texts": sql.EDITED, "mix_targets": sql.MIX_TARGETS, "shard_slots": sql.SHARD_SLOTS}
