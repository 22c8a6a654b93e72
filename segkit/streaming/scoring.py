"""Scoring of new buyer records, batch (K9) and Structured Streaming.

The scorer is a stateless projection (impute with the fitted fill values →
age → encode → nearest centre), so the same function serves a batch
DataFrame and a ``readStream`` source.  Streaming output goes to a file sink
with its checkpoint in the shared folder, so a restarted query resumes
exactly once.

Running totals per segment (rows, and sum and sum of squares of each numeric feature) live in Spark's state store, so they go on where they
stopped.  Each micro-batch writes the totals whole, in one file of a folder of its own, so that a repeated batch replaces what it
wrote and a reader sees a batch's totals or those of the batch before.  Segment sizes and the drift of the features follow from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segkit.operators.features import FeatureModel
from segkit.operators.impute import ImputeModel
from segkit.operators.kmeans import KMeansRun, assign
from segkit.plans.clean import add_age


def score(df: DataFrame, features: FeatureModel, kmeans: KMeansRun, imputer_fills: dict | None = None,
          key: str = "client_id", output: str = "cluster") -> DataFrame:
    """Label new rows with the nearest k-means centre."""
    return scored_rows(df, features, kmeans, imputer_fills, output).select(key, output)


def scored_rows(df: DataFrame, features: FeatureModel, kmeans: KMeansRun, imputer_fills: dict | None = None, output: str = "cluster") -> DataFrame:
    """The cleaned new rows with their label."""
    src = ImputeModel.from_dict(imputer_fills).transform(df) if imputer_fills else df
    if "date_of_birth" in src.columns and "age" not in src.columns:
        src = add_age(src)
    enc = features.transform(src, "_features")
    return assign(enc, kmeans.centers, "_features", output).drop("_features")


def score_stream(spark: SparkSession, source_dir: str, schema, features: FeatureModel, kmeans: KMeansRun,
                 sink_dir: str, checkpoint_dir: str, imputer_fills: dict | None = None,
                 max_files_per_trigger: int | None = None):
    """Start a streaming scorer over parquet files arriving in ``source_dir``.

    Uses ``availableNow`` (process what is there, then stop); call again later
    to pick up new files.  Returns the ``StreamingQuery``.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    scored = score(stream, features, kmeans, imputer_fills)
    return (scored.writeStream.format("parquet").option("path", sink_dir)
                  .option("checkpointLocation", checkpoint_dir).outputMode("append")
                  .trigger(availableNow=True).start())


def totals_schema(numeric, output: str = "cluster") -> str:
    return f"{output} int, n bigint, " + ", ".join(f"sum_{c} double, squares_{c} double" for c in numeric) + ", batch bigint"


def stream_totals(spark: SparkSession, source_dir: str, schema, features: FeatureModel, kmeans: KMeansRun, totals_dir: str, checkpoint_dir: str,
                  imputer_fills: dict | None = None, max_files_per_trigger: int | None = None, output: str = "cluster"):
    """Start (or go on with) the running totals of the rows arriving in ``source_dir``; returns the ``StreamingQuery``.

    The state has one row a segment, whatever the stream's length.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = scored_rows(reader.parquet(source_dir), features, kmeans, imputer_fills, output)
    value = lambda c: F.col(c).cast("double")
    states = [s for c in features.numeric for s in (F.sum(value(c)).alias(f"sum_{c}"), F.sum(value(c) * value(c)).alias(f"squares_{c}"))]
    totals = rows.groupBy(output).agg(F.count(F.lit(1)).alias("n"), *states)

    def write(batch: DataFrame, number: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(f"{totals_dir}/batch={number}")  # one row a segment
    return (totals.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True).start())


def latest_totals(spark: SparkSession, totals_dir: str, features: FeatureModel, output: str = "cluster") -> DataFrame:
    """The totals of the last batch that was written whole."""
    rows = spark.read.schema(totals_schema(features.numeric, output)).parquet(totals_dir)
    return rows.where(F.col("batch") == rows.agg(F.max("batch")).scalar()).drop("batch")


def segment_drift(totals: DataFrame, features: FeatureModel, output: str = "cluster") -> DataFrame:
    """(segment, n, column, mean, deviation, drift): ``drift`` is the mean's distance from the fitted mean, in fitted deviations."""
    def state(c):
        mean = F.col(f"sum_{c}") / F.col("n")
        sd = F.sqrt(F.greatest(F.col(f"squares_{c}") / F.col("n") - mean * mean, F.lit(0.0)))
        return F.struct(F.lit(c).alias("column"), mean.alias("mean"), sd.alias("deviation"), ((mean - features.means[c]) / features.scales[c]).alias("drift"))
    return totals.select(output, "n", F.explode(F.array(*[state(c) for c in features.numeric])).alias("s")).select(output, "n", "s.*")
