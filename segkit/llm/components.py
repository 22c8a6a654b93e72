"""Connected components of an edge table by alternating large-star and small-star rounds.

Each round is two aggregates and two joins, written to the shared folder (lineage ends there).
Vertices and links never reach the driver; it sees one count and one checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segkit.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(u, root) for every vertex that is not its component's smallest; ``edges`` has long columns u and v."""
    def pairs(df):
        return df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    now = written(pairs(edges), name)
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select("u", F.col("v").alias("root"))
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a vertex without larger neighbours keeps its own link to its smallest neighbour
        large = pairs(large)
        least2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least2.select("u", F.col("m").alias("v")))
        now = written(pairs(small), name)
