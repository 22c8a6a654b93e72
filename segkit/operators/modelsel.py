"""Model choice over a k-table.

A k-table has one row per candidate k, so it is small by construction (bounded
by the k range); its single-partition windows are intentional.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from segkit.fixed_values import AMBIGUITY_GAP, DEFAULT_K


def knee_point(kt: DataFrame, k: str = "k", y: str = "inertia", default_k: int = DEFAULT_K) -> DataFrame:
    """K5: y normalised by its first value; backward second difference; first arg-max.

    Fewer than 4 points → ``default_k``.  Returns one row ``(elbow_k)``.
    """
    w = Window.orderBy(k)
    first = F.first(F.col(y)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    norm = kt.select(k, (F.col(y) / first).alias("_norm"))
    d1 = norm.withColumn("_d1", F.col("_norm") - F.lag("_norm").over(w))
    d2 = d1.withColumn("_d2", F.col("_d1") - F.lag("_d1").over(w)).where(F.col("_d2").isNotNull())
    best = d2.agg(F.min_by(F.col(k), F.struct(-F.col("_d2"), F.col(k))).alias("_best"))
    n = kt.select(F.count(F.lit(1))).scalar()
    return best.select(F.when(n < 4, F.lit(default_k)).otherwise(F.col("_best")).cast("int").alias("elbow_k"))


def choose_k(kt: DataFrame, k: str = "k", score: str = "silhouette", y: str = "inertia",
             default_k: int = DEFAULT_K, gap: float = AMBIGUITY_GAP) -> DataFrame:
    """K6 + O4: silhouette winner and runner-up; ambiguous gap → default k; elbow agreement.

    Returns one row: (k, winner, runner_up, gap, elbow_k, decision).
    """
    ranked = kt.select(k, score).withColumn(
        "_r", F.row_number().over(Window.orderBy(F.desc(score), F.asc(k)))).where("_r <= 2")
    top = ranked.agg(F.max(F.when(F.col("_r") == 1, F.col(k))).alias("winner"),
                     F.max(F.when(F.col("_r") == 2, F.col(k))).alias("runner_up"),
                     F.max(F.when(F.col("_r") == 1, F.col(score))).alias("_s1"),
                     F.max(F.when(F.col("_r") == 2, F.col(score))).alias("_s2"))
    elbow = knee_point(kt, k, y, default_k).scalar()
    g = F.col("_s1") - F.col("_s2")
    ambiguous = g < F.lit(gap)
    decision = (F.when(ambiguous, F.lit("ambiguous"))
                 .when(F.col("winner") == elbow, F.lit("agree"))
                 .otherwise(F.lit("silhouette")))
    return top.select(
        F.when(ambiguous, F.lit(default_k)).otherwise(F.col("winner")).cast("int").alias("k"),
        F.col("winner").cast("int").alias("winner"), F.col("runner_up").cast("int").alias("runner_up"),
        g.alias("gap"), elbow.cast("int").alias("elbow_k"), decision.alias("decision"))

