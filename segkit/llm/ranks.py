"""Running totals and ranks over all rows of a group without one task per group.

Rows are dealt to ``buckets`` by a hash.  Totals per (group, bucket) are aggregated, summed up
over the few buckets, and added to a window inside each (group, bucket).  A group with a third
of all rows is thus spread over ``buckets`` windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segkit.llm.components import written
from segkit.llm.frames import columns, free_name, free_prefix

BUCKETS = 1024


def running_total(df: DataFrame, groups: list[str], size: str, spread: Column, order: list[Column],
                  out: str = "start", buckets: int = BUCKETS) -> DataFrame:
    """Adds ``out``: the sum of ``size`` over the rows of the group before this one.

    The order is (bucket of ``spread``, ``order``); equal keys in ``order`` may come either way.
    Group columns have no nulls.  An empty table stays empty.
    """
    u = free_prefix(df)
    bucket, total, base, local = (u + name for name in ("bucket", "total", "base", "local"))
    df = df.withColumn(bucket, F.pmod(F.xxhash64(spread), F.lit(buckets)).cast("int"))
    keys = [*groups, bucket]
    per = df.groupBy(*keys).agg(F.sum(size).alias(total))
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = per.select(*keys, F.coalesce(F.sum(total).over(before), F.lit(0)).alias(base))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = df.withColumn(local, F.coalesce(F.sum(size).over(inside), F.lit(0)))
    # joined on the window's own keys: the rows stay where the window has put them
    own = columns([c for c in df.columns if c != bucket])
    return (placed.join(bases.hint("merge"), keys)
            .select(*own, (F.col(base) + F.col(local)).cast("long").alias(out)))


def ranked(rows: DataFrame, order: list[Column], out: str = "rank") -> DataFrame:
    """``rows`` with ``out``: 1, 2, 3, ... by ``order`` over the whole table; rows equal in it come either way.

    Range partitions are sorted where they land and written, so that the places stay as they are; the driver sees one
    count per partition.
    """
    own, at = rows.columns, free_name(rows, "at")
    placed = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), "ranked")
    part = F.shiftright(F.col(at), 33)
    counts = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # one row a partition
    total, before = 0, []
    for p, n in counts:
        before.append((p, total))
        total += n
    part_name, base = free_name(rows, "part"), free_name(rows, "base")
    bases = rows.sparkSession.createDataFrame(before, "part long, base long").toDF(part_name, base)
    return (placed.withColumn(part_name, part).join(bases, part_name)
            .select(*columns(own), (F.col(base) + F.col(at).bitwiseAND((1 << 33) - 1) + 1).alias(out)))
