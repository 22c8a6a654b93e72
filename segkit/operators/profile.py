"""Segment analytics: grouped aggregates, shares, pivots, top-N.

Conventions:
- null group keys are dropped unless ``keep_null=True`` (the reference's group-by
  drops them; Spark's keeps them);
- every aggregate runs with partial (map-side) aggregation, so a hot group is
  pre-reduced inside each input task before the shuffle;
- windows are applied only to already-aggregated rows, partitioned by group;
- a grand total is a scalar subquery, never an unpartitioned window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from segkit.functions.scalar import fixed_round, indicator
from segkit.operators.joins import semi_join  # noqa: F401  (used by the dashboard via this module)

N = "n"


def _drop_null_keys(df: DataFrame, keys, keep_null: bool) -> DataFrame:
    if keep_null:
        return df
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def count_rows(weight: str | None = None) -> Column:
    """Rows; for a table of counted cells, the sum of their counts ``weight``."""
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def group_size(df: DataFrame, keys, keep_null=False, weight: str | None = None) -> DataFrame:
    """A1/A2: rows per group (only observed combinations)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _drop_null_keys(df, keys, keep_null).groupBy(*keys).agg(count_rows(weight).alias(N))


def crosstab(df: DataFrame, a: str, b: str, keep_null=False, weight: str | None = None) -> DataFrame:
    """Long-form contingency table."""
    return group_size(df, [a, b], keep_null, weight)


def segment_profile(df: DataFrame, group: str, age: str = "age", score: str = "satisfaction_score",
                    indicators: dict | None = None, keep_null=False) -> DataFrame:
    """A3: size, average age (1 dp), average score (2 dp), indicator percentages (1 dp)."""
    indicators = indicators if indicators is not None else {
        "corporate_pct": ("client_type", "Corporate"),
        "investment_pct": ("acquisition_purpose", "Investment"),
        "loan_pct": ("loan_applied", "Yes"),
    }
    aggs = [count_rows().alias("size"),
            fixed_round(F.avg(age), 1).alias("avg_age"),
            fixed_round(F.avg(score), 2).alias("avg_score")]
    aggs += [fixed_round(F.avg(indicator(c, v)) * 100, 1).alias(name)
             for name, (c, v) in indicators.items()]
    return _drop_null_keys(df, [group], keep_null).groupBy(group).agg(*aggs)


def group_mode(df: DataFrame, group: str, col: str, alias: str | None = None,
               keep_null=False, weight: str | None = None) -> DataFrame:
    """A4: most frequent ``col`` per group; ties go to the smallest value.

    Two aggregation levels (value counts, then arg-max per group), both partial,
    so neither a hot group nor a high-cardinality column is gathered in one buffer.
    """
    alias = alias or f"top_{col}"
    counts = (_drop_null_keys(df, [group], keep_null).where(F.col(col).isNotNull())
              .groupBy(group, col).agg(count_rows(weight).alias(N)))
    return counts.groupBy(group).agg(
        F.min_by(F.col(col), F.struct(-F.col(N), F.col(col))).alias(alias),
        F.max(N).alias(f"{alias}_n"))


def profile_with_top(df: DataFrame, group: str, top_col: str = "country", **kw) -> DataFrame:
    """A3 joined with A4 on the group key (both sides are per-group aggregates)."""
    top = group_mode(df, group, top_col).drop(f"top_{top_col}_n")
    return segment_profile(df, group, **kw).join(top, on=group, how="left")


def indicator_rate(df: DataFrame, group: str, col: str, value, alias="rate_pct",
                   digits: int = 1) -> DataFrame:
    """Percentage of rows per group where ``col == value``."""
    return (_drop_null_keys(df, [group], False).groupBy(group)
            .agg(fixed_round(F.avg(indicator(col, value)) * 100, digits).alias(alias)))


def share_within(df: DataFrame, group: str, col: str, digits: int = 1, weight: str | None = None) -> DataFrame:
    """Count of each value inside its group and its share of the group (%).

    Totals are an aggregate joined back, so a group with many values is never one task's window.
    """
    counts = crosstab(df, group, col, weight=weight)
    totals = counts.groupBy(group).agg(F.sum(N).alias("_total"))
    return (counts.join(totals, on=group)
            .select(group, col, N, fixed_round(F.col(N) * 100.0 / F.col("_total"), digits).alias("share_pct")))


def share_total(df: DataFrame, col: str, digits: int = 1, weight: str | None = None) -> DataFrame:
    """Count of each value and its share of all (non-null) rows (%)."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(count_rows(weight).alias(N))
    total = counts.select(F.sum(N)).scalar()  # same shuffle as ``counts``: AQE reuses it
    return counts.withColumn("share_pct", fixed_round(F.col(N) * 100.0 / total, digits))


def kpi_row(df: DataFrame, segment: str, score: str = "satisfaction_score",
            flag_col: str = "loan_applied", flag_value="Yes") -> DataFrame:
    """Rows, average score, flag rate %, dominant segment and its share %.

    One shuffle: per-segment partial sums, then a global reduction over segments.
    """
    per = df.groupBy(segment).agg(count_rows().alias(N), F.sum(score).alias("_s"),
                                  F.sum(indicator(flag_col, flag_value)).alias("_f"))
    return kpi_of(per, segment)


def kpi_of(per: DataFrame, segment: str) -> DataFrame:
    """A9 from per-segment states: rows ``n``, sum of scores ``_s``, flagged rows ``_f``."""
    named = F.col(segment).isNotNull()
    out = per.agg(
        F.sum(N).alias("rows"), F.sum("_s").alias("_s"), F.sum("_f").alias("_f"),
        F.min_by(F.col(segment), F.when(named, F.struct(-F.col(N), F.col(segment)))).alias("dominant"),
        F.max(F.when(named, F.col(N))).alias("_dn"))
    return out.select(
        F.col("rows").cast("bigint").alias("rows"),
        fixed_round(F.col("_s") / F.col("rows"), 2).alias("avg_score"),
        fixed_round(F.col("_f") * 100.0 / F.col("rows"), 1).alias("flag_pct"),
        F.col("dominant"),
        fixed_round(F.col("_dn") * 100.0 / F.col("rows"), 1).alias("dominant_pct"))


def distinct_values(df: DataFrame, col: str) -> list:
    """Sorted distinct non-null values, on the driver (they become column names)."""
    return [r[0] for r in df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col).collect()]


def pivot_zero(df: DataFrame, row: str, col: str, values=None, weight: str | None = None) -> DataFrame:
    """A10: wide count matrix, missing cells are 0.  Explicit ``values`` skip a job."""
    values = values if values is not None else distinct_values(df, col)
    src = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    wide = src.groupBy(row).pivot(col, values).agg(count_rows(weight))
    return wide.fillna(0, subset=[str(v) for v in values])


def top_values(df: DataFrame, col: str, n: int = 10, weight: str | None = None) -> DataFrame:
    """O3: the n most frequent values (ties: smaller value first)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(count_rows(weight).alias(N))
              .orderBy(F.desc(N), F.asc(col)).limit(n))


def heat_topn(df: DataFrame, row: str, col: str, n: int = 10, values=None, weight: str | None = None) -> DataFrame:
    """Restrict to the top-n ``row`` values (J1 semi-join), then pivot against ``col``."""
    top = top_values(df, row, n, weight).select(row)
    return pivot_zero(semi_join(df, top, on=row), row, col, values, weight)


def hierarchy_rollup(df: DataFrame, parent: str, child: str, weight: str | None = None) -> DataFrame:
    """Counts at parent and parent+child level (grand total dropped)."""
    src = df.where(F.col(parent).isNotNull() & F.col(child).isNotNull())
    return (src.rollup(parent, child).agg(count_rows(weight).alias(N), F.grouping_id().alias("level"))
               .where(F.col(parent).isNotNull())
               .select(parent, child, F.when(F.col("level") == 0, 2).otherwise(1).alias("depth"), N))


def value_places(df: DataFrame, group: str, x: str, weight: str | None = None) -> DataFrame:
    """(group, x, _rows, before, total): distinct values with their count, the number of smaller rows of the group, and the group's rows.

    (group, value) counts are cut into ranges, written, and summed up inside each (range, group); what precedes a range is a sum over the
    group's ranges.  A group with a third of all values is thus spread over its ranges.  Null values count nowhere.
    """
    from segkit.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    counts = df.where(F.col(x).isNotNull()).groupBy(group, x).agg(count_rows(weight).alias("_rows"))
    cut = counts.repartitionByRange(F.col(group), F.col(x)).withColumn("_range", F.spark_partition_id()).checkpoint()
    inside = Window.partitionBy(group, "_range").orderBy(x).rowsBetween(Window.unboundedPreceding, -1)
    ranges = cut.groupBy(group, "_range").agg(F.sum("_rows").alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranges.select(group, "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"),
                          F.sum("_n").over(Window.partitionBy(group)).alias("total"))
    return (cut.withColumn("_local", F.coalesce(F.sum("_rows").over(inside), F.lit(0))).join(bases, [group, "_range"])
            .select(group, x, "_rows", (F.col("_base") + F.col("_local")).alias("before"), "total"))


def five_number(df: DataFrame, group: str, x: str, exact: bool = True, digits: int = 4, weight: str | None = None) -> DataFrame:
    """Min, quartiles (linear interpolation) and max per group.

    The exact form picks the values at the quartiles' ranks (``value_places``); ``exact=False`` uses ``percentile_approx``.
    """
    src = _drop_null_keys(df, [group], False)
    if not exact:
        q = [F.percentile_approx(F.col(x), p, 10_000) for p in (0.25, 0.5, 0.75)]
        return src.groupBy(group).agg(
            F.min(x).cast("double").alias("min_value"),
            fixed_round(q[0], digits).alias("q1"), fixed_round(q[1], digits).alias("median"),
            fixed_round(q[2], digits).alias("q3"), F.max(x).cast("double").alias("max_value"),
            count_rows().alias(N))
    places = value_places(src, group, x, weight)

    def at(rank):  # the value whose rows hold this rank (from 0)
        return F.max(F.when((rank >= F.col("before")) & (rank < F.col("before") + F.col("_rows")), F.col(x))).cast("double")
    picked = []
    for p in (0.25, 0.5, 0.75):
        place = p * (F.col("total") - 1)
        picked += [at(F.floor(place)).alias(f"_lo{p}"), at(F.ceil(place)).alias(f"_hi{p}"), F.max(place - F.floor(place)).alias(f"_part{p}")]
    wide = places.groupBy(group).agg(F.min(x).cast("double").alias("min_value"), F.max(x).cast("double").alias("max_value"), *picked)
    quartile = lambda p: fixed_round(F.col(f"`_lo{p}`") + F.col(f"`_part{p}`") * (F.col(f"`_hi{p}`") - F.col(f"`_lo{p}`")), digits)
    rows = src.groupBy(group).agg(count_rows(weight).alias(N))  # rows without a value count, and a group of them has no quartiles
    return rows.join(wide, on=group, how="left").select(
        group, "min_value", quartile(0.25).alias("q1"), quartile(0.5).alias("median"), quartile(0.75).alias("q3"), "max_value", N)


def histogram(df: DataFrame, group: str, x: str, lo: float, width: float, bins: int, weight: str | None = None) -> DataFrame:
    """Counts per (group, bin) including empty bins, without a cross join.

    Each group aggregates a fixed-length vector of bin counts in one pass; the
    vector is exploded afterwards, so empty bins appear as 0.
    """
    b = F.floor((F.col(x) - F.lit(lo)) / F.lit(width)).cast("int")
    b = F.least(F.greatest(b, F.lit(0)), F.lit(bins - 1))  # right edge is inclusive
    src = _drop_null_keys(df, [group], False).where(F.col(x).isNotNull())
    per = src.groupBy(group).agg(*[F.sum((b == i).cast("bigint") * (F.lit(1) if weight is None else F.col(weight))).alias(f"b{i}") for i in range(bins)])
    return (per.select(group, F.posexplode(F.array(*[F.col(f"b{i}") for i in range(bins)])).alias("bin", N))
               .select(group, "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).cast("double").alias("bin_start"), N))


def radar_long(df: DataFrame, group: str, metrics: dict) -> DataFrame:
    """Per-group means of scaled metrics, in long form (group, metric, value)."""
    wide = _drop_null_keys(df, [group], False).groupBy(group).agg(
        *[fixed_round(F.avg(e), 4).alias(name) for name, e in metrics.items()])
    return wide.unpivot([group], list(metrics), "metric", "value")


def fixed_groups_stats(df: DataFrame, group: str, groups, score: str = "satisfaction_score",
                       flag_col: str = "acquisition_purpose", flag_value="Investment") -> DataFrame:
    """Size, average score and flag share (%) for a fixed list of groups; a
    group with no rows shows 0 everywhere."""
    spark = df.sparkSession
    dim = spark.createDataFrame([(g,) for g in groups], f"{group} string")
    stats = (df.where(F.col(group).isin(list(groups))).groupBy(group)
               .agg(count_rows().alias(N), F.avg(score).alias("_avg"),
                    F.avg(indicator(flag_col, flag_value)).alias("_flag")))
    return (dim.join(stats, on=group, how="left")
               .select(group, F.coalesce(F.col(N), F.lit(0)).cast("bigint").alias(N),
                       F.coalesce(fixed_round(F.col("_avg"), 2), F.lit(0.0)).alias("avg_score"),
                       F.coalesce(fixed_round(F.col("_flag") * 100, 1), F.lit(0.0)).alias("flag_pct")))


def distinct_counts(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """Number of distinct non-null values per column.

    Exact: (column, value) pairs are made distinct by one aggregate that combines in every task, then counted per column; no
    aggregate holds a column's values.  ``approx`` takes mergeable HyperLogLog sketches.
    """
    if approx:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct_values")) for c in cols])).alias("r")).select("r.*")
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("value")) for i, c in enumerate(cols)])).alias("r"))
    counts = pairs.where(F.col("r.value").isNotNull()).groupBy("r.i", "r.value").agg(F.lit(1).alias("one")).groupBy("i").agg(count_rows().alias(N))
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "i int, column string")
    return names.join(counts, "i", "left").select("column", F.coalesce(F.col(N), F.lit(0)).cast("bigint").alias("distinct_values"))


def cluster_sizes(df: DataFrame, pred: str, k: int) -> DataFrame:
    """Size of every cluster id 0..k-1, zero for empty clusters."""
    spark = df.sparkSession
    ids = spark.range(k).select(F.col("id").cast("int").alias(pred))
    sizes = df.groupBy(pred).agg(count_rows().alias(N))
    return (ids.join(sizes, on=pred, how="left")
               .select(pred, F.coalesce(F.col(N), F.lit(0)).cast("bigint").alias(N)))


def purity(df: DataFrame, cluster: str, truth: str, digits: int = 4) -> DataFrame:
    """Per cluster: size, dominant class and purity, runner-up and its share (aggregates joined back, no window over a cluster)."""
    cont = crosstab(df, cluster, truth)
    best = F.min(F.struct((-F.col(N)).alias("less"), F.col(truth).alias("name")))
    first = cont.groupBy(cluster).agg(F.sum(N).alias("size"), best.alias("_first"))
    second = (cont.join(first, on=cluster).where(F.col(truth) != F.col("_first.name")).groupBy(cluster).agg(best.alias("_second")))
    share = lambda c: fixed_round(-F.col(f"{c}.less") / F.col("size"), digits)
    return first.join(second, on=cluster, how="left").select(
        cluster, F.col("size").cast("bigint").alias("size"), F.col("_first.name").alias("dominant"), share("_first").alias("purity"),
        F.col("_second.name").alias("runner_up"), share("_second").alias("runner_up_share"))


def sort_groups(df: DataFrame, group: str, descending: bool = True, weight: str | None = None) -> DataFrame:
    """O1: groups ordered by size, key as tie-break."""
    order = [F.desc(N) if descending else F.asc(N), F.asc(group)]
    return group_size(df, group, weight=weight).orderBy(*order)


SAMPLE_BUCKETS = 256


def fixed_sample(df: DataFrame, key: str, n: int = 1500, salt: str = "sample") -> DataFrame:
    """A fixed-size, seeded sample: the n rows with the smallest md5(salt:key).

    Two levels: the n smallest of each hash bucket (cut inside every task before the shuffle), then the n smallest of those, so the
    last step sees ``SAMPLE_BUCKETS`` x n rows whatever the number of partitions.
    """
    from segkit.functions.hashing import hash_rank_key
    ranked = df.withColumn("_h", hash_rank_key(salt, key)).withColumn("_b", F.pmod(F.xxhash64("_h"), F.lit(SAMPLE_BUCKETS)))
    first = ranked.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy("_h", key))).where(F.col("_r") <= n)
    return first.orderBy("_h", key).limit(n).drop("_h", "_b", "_r")


def hash_order(df: DataFrame, key: str, salt: str = "shuffle") -> DataFrame:
    """Seeded full shuffle of rows: a range-partitioned sort on md5(salt:key)."""
    from segkit.functions.hashing import hash_rank_key
    return df.withColumn("sort_key", hash_rank_key(salt, key)).orderBy("sort_key", key)


def with_places(df: DataFrame, order: list[Column], out: str = "place") -> DataFrame:
    """Rows with their place (1, 2, 3, ...) in a total order, as a column, so that an order outlives the next shuffle.

    Range partitions are sorted where they land and written; the places of a partition begin behind the rows of those before it (the
    driver sees one count a partition), and no window spans the table.
    """
    from segkit.session import ensure_checkpoint_dir
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_at", 33)
    counts = sorted((r["part"], r[N]) for r in cut.groupBy(part.alias("part")).agg(count_rows().alias(N)).collect())  # one row a partition
    bases, before = [], 0
    for p, n in counts:
        bases.append((p, before))
        before += n
    base = spark.createDataFrame(bases, "_part bigint, _base bigint")
    return (cut.withColumn("_part", part).join(base, "_part")
            .withColumn(out, F.col("_base") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_part", "_base", "_at"))
