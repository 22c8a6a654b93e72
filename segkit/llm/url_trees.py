"""URL filter: rules first, then gradient-boosted trees on lexical features.

* Host and path are cut from the url.  Of the rules that fit (host or one of its parents equal, path begins with the rule's), the
  longest gives the verdict.  The urls that a rule fits are the labelled ones.
* Features of a url: lengths of url, host, path and query, number of labels, depth, share of digits, hyphens, entropy of its
  characters, numbers of parameters, and statistics of its suffixes: for the last host label, the last two and three, the first
  part of the path and the ending of the last, how often labelled urls with that suffix are blocked (smoothed) and how many there are.
* The trees are fitted on about ``sample`` labelled urls, half of them at most, drawn by a hash of the url; statistics count all other
  labelled urls, so that no url's label is among its own statistics.

All of it is DataFrame functions and Spark's own boosted trees.  Statistics are joined by suffix: a small table is broadcast by its
measured size, a large one is joined by sort, and a suffix's rows are told apart by salts, so a host with a third of the urls is
spread over ``SALTS`` tasks.

A null url, or one without ``://``, has an empty host and path, fits no rule, and is judged by the trees like any other; empty
and very long urls have the same features; repeated rows have equal verdicts; extra columns are ignored by ``digest`` and kept by
``allowed_pages``; without labels the verdict is ``allow``, with labels of one kind it is that kind; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segkit.llm.components import written
from segkit.llm.frames import columns, free_name
from segkit.llm.kn_words import DRAWS, draw_limit

RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SAMPLE = 20_000
SALTS = 16
PRIOR = 4.0   # a suffix's share counts as if so many urls of the overall share were added
SUFFIXES = ("top", "two", "three", "folder", "ending")
NUMBERS = ("url_length", "host_length", "path_length", "query_length", "labels", "depth", "digits", "path_digits", "hyphens", "entropy",
           "parameters", "values")


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: str, host_: Column, path_: Column) -> Column:
    name, slash, rest = rule.partition("/")
    return ((host_ == name) | host_.endswith("." + name)) & path_.startswith(slash + rest)


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, url, host, path, rule, ruled): the longest rule that fits, and its verdict; null where none fits."""
    rows = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule = verdict = None
    for name, says in sorted(rules, key=lambda r: -len(r[0])):  # the longest first
        fit = fits(name, F.col("host"), F.col("path"))
        rule = F.when(fit, name) if rule is None else rule.when(fit, name)
        verdict = F.when(fit, says) if verdict is None else verdict.when(fit, says)
    none = F.lit(None).cast("string")
    return rows.withColumn("rule", none if rule is None else rule).withColumn("ruled", none if verdict is None else verdict)


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in nats: the characters are sorted and their runs summed up."""
    chars = F.array_sort(F.split(text, ""))
    run = lambda s: s["run"] * F.log(F.greatest(s["run"], F.lit(1.0)))
    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))
    total = F.aggregate(chars, start, lambda s, c: F.when(s["last"] == c, F.struct(c.alias("last"), (s["run"] + 1.0).alias("run"), s["sum"].alias("sum")))
                        .otherwise(F.struct(c.alias("last"), F.lit(1.0).alias("run"), (s["sum"] + run(s)).alias("sum"))), lambda s: s["sum"] + run(s))
    n = F.char_length(text)
    return F.when(n > 0, F.log(n.cast("double")) - total / n).otherwise(0.0)


def featured(rows: DataFrame) -> DataFrame:
    """``rows`` (url, host, path and others) with the numbers and the suffixes of each url."""
    url, where, way = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    share = lambda text, pattern: count(text, pattern) / F.greatest(F.char_length(text), F.lit(1))
    size = lambda text: F.char_length(text).cast("double")
    return rows.select(
        "*", size(url).alias("url_length"), size(where).alias("host_length"), size(way).alias("path_length"), size(query).alias("query_length"),
        count(where, r"[^.]+").alias("labels"), count(way, r"[^/]+").alias("depth"), share(url, "[0-9]").alias("digits"),
        share(way, "[0-9]").alias("path_digits"), count(where, "-").alias("hyphens"), entropy(url).alias("entropy"),
        count(query, r"[^&]+").alias("parameters"), count(query, "=").alias("values"),
        F.substring_index(where, ".", -1).alias("top"), F.substring_index(where, ".", -2).alias("two"), F.substring_index(where, ".", -3).alias("three"),
        F.regexp_extract(way, "^/([^/]*)/", 1).alias("folder"), F.regexp_extract(way, r"\.([A-Za-z0-9]+)/?$", 1).alias("ending"))


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """(kind, suffix, n, blocked) over all labelled urls."""
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("suffix")) for k in SUFFIXES]))
    return labelled.select(kinds.alias("k"), "label").groupBy("k.kind", "k.suffix").agg(F.count("*").alias("n"), F.sum("label").alias("blocked"))


def with_statistics(rows: DataFrame, counts: DataFrame, overall: float) -> DataFrame:
    """Adds ``<kind>_share`` and ``<kind>_seen`` per kind of suffix."""
    salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("url"), F.lit(SALTS)).cast("int"))
    for kind in SUFFIXES:
        side = salted.where(F.col("kind") == kind).select(F.col("suffix").alias(kind), "salt", "n", "blocked")
        n, blocked = F.coalesce("n", F.lit(0)), F.coalesce("blocked", F.lit(0))
        rows = (rows.join(side, [kind, "salt"], "left")
                .withColumn(kind + "_share", (blocked + PRIOR * overall) / (n + PRIOR)).withColumn(kind + "_seen", F.log1p(n)).drop("n", "blocked"))
    return rows.drop("salt")


def assembled(rows: DataFrame) -> DataFrame:
    names = [*NUMBERS, *[k + "_share" for k in SUFFIXES], *[k + "_seen" for k in SUFFIXES]]
    return VectorAssembler(inputCols=names, outputCol="features").transform(rows)


def fit(labelled: DataFrame, sample: int = SAMPLE, trees: int = 20, depth: int = 4, seed: int = 13) -> dict:
    """Learns from ``labelled`` (featured rows with label: 1 block, 0 allow)."""
    totals = labelled.agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).first()
    n, blocked = totals["n"], totals["blocked"] or 0
    model = {"overall": blocked / n if n else 0.0, "trees": None, "counts": None}
    if not 0 < blocked < n:
        return model
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.coalesce("url", F.lit(""))), F.lit(DRAWS)) < min(draw_limit(sample, n), DRAWS // 2)
    model["counts"] = written(suffix_counts(labelled.where(~drawn)), "suffixes")
    rows = assembled(with_statistics(labelled.where(drawn), model["counts"], model["overall"])).select("url", F.col("label").cast("double").alias("label"), "features")
    # the sample in one order, whatever the layout of the input, so that reruns fit the same trees
    rows = written(rows.repartition(4, "url").sortWithinPartitions("url"), "url-sample")
    if rows.select("label").distinct().count() < 2:
        return model
    model["trees"] = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=seed, maxBins=64).fit(rows)
    return model


def scored(rows: DataFrame, model: dict) -> DataFrame:
    """Featured rows with ``score``: the trees' probability of block (the labels' share where there are no trees)."""
    if model["trees"] is None:
        return rows.withColumn("score", F.lit(float(model["overall"])))
    out = model["trees"].transform(assembled(with_statistics(rows, model["counts"], model["overall"])))
    return out.withColumn("score", vector_to_array("probability")[1])


def filtered(pages: DataFrame, rules=RULES, sample: int = SAMPLE, threshold: float = 0.5) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, score) of every page; score is null where a rule decides."""
    rows = judged(pages, rules)
    label = (F.col("ruled") == "block").cast("int")
    model = fit(featured(rows.where("rule is not null")).withColumn("label", label), sample)
    rest = scored(featured(rows.where("rule is null")), model).select(
        "page_id", "url", "host", "path", "rule", F.when(F.col("score") >= threshold, "block").otherwise("allow").alias("verdict"), "score")
    return rows.where("rule is not null").select("page_id", "url", "host", "path", "rule", F.col("ruled").alias("verdict"), F.lit(None).cast("double").alias("score")).unionByName(rest)


def digest(pages: DataFrame) -> DataFrame:
    """One row per page: host, path, the rule that decides, and the verdict."""
    return filtered(pages).select("page_id", "host", "path", "rule", "verdict", "score")


def allowed_pages(pages: DataFrame, rules=RULES, **how) -> DataFrame:
    """The pages whose url is allowed, with all their columns."""
    verdicts = filtered(pages, rules, **how).where("verdict = 'allow'").select("url").distinct()
    name = free_name(pages, "allowed_url")
    return pages.join(verdicts.toDF(name), pages["url"].eqNullSafe(F.col(name)), "left_semi").select(*columns(pages.columns))
