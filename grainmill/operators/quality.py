"""Cohort statistics, comparison and outliers over feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions.scalars import line_count, test_functions
from grainmill.operators.ranks import at_ranks, middle_ranks


def unpivoted(df: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """key, metric, value (double), one row per non-null metric."""
    cols = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return df.select(key, F.inline(cols)).where("value is not null")


def cohort_stats(df: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """metric, n, least, greatest, mean, median of every metric; a metric without values has no row."""
    rows = unpivoted(df, key, metrics)
    lower, upper = middle_ranks(F.col("n"))
    middle = at_ranks(rows, ["metric"], "value", {"lo": lower, "hi": upper}).select("metric", ((F.col("lo") + F.col("hi")) / 2).alias("median"))
    plain = rows.groupBy("metric").agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("greatest"), F.avg("value").alias("mean"))
    return plain.join(middle, "metric")


def compare_cohorts(a: DataFrame, b: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """Statistics of both cohorts side by side; a metric that only one has keeps nulls for the other."""
    x = cohort_stats(a, key, metrics).select("metric", *[F.col(c).alias(f"a_{c}") for c in ("n", "mean", "median")])
    y = cohort_stats(b, key, metrics).select("metric", *[F.col(c).alias(f"b_{c}") for c in ("n", "mean", "median")])
    return x.join(y, "metric", "full_outer")


def outliers(rows: DataFrame, reference: DataFrame, key: str, metrics: Sequence[str], slack: float = 0.5) -> DataFrame:
    """Values beyond the reference range by more than ``slack`` of its width (1 where it has none)."""
    span = unpivoted(reference, key, metrics).groupBy("metric").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = F.when(F.col("hi") == F.col("lo"), 1.0).otherwise(F.col("hi") - F.col("lo"))
    span = span.select("metric", "lo", "hi", (F.col("lo") - width * slack).alias("under"), (F.col("hi") + width * slack).alias("over"))
    # one row per metric: bounded by the columns named
    return unpivoted(rows, key, metrics).join(F.broadcast(span), "metric").where("value < under or value > over").select(key, "metric", "value", "lo", "hi")


def true_shares(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """flag, n_true, share of rows."""
    per = df.agg(F.count("*").alias("_n"), *[F.count_if(F.coalesce(F.col(f), F.lit(False))).alias(f) for f in flags])
    cols = F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("n_true")) for f in flags])
    return per.select("_n", F.inline(cols)).select("flag", "n_true", F.coalesce(F.try_divide("n_true", "_n"), F.lit(0.0)).alias("share"))


def modes(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """The most frequent value per group; ties go to the smallest value."""
    n = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    return n.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias("mode"), F.max("n").alias("n"))


def class_patterns(df: DataFrame, label: str, metrics: Sequence[str], kinds: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Averages per class, and the distribution of an array-valued kind per class with its share."""
    avgs = df.groupBy(label).agg(F.count("*").alias("n"), *[F.avg(m).alias(f"avg_{m}") for m in metrics])
    if kinds is None:
        return avgs, None
    dist = df.select(label, F.explode(kinds).alias("kind")).groupBy(label, "kind").agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy(label))  # over kinds, not rows
    return avgs, dist.withColumn("share", F.col("n") / whole)


def findings(patterns: DataFrame, label: str, base: str, other: str, rules: Sequence[tuple[str, str, float]]) -> DataFrame:
    """finding: metrics of class ``other`` beyond those of ``base`` by a rule (metric, 'plus', 'times' or 'minus', amount); 'minus' finds metrics below."""
    pick = lambda c, m: F.max(F.when(F.col(label) == c, F.col(m)))
    wide = patterns.agg(*[pick(c, m).alias(f"{s}_{m}") for s, c in (("b", base), ("o", other)) for m, _, _ in rules])
    o, b = (lambda m: F.col(f"o_{m}")), (lambda m: F.col(f"b_{m}"))
    beyond = {"plus": lambda m, x: o(m) > b(m) + x, "times": lambda m, x: o(m) > b(m) * x, "minus": lambda m, x: o(m) < b(m) - x}
    tests = [F.when(beyond[how](m, x), F.lit(m)) for m, how, x in rules]
    return wide.select(F.explode(F.array_compact(F.array(*tests))).alias("finding"))


def share_findings(patterns: DataFrame, dist: DataFrame, label: str, base: str, other: str, margin: float = 0.15) -> DataFrame:
    """kind, base_share, other_share, more_in: kinds whose shares of two classes, both present in ``patterns``, differ by more than ``margin``; a kind that a class lacks has share 0."""
    share = lambda c: F.coalesce(F.max(F.when(F.col(label) == c, F.col("share"))), F.lit(0.0))
    both = patterns.where(F.col(label).isin(base, other)).agg(F.countDistinct(label).alias("_n")).where("_n = 2")
    got = dist.where(F.col(label).isin(base, other)).groupBy("kind").agg(share(base).alias("base_share"), share(other).alias("other_share"))
    more = F.when(F.col("other_share") > F.col("base_share") + margin, other).when(F.col("base_share") > F.col("other_share") + margin, base)
    return got.withColumn("more_in", more).where("more_in is not null").crossJoin(F.broadcast(both)).drop("_n")  # one row at most


def position_gaps(df: DataFrame, key: str, positions: str, total: Column) -> DataFrame:
    """largest and mean gap between sorted positions and their span over ``total`` (two decimals); zeros below two positions."""
    p = F.array_sort(positions)
    gaps = F.zip_with(F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, F.lit(1), F.greatest(F.size(p) - 1, F.lit(0))), lambda a, b: a - b)
    few = F.size(p) < 2
    span = F.element_at(p, -1) - F.element_at(p, 1)
    return df.select(key, F.when(few, 0).otherwise(F.array_max(gaps)).alias("max_gap"),
                     F.when(few, 0.0).otherwise(F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x) / F.size(gaps)).alias("avg_gap"),
                     F.when(few, 0.0).otherwise(F.bround(F.coalesce(F.try_divide(span, total), F.lit(0.0)).cast("double"), 2)).alias("spread"))


def task_quality(files: DataFrame, key: str, path: str, content: str) -> DataFrame:
    """Structural features of each task directory from its file rows; a missing file leaves its metric null."""
    name, root = F.element_at(F.split(path, "/"), -1), ~F.col(path).contains("/")
    text = F.col(content)
    one = lambda f, e: F.max(F.when(root & (name == f), e))
    tests = F.col(path).startswith("tests/") & F.col(path).endswith(".py")
    return files.groupBy(key).agg(
        F.count("*").alias("n_files"),
        one("Dockerfile", line_count(text)).alias("dockerfile_lines"),
        one("solution.sh", line_count(text)).alias("solution_lines"),
        one("run-tests.sh", line_count(text)).alias("run_tests_lines"),
        F.sum(F.when(tests, test_functions(text))).alias("n_tests"),
        F.sum(F.when(tests, line_count(text))).alias("test_lines"),
        F.coalesce(F.max(root & (name == "docker-compose.yaml")), F.lit(False)).alias("has_compose"),
        F.sum(F.floor(F.octet_length(text) / 4)).alias("approx_tokens"),
    )
