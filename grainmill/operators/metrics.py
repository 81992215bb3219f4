"""Funnel metrics of generate-validate-evaluate batches: one pass of conditional counts per report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions.scalars import safe_ratio

FUNNEL = ["total", "generated", "structural", "functional", "evaluated", "learnable"]


def generated_all_time() -> Column:
    """Counts as generated in all-time metrics: no generation failure, first or retried, no error."""
    s = F.coalesce(F.col("status"), F.lit(""))
    return ~s.isin("generation_failed", "retry_generation_failed") & ~s.startswith("error")


def generated_per_batch() -> Column:
    """Counts as generated in a batch's own report, where a failed retry still counts."""
    s = F.coalesce(F.col("status"), F.lit(""))
    return (s != "generation_failed") & ~s.startswith("error")


def succeeded() -> Column:
    """Kept for diversity: the status is neither of the two exact failure words."""
    return ~F.coalesce(F.col("status"), F.lit("")).isin("generation_failed", "error")


def truthy(c: str) -> Column:
    return F.coalesce(F.col(c) != "", F.lit(False))


def flag(c: str) -> Column:
    """True only for a literal true; a missing struct or leaf is false."""
    return F.coalesce(F.col(c), F.lit(False))


def error_category() -> Column:
    """Failed stage if given, else by the status; null for completed rows."""
    s, stage = F.coalesce(F.col("status"), F.lit("")), F.col("failed_stage")
    by_status = (
        F.when((s == "generation_failed") | s.startswith("phase"), "generation")
        .when(s.contains("structural"), "structural")
        .when(s.contains("functional") | s.contains("infrastructure"), "functional")
        .when(s.startswith("error"), "exception")
        .otherwise("other")
    )
    return F.when(s != "completed", F.coalesce(F.nullif(stage, F.lit("")), by_status))


def funnel_aggregates(generated: Column | None = None, evaluated: Column | None = None) -> list[Column]:
    c = F.col("classification")
    return [
        F.count("*").alias("total"),
        F.count_if(generated_all_time() if generated is None else generated).alias("generated"),
        F.count_if(flag("stages.structural.passed")).alias("structural"),
        F.count_if(flag("stages.functional.passed")).alias("functional"),
        F.count_if(truthy("classification") if evaluated is None else evaluated).alias("evaluated"),
        *[F.count_if(F.coalesce(c == v, F.lit(False))).alias(n) for v, n in (("learnable", "learnable"), ("too_easy", "too_easy"), ("too_hard", "too_hard"))],
        F.coalesce(F.sum("stages.generate.usage.total_tokens"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.round(F.col("duration_sec") * 10).cast("long")), F.lit(0)).alias("duration_ds"),
    ]


def with_rates(df: DataFrame, places: int | None = None) -> DataFrame:
    """Yield of learnable rows, functional rate of generated ones, learnable rate of evaluated ones; 0 on empty denominators.

    ``places``: decimals of a printed report, half to even; by default unrounded.
    """
    pairs = {"learnable_yield": ("learnable", "total"), "functional_rate": ("functional", "generated"), "learnable_rate": ("learnable", "evaluated")}
    rates = {k: safe_ratio(F.col(a), F.col(b)) for k, (a, b) in pairs.items()}
    return df.withColumns(rates if places is None else {k: F.bround(c, places) for k, c in rates.items()})


def batch_summary(df: DataFrame, usage: DataFrame, by: str) -> DataFrame:
    """One report row per group: funnel counts, rows that were tested functionally, the map of error categories, tokens and their
    weighted cost, mean duration and cost per learnable row (0 without any). ``usage``: by, prompt, completion, cost_units."""
    counts = funnel(df, [by]).withColumn("duration_min", F.bround(F.col("duration_ds") / 600, 1))
    more = df.groupBy(by).agg(
        F.count_if(F.col("stages.functional").isNotNull()).alias("functional_tested"),
        F.coalesce(F.try_divide(F.bround(F.sum("duration_sec"), 3), F.count("*")), F.lit(0.0)).alias("mean_duration"),
    )
    kinds = df.select(by, error_category().alias("k")).where("k is not null").groupBy(by, "k").agg(F.count("*").alias("n"))
    kinds = kinds.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias("errors"))  # one entry per category
    got = counts.join(more, by).join(kinds, by, "left").join(usage, by, "left")
    costs = F.coalesce("cost_units", F.lit(0))
    return got.withColumns({"cost_units": costs, "cost_per_learnable": F.coalesce(F.try_divide(costs, F.col("learnable")), F.lit(0.0)), "errors": F.coalesce("errors", F.create_map().cast("map<string,bigint>"))})


def evaluation_usage(trials: DataFrame, tiers: DataFrame, rates: DataFrame, link: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Tokens of the trials of all tiers, weighted by a table of rates per model (model, input_rate, output_rate); unknown models weigh 0."""
    rows = trials.join(tiers.select(*link, "model"), list(link), "left").join(rates, "model", "left")
    i, o = F.coalesce("input_tokens", F.lit(0)), F.coalesce("output_tokens", F.lit(0))
    cost = i * F.coalesce("input_rate", F.lit(0)) + o * F.coalesce("output_rate", F.lit(0))
    return rows.groupBy(*by).agg(F.sum(i).alias("input_tokens"), F.sum(o).alias("output_tokens"), F.sum(cost).alias("cost_units"))


def batch_trend(df: DataFrame, usage: DataFrame, by: str) -> DataFrame:
    """by, learnable, yield_pct (one decimal), cost_units and cost per learnable row (two decimals, 0 without any)."""
    n = F.count_if(F.coalesce(F.col("classification") == "learnable", F.lit(False)))
    got = df.groupBy(by).agg(n.alias("learnable"), F.bround(100 * n / F.count("*"), 1).alias("yield_pct"))
    cost = F.coalesce("cost_units", F.lit(0))
    each = F.coalesce(F.bround(F.try_divide(cost, F.nullif(F.col("learnable"), F.lit(0))), 2), F.lit(0.0))
    return got.join(usage.select(by, "cost_units"), by, "left").select(by, "learnable", "yield_pct", cost.alias("cost_units"), each.alias("cost_per_learnable"))


def header_counts(df: DataFrame, stage: Column, cost: Column, by: Sequence[str] = ()) -> DataFrame:
    """Total, done (completed or failed), running, failed and the classes of tasks, and the cost per learnable one (0 without any)."""
    c, completed, failed = F.col("classification"), F.count_if(stage == "completed"), F.count_if(stage == "failed")
    learnable = F.count_if(c == "learnable")
    return df.groupBy(*by).agg(
        F.count("*").alias("total"), (completed + failed).alias("done"), F.count_if(stage.isin("generating", "structural", "functional", "evaluating")).alias("running"), failed.alias("failed"),
        learnable.alias("learnable"), F.count_if(c == "too_easy").alias("too_easy"), F.count_if(c == "too_hard").alias("too_hard"),
        F.coalesce(F.try_divide(F.sum(cost), learnable), F.lit(0.0)).alias("cost_per_learnable"),
    )


def funnel(df: DataFrame, by: Sequence[str] = (), overall: bool = False) -> DataFrame:
    """Funnel counts and rates, per group and, with ``overall``, for all rows together (null group) in the same pass."""
    got = df.rollup(*by) if overall and by else df.groupBy(*by)
    return with_rates(got.agg(*funnel_aggregates()))


def funnel_steps(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Long form: step_no, step, n and its ratio to the step before."""
    steps = F.array(*[F.struct(F.lit(i).alias("step_no"), F.lit(s).alias("step"), F.col(s).alias("n")) for i, s in enumerate(FUNNEL)])
    w = Window.partitionBy(*by).orderBy("step_no")
    long = counts.select(*by, F.inline(steps))
    return long.withColumn("conversion", F.when(F.col("step_no") > 0, safe_ratio(F.col("n"), F.lag("n").over(w))))


def stage_usage(df: DataFrame, key: str) -> DataFrame:
    """One row per generation-like stage of a record: the static generate stage and the dynamic retry_N and adjustment keys."""
    first = F.array(F.struct(F.lit("generate").alias("stage"), F.col("stages.generate.usage.prompt_tokens").alias("prompt"), F.col("stages.generate.usage.completion_tokens").alias("completion")))
    more = F.transform(
        F.filter(F.map_entries("extra_stages"), lambda e: e["key"].rlike("^(regenerate|retry_|difficulty_adj_)")),
        lambda e: F.struct(e["key"].alias("stage"), e["value"]["usage"]["prompt_tokens"].alias("prompt"), e["value"]["usage"]["completion_tokens"].alias("completion")),
    )
    rows = df.select(key, "batch", F.inline(F.concat(first, F.coalesce(more, F.array()))))
    return rows.select(key, "batch", "stage", F.coalesce("prompt", F.lit(0)).alias("prompt"), F.coalesce("completion", F.lit(0)).alias("completion"))


def weighted_usage(usage: DataFrame, rates: DataFrame, by: Sequence[str]) -> DataFrame:
    """Token sums weighted by a rate table (kind, prompt_rate, completion_rate) keyed by the stage's kind; no rates are built in."""
    kind = F.regexp_replace("stage", "_[0-9]+$", "")
    rows = usage.withColumn("kind", kind).join(rates, "kind", "left")
    cost = F.col("prompt") * F.coalesce("prompt_rate", F.lit(0)) + F.col("completion") * F.coalesce("completion_rate", F.lit(0))
    return rows.groupBy(*by).agg(F.sum("prompt").alias("prompt"), F.sum("completion").alias("completion"), F.sum(cost).alias("cost_units"))
