"""Trial results: pass@k, accuracy, failure modes, early stopping and tier cascades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions.scalars import safe_ratio


def all_passed(results: Column) -> Column:
    """Whether every test of a parsed result passed: an empty result is resolved, a missing one is not."""
    return F.when(results.isNull(), False).otherwise(F.forall(F.map_values(results), lambda v: F.coalesce(v == "passed", F.lit(False))))


def tests_passed(results: Column) -> tuple[Column, Column]:
    """(tests passed, tests run) of a parsed result; 0 and 0 where it is missing."""
    passed = F.size(F.map_filter(results, lambda _, v: F.coalesce(v == "passed", F.lit(False))))
    return F.when(results.isNull(), 0).otherwise(passed), F.when(results.isNull(), 0).otherwise(F.size(results))


def pass_at_k(n: Column, c: Column, k: Column) -> Column:
    """Unbiased estimate 1 - prod((n - c - j) / (n - j)) for j < k; 1 if fewer than k attempts failed, 0 if none passed.

    k terms, whatever the number of passes: a task may hold a third of all attempts.
    """
    fold = F.aggregate(F.sequence(F.lit(0).cast("long"), k.cast("long") - 1), F.lit(1.0), lambda acc, j: acc * ((n - c - j) / (n - j)))
    return F.when(c == 0, 0.0).when(n - c < k, 1.0).otherwise(1.0 - fold)


def pass_at_k_table(trials: DataFrame, task: str, resolved: Column) -> DataFrame:
    """k, n_tasks, pass_at_k: mean over the tasks with k or more attempts.

    k runs over the powers of two up to the least number of attempts, and 5 and 10 where it allows.
    """
    per = trials.groupBy(task).agg(F.count("*").alias("n"), F.count_if(F.coalesce(resolved, F.lit(False))).alias("c"))
    n = F.col("n")
    powers = F.transform(F.sequence(F.lit(0), F.floor(F.log2("n")).cast("int")), lambda e: F.pow(F.lit(2), e).cast("long"))
    extra = F.filter(F.array(F.lit(5).cast("long"), F.lit(10).cast("long")), lambda x: x <= n)
    rows = per.withColumn("k", F.explode(F.array_distinct(F.concat(powers, extra))))
    got = rows.groupBy("k").agg(F.count("*").alias("n_tasks"), F.avg(pass_at_k(n, F.col("c"), F.col("k"))).alias("pass_at_k"))
    # k is within the least number of attempts if every task meets it, as every task meets k = 1; one row per k here
    return got.withColumn("_all", F.max("n_tasks").over(Window.partitionBy())).where("n_tasks = _all").drop("_all")


def run_accuracy(trials: DataFrame, by: Sequence[str], resolved: Column) -> DataFrame:
    """Resolved and unresolved counts and accuracy; a null outcome is unresolved."""
    r = F.coalesce(resolved, F.lit(False))
    got = trials.groupBy(*by).agg(F.count_if(r).alias("n_resolved"), F.count_if(~r).alias("n_unresolved"))
    return got.withColumn("accuracy", safe_ratio(F.col("n_resolved"), F.col("n_resolved") + F.col("n_unresolved")))


def run_outcomes(trials: DataFrame, run: str, trial: str, resolved: Column) -> DataFrame:
    """The id lists of a run as rows, since a run may hold a third of all trials: run, trial, outcome; a null outcome is unresolved."""
    return trials.select(run, trial, F.when(F.coalesce(resolved, F.lit(False)), "resolved").otherwise("unresolved").alias("outcome"))


def failure_modes(trials: DataFrame, mode: str, resolved: Column) -> DataFrame:
    """Failure modes of unresolved trials: count and share of all trials."""
    r = F.coalesce(resolved, F.lit(False))
    counts = trials.groupBy(F.coalesce(F.col(mode), F.lit("unset")).alias("failure_mode")).agg(F.count_if(~r).alias("n"), F.count("*").alias("_all"))
    # one row per mode: the window is over the modes, not the trials
    whole = F.sum("_all").over(Window.partitionBy())
    return counts.withColumn("share", F.col("n") / whole).where("n > 0").select("failure_mode", "n", "share")


def settle_failure(agent: Column, test: Column, parse_error: Column) -> Column:
    """One failure mode per trial: a parse error overrides all, an agent failure sticks, a test failure fills an unset one."""
    unset = F.lit("unset")
    return F.when(parse_error, "parse_error").when(F.coalesce(agent, unset) != "unset", agent).when(F.coalesce(test, unset) != "unset", test).otherwise(unset)


def failure_of(exception: Column, table: dict[str, str], default: str = "unknown_agent_error") -> Column:
    """Failure mode of an exception's class name, by a table of fixed values given by the caller."""
    m = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(m, exception), F.lit(default))


def early_stop(trials: DataFrame, task: str, order: Sequence[str], resolved: Column, n: int = 5, first: int = 3, low: int = 1, high: int = 3, skip_at: int | None = None, prior: tuple[int, int] = (0, 0)) -> DataFrame:
    """task, decided_at, passes, decision: the first point at which the outcome is certain.

    Trials run ``first`` together, then one at a time up to ``n``; only from the first wave on is a
    decision looked for. With ``skip_at`` the question is whether that many passes are reached (skip or
    proceed), else the class: low..high passes are learnable. ``prior`` holds passes and total of an
    interrupted run. Undecided tasks (too few trials) have a null decision. The window per task needs at
    most n rows of each, so the running counts are taken over the first n trials by a top-n aggregate.
    """
    r = F.coalesce(resolved, F.lit(False)).cast("int")
    seq = F.struct(*[F.col(c) for c in order], r.alias("_r"))
    w = Window.partitionBy(task).orderBy(*order)
    top = trials.select(task, *order, seq.alias("_s")).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n - prior[1])
    per = top.groupBy(task).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", F.col("_s._r").alias("r")))), lambda x: x["r"]).alias("rs"))
    points = F.filter(F.sequence(F.lit(1), F.size("rs")), lambda i: (i + prior[1] >= first))
    state = F.transform(points, lambda i: F.struct((i + prior[1]).alias("at"), (F.aggregate(F.slice("rs", F.lit(1), i), F.lit(prior[0]), lambda a, x: a + x)).alias("p")))

    def decide(s: Column) -> Column:
        p, left = s["p"], F.lit(n) - s["at"]
        if skip_at is not None:
            return F.when(p >= skip_at, "skip").when(p + left < skip_at, "proceed")
        return F.when((p >= low) & (p + left <= high), "learnable").when(p > high, "too_easy").when(p + left < low, "too_hard")

    all_points = F.transform(state, lambda s: F.struct(s["at"].alias("at"), s["p"].alias("p"), decide(s).alias("d")))
    hit = F.get(F.filter(all_points, lambda s: s["d"].isNotNull()), F.lit(0))
    last = F.get(F.reverse(all_points), F.lit(0))
    return per.withColumns({"_h": hit, "_l": last}).select(task, F.coalesce("_h.at", "_l.at").alias("decided_at"), F.coalesce("_h.p", "_l.p").alias("passes"), F.col("_h.d").alias("decision"))


def final_class(passes: Column, low: int = 1, high: int = 3) -> Column:
    return F.when(passes.between(low, high), "learnable").when(passes > high, "too_easy").otherwise("too_hard")


def tier_cascade(df: DataFrame, key: str, tiers: Column, order: Sequence[str]) -> DataFrame:
    """key, filtered_at, passes, total: of the first tier in ``order`` that skips, else of the last tier present.

    ``tiers``: map of tier name to a struct with passes, total and should_skip.
    """
    out = df.select(key, tiers.alias("_t"))
    get = lambda n: F.try_element_at(F.col("_t"), F.lit(n))
    skip = [F.when(F.coalesce(get(n)["should_skip"], F.lit(False)), F.struct(F.lit(n).alias("filtered_at"), get(n)["passes"].alias("passes"), get(n)["total"].alias("total"))) for n in order]
    none = F.lit(None).cast("string").alias("filtered_at")
    end = [F.when(get(n).isNotNull(), F.struct(none, get(n)["passes"].alias("passes"), get(n)["total"].alias("total"))) for n in reversed(order)]
    return out.withColumn("_x", F.coalesce(*skip, *end)).select(key, "_x.filtered_at", "_x.passes", "_x.total")


def conversation_tokens(messages: DataFrame, conversation: str, order: str, assistant: Column, tokens: Column, span: int = 65_536) -> DataFrame:
    """conversation, input_tokens, output_tokens: input counts, at every assistant turn, all earlier messages again.

    ``order`` is integral; running sums are taken inside blocks of ``span`` of it and over the blocks'
    totals, so a conversation that holds a third of all messages is spread over many tasks.
    """
    rows = messages.select(conversation, F.col(order).alias("_o"), F.floor(F.col(order) / span).alias("_b"), assistant.alias("_a"), tokens.alias("_n"))
    per = rows.groupBy(conversation, "_b").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_t"), F.count_if("_a").alias("_turns"), F.coalesce(F.sum(F.when(F.col("_a"), F.col("_n"))), F.lit(0)).alias("_out"))
    inside = Window.partitionBy(conversation, "_b").orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0))).where("_a").groupBy(conversation, "_b").agg(F.sum("_before").alias("_in"))
    blocks = Window.partitionBy(conversation).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    far = per.withColumn("_base", F.coalesce(F.sum("_t").over(blocks), F.lit(0)))
    key = [far[c].eqNullSafe(near[c]) for c in (conversation, "_b")]
    got = far.join(near, key, "left").select(far[conversation], (F.col("_base") * F.col("_turns") + F.coalesce("_in", F.lit(0))).alias("_in"), "_out")
    return got.groupBy(conversation).agg(F.sum("_in").alias("input_tokens"), F.sum("_out").alias("output_tokens"))


def overshoots(rounds: DataFrame, key: str, round_no: str, label: str) -> DataFrame:
    """Adds ``overshot``: whether an earlier round of the key has another label.

    A label's first round suffices: per key the two labels that come first are aggregated, and a row
    looks at the first of them that isn't its own.
    """
    first = rounds.where(F.col(label).isNotNull()).groupBy(key, F.col(label).alias("_l")).agg(F.min(round_no).alias("_r"))
    a = first.groupBy(key).agg(F.min(F.struct("_r", "_l")).alias("_a"))
    b = first.join(a, key).where(F.col("_l") != F.col("_a._l")).groupBy(key).agg(F.min("_r").alias("_second"))
    other = F.when(F.col(label) == F.col("_a._l"), F.col("_second")).otherwise(F.col("_a._r"))
    out = rounds.join(a, key, "left").join(b, key, "left").withColumn("overshot", F.coalesce(other < F.col(round_no), F.lit(False)))
    return out.select(*rounds.columns, "overshot")
