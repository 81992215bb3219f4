"""Merges of logs that name the same things: precedence, last-wins, resume and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.session import cut_lineage


def last_wins(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, by a partial aggregation rather than a window. Null order comes first."""
    rest = [c for c in df.columns if c not in key]
    row = F.struct(*[F.col(c) for c in rest])
    best = df.groupBy(*key).agg(F.max_by(row, F.struct(*[F.col(c) for c in order])).alias("_r"))
    return best.select(*key, "_r.*").select(*df.columns)


def report_merge(report: DataFrame, incremental: DataFrame, key: Sequence[str], order: Sequence[str], classified: Column) -> DataFrame:
    """Report rows joined by the incremental log.

    A report row stands unless it is unclassified and the log has a classified row of its key (the
    last one). Classified keys that the report lacks are added. Groups (first key column) without any
    report row take all their log rows as they are. Every report row of a repeated key is kept; rows
    with a null key stand for themselves.
    """
    cols = report.columns
    group = key[0]
    covered = report.select(group).distinct()
    late = last_wins(incremental.where(classified).join(covered, group, "left_semi"), key, order)
    packed = late.select(*key, F.struct(*[F.col(c) for c in cols]).alias("_late"))
    joined = report.withColumn("_open", ~classified).join(packed, list(key), "left")
    take = F.col("_open") & F.col("_late").isNotNull()
    merged = joined.select(*[F.when(take, F.col(f"_late.{c}")).otherwise(F.col(c)).alias(c) for c in cols])
    added = late.join(report.select(*key).distinct(), list(key), "left_anti").select(*cols)
    alone = incremental.join(covered, group, "left_anti").select(*cols)
    return merged.unionByName(added).unionByName(alone)


def resume_merge(prior: DataFrame, new: DataFrame, planned: DataFrame, key: str, order: str) -> DataFrame:
    """Prior and new results by key, the new winning, kept to the plan and in its order (column position)."""
    both = prior.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    best = last_wins(both, [key], ["_new", order]).drop("_new")
    return best.join(planned.select(key, "position"), key)


def remaining(planned: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Planned rows whose key isn't done; null keys are never done."""
    return planned.join(done.select(key).distinct(), key, "left_anti")


def run_status(expected: DataFrame, actual: DataFrame, key: str, attempts: int, resolved: Column) -> DataFrame:
    """key, n_actual, n_resolved and state: passed, failed, incomplete, not_started or unexpected."""
    got = actual.groupBy(key).agg(F.count("*").alias("n_actual"), F.count_if(F.coalesce(resolved, F.lit(False))).alias("n_resolved"))
    both = expected.select(key).distinct().withColumn("_e", F.lit(True)).join(got, key, "full_outer")
    n = F.coalesce("n_actual", F.lit(0))
    state = (
        F.when(F.col("_e").isNull(), "unexpected").when(n == 0, "not_started").when(n < attempts, "incomplete")
        .when(F.col("n_resolved") == F.col("n_actual"), "passed").otherwise("failed")
    )
    return both.select(key, n.alias("n_actual"), F.coalesce("n_resolved", F.lit(0)).alias("n_resolved"), state.alias("state"))


def by_precedence(base: DataFrame, layers: Sequence[DataFrame], key: str, fields: Sequence[str]) -> DataFrame:
    """``fields`` of the first layer that has them, in the order given, for every key of ``base``."""
    out = base.select(key).distinct()
    for i, layer in enumerate(layers):
        out = out.join(layer.select(key, *[F.col(f).alias(f"_{i}_{f}") for f in fields]), key, "left")
    return out.select(key, *[F.coalesce(*[F.col(f"_{i}_{f}") for i in range(len(layers))]).alias(f) for f in fields])


def contains_match(left: DataFrame, left_key: str, pattern: str, right: DataFrame, name: str, parts: int = 32) -> DataFrame:
    """left_key with the first ``name`` (in order) that contains its ``pattern``, without a nested-loop join.

    Names are exploded into their substrings of the lengths that patterns have and meet the distinct
    patterns by equality, so every meeting is a match. Rows of a frequent pattern are spread over
    ``parts`` when they take its match. Empty and null patterns match nothing.
    """
    lhs = left.where(F.length(pattern) > 0).select(left_key, F.col(pattern).alias("_p"))
    patterns = cut_lineage(lhs.select("_p").distinct())
    # as many lengths as the longest pattern has characters
    lengths = [r[0] for r in patterns.select(F.length("_p")).distinct().collect()]
    names = right.select(F.col(name).alias("_n")).where(F.length("_n") > 0).distinct()
    sized = F.filter(F.array(*[F.lit(x) for x in sorted(lengths)]).cast("array<int>"), lambda x: x <= F.length("_n"))
    pieces = F.flatten(F.transform(sized, lambda x: F.transform(F.sequence(F.lit(1), F.length("_n") - x + 1), lambda i: F.substring(F.col("_n"), i, x))))
    hits = names.select("_n", F.explode(F.array_distinct(pieces)).alias("_p")).join(patterns, "_p").groupBy("_p").agg(F.min("_n").alias(name))
    spread = hits.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return lhs.withColumn("_s", F.pmod(F.xxhash64(left_key), F.lit(parts)).cast("int")).join(spread, ["_p", "_s"]).select(left_key, name)


def basename_match(wanted: DataFrame, key: Sequence[str], file: str, files: DataFrame, path: str) -> DataFrame:
    """The source file of each wanted file name: the shallowest path with that base name, tests left out."""
    base, depth = F.element_at(F.split(F.col(path), "/"), -1), F.size(F.split(F.col(path), "/"))
    there = files.where(~F.col(path).rlike("(^|/)tests/")).select(*key, base.alias(file), F.struct(depth.alias("d"), F.col(path).alias("p")).alias("_m"))
    best = there.groupBy(*key, file).agg(F.min("_m").alias("_m"))
    return wanted.join(best, [*key, file], "left").select(*wanted.columns, F.col("_m.p").alias(path))


def overlay(base: DataFrame, patch: DataFrame, key: Sequence[str], value: str, allowed: Column) -> DataFrame:
    """``base`` with the patch's values where the key is known and ``allowed``; unknown patch keys are ignored."""
    p = patch.select(*key, F.col(value).alias("_p"))
    joined = base.join(p, list(key), "left")
    return joined.select(*[F.when(allowed & F.col("_p").isNotNull(), F.col("_p")).otherwise(F.col(value)).alias(value) if c == value else F.col(c) for c in base.columns])


def merge_events(a: DataFrame, b: DataFrame, time: str, seq: str) -> DataFrame:
    """Two event streams in one stable order: unreadable times first, ties by stream, then by sequence."""
    both = a.withColumn("stream", F.lit(0)).unionByName(b.withColumn("stream", F.lit(1)))
    return both.withColumn(time, F.coalesce(F.col(time), F.lit(0).cast(both.schema[time].dataType))).orderBy(time, "stream", seq)


def tripped(df: DataFrame, order: str, failing: Column, group: Sequence[str] = ()) -> DataFrame:
    """Adds ``skipped``: whether an earlier row of the group already failed (circuit breaker).

    The earliest failing position is aggregated per group and joined back, so no group is sorted in one task.
    """
    if not group:
        at = df.where(failing).agg(F.min(order)).first()[0]  # one value
        return df.withColumn("skipped", F.coalesce(F.col(order) > F.lit(at), F.lit(False)))
    first = df.where(failing).groupBy(*group).agg(F.min(order).alias("_first"))
    out = df.join(first, list(group), "left").withColumn("skipped", F.coalesce(F.col(order) > F.col("_first"), F.lit(False)))
    return out.select(*df.columns, "skipped")
