"""Exact order statistics without gathering a group's values in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.session import cut_lineage

BLOCKS = 64


def middle_ranks(n: Column) -> tuple[Column, Column]:
    """Ranks from 0 of the two middle values of n; the same for an odd n. The second is the upper median."""
    return F.floor((n - 1) / 2), F.floor(n / 2)


def at_ranks(df: DataFrame, by: Sequence[str], value: str, ranks: dict[str, Column]) -> DataFrame:
    """by, n, and per name the value at a rank from 0, given as an expression of n, in ascending order; nulls are left out.

    Equal values are counted first. A group's distinct values are cut into blocks of ranges at
    approximate quantiles; block totals tell which block holds a rank, and only those blocks are
    summed up in order. A rank outside the group gives null; a null group column is a group.
    """
    by = list(by)
    counts = cut_lineage(df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_c")))
    bounds = counts.groupBy(*by).agg(F.percentile_approx("_v", [i / BLOCKS for i in range(1, BLOCKS)], 1000).alias("_b"), F.sum("_c").alias("n"))
    bounds = cut_lineage(bounds)
    same = lambda a, b: [a[c].eqNullSafe(b[c]) for c in by]
    placed = counts.join(bounds, same(counts, bounds)).select(*[counts[c] for c in by], "_v", "_c", F.size(F.filter("_b", lambda x: x < F.col("_v"))).alias("_k"))
    totals = placed.groupBy(*by, "_k").agg(F.sum("_c").alias("_t"))
    totals = totals.withColumn("_end", F.sum("_t").over(Window.partitionBy(*by).orderBy("_k")))  # at most BLOCKS rows of a group
    wanted = bounds.select(*by, "n", F.inline(F.array(*[F.struct(F.lit(k).alias("_name"), r.cast("long").alias("_r")) for k, r in ranks.items()])))
    found = totals.join(wanted, same(totals, wanted)).where((F.col("_r") < F.col("_end")) & (F.col("_r") >= F.col("_end") - F.col("_t")))
    at = F.struct(*[totals[c].alias(c) for c in by], totals["_k"].alias("_k"))
    found = found.select(at.alias("_at"), "_name", (F.col("_r") - F.col("_end") + F.col("_t")).alias("_left"))
    rows = placed.withColumn("_here", F.struct(*by, "_k")).join(found, F.col("_here").eqNullSafe(F.col("_at"))).select(*by, "_k", "_name", "_left", "_v", "_c")
    order = Window.partitionBy(*by, "_k", "_name").orderBy("_v")  # one block of distinct values
    rows = rows.withColumn("_sum", F.sum("_c").over(order)).where((F.col("_sum") > F.col("_left")) & (F.col("_sum") - F.col("_c") <= F.col("_left")))
    each = [F.max(F.when(F.col("_name") == k, F.col("_v"))).alias(k) for k in ranks]
    got = rows.groupBy(*by).agg(*each)
    return bounds.join(got, same(bounds, got), "left").select(*[bounds[c] for c in by], "n", *ranks)
