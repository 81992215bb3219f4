"""Mixing sources to target weights along a time-varying curriculum.

Demand: a recipe's shares are normalised over its sources that have documents; a source gives at
most max_repeats times its size, and what a capped source can't give goes to the others in
proportion (water filling). Schedule: a source's weight over training time x in [0, 1] is piecewise
linear between knots. Integrating it and inverting the cumulative demand gives each document the
time at which its token position falls due; documents are range-sorted by it. Without a given
schedule the weight of source s is share_s * (1 + a_s * (2x - 1)), with sum(share_s * a_s) = 0, so
the weights add up to 1 at every time and integrate to the shares.

Scale: recipes are planned as groups of their targets, on the cluster; token prefix sums are
two-level (buckets of a hash of the document, then inside a bucket), and documents meet their
source's plan over salted parts, so no source gathers in one task.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grainmill.session import cut_lineage

BUCKET_ROWS = 20_000
SALTS = 32
PLAN = "recipe string, source string, w double, demand double, held long, knots array<struct<x: double, y: double>>"


def fill(shares: dict[str, float], sizes: dict[str, int], repeats: dict[str, int], total: float) -> dict[str, float]:
    """Tokens demanded of each source: the normalised shares of ``total``, capped, the excess spread over the rest."""
    live = {s: w for s, w in shares.items() if w > 0 and sizes.get(s, 0) > 0 and repeats[s] > 0}
    given: dict[str, float] = {}
    while live:
        left, weight = total - sum(given.values()), sum(live.values())
        capped = [s for s in live if left * live[s] / weight >= sizes[s] * repeats[s]]
        if not capped:
            given |= {s: left * w / weight for s, w in live.items()}
            break
        for s in capped:
            given[s] = float(sizes[s] * repeats[s])
            del live[s]
    return given


def largest(shares: dict[str, float], sizes: dict[str, int], repeats: dict[str, int]) -> float:
    """The largest total at which every source with documents meets its normalised share within its repeats."""
    live = {s: w for s, w in shares.items() if w > 0 and sizes.get(s, 0) > 0 and repeats[s] > 0}
    return min((sizes[s] * repeats[s] * sum(live.values()) / w for s, w in live.items()), default=0.0)


def _plan(tilt: float, total: int | None):
    """One recipe's targets -> demand and schedule of each source; sources without a demand keep a row of 0."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf.set_index("source")
        sizes, shares, caps = own.held.astype(int).to_dict(), own.w.astype(float).to_dict(), own.r.astype(int).to_dict()
        got = fill(shares, sizes, caps, largest(shares, sizes, caps) if total is None else total)
        whole, loglen = sum(got.values()) or 1.0, own.loglen.to_dict()
        mean = sum(v / whole * loglen[s] for s, v in got.items())
        most = max([abs(loglen[s] - mean) for s in got] + [1e-12])

        def knots(s: str) -> list[dict]:
            given = own.knots[s]
            if given is not None and len(given):
                return [{"x": float(k["x"]), "y": float(k["y"])} for k in given]
            a = tilt * (loglen[s] - mean) / most if s in got else 0.0
            return [{"x": 0.0, "y": 1 - a}, {"x": 1.0, "y": 1 + a}]

        rows = [(pdf.recipe.iloc[0], s, shares[s], got.get(s, 0.0), sizes[s], knots(s)) for s in own.index]
        return pd.DataFrame(rows, columns=["recipe", "source", "w", "demand", "held", "knots"])

    return run


#: SQL of the time x at which the integral of a piecewise linear weight reaches the share u of its whole.
#: Segments carry the integral before them; in the segment the integral is y0 t + (y1 - y0) t^2 / (2 h).
_SEGMENTS = """aggregate(slice(knots, 2, size(knots)), named_struct('x', knots[0].x, 'y', knots[0].y, 'c', 0D, 'out', cast(array() as array<struct<x: double, h: double, y0: double, y1: double, c: double>>)),
 (s, k) -> named_struct('x', k.x, 'y', k.y, 'c', s.c + (k.x - s.x) * (s.y + k.y) / 2, 'out', concat(s.out, array(named_struct('x', s.x, 'h', k.x - s.x, 'y0', s.y, 'y1', k.y, 'c', s.c)))), s -> named_struct('c', s.c, 'out', s.out))"""


def _schedules(schedule: DataFrame | None, targets: DataFrame) -> DataFrame:
    """recipe, source, knots: the given knots in order of time, the first and last weight held to the ends of [0, 1]."""
    if schedule is None:
        return targets.select("recipe", "source", F.lit(None).cast("array<struct<x: double, y: double>>").alias("knots")).where("false")
    given = schedule.where("at between 0 and 1 and weight >= 0 and recipe is not null and source is not null")
    point = F.struct(F.col("at").cast("double").alias("x"), F.col("weight").cast("double").alias("y"))
    got = given.groupBy("recipe", "source").agg(F.array_sort(F.collect_list(point)).alias("k"))
    ends = [F.struct(F.lit(x).alias("x"), F.get("k", i)["y"].alias("y")) for x, i in ((0.0, F.lit(0)), (1.0, F.size("k") - 1))]
    knots = F.concat(F.array(ends[0]), F.col("k"), F.array(ends[1]))
    got = got.select("recipe", "source", knots.alias("knots"))
    return got.where(F.exists("knots", lambda k: k["y"] > 0))  # a schedule that is 0 throughout says nothing


def mix(docs: DataFrame, key: str, source: str, size: str, targets: DataFrame, tilt: float = 0.5, seed: int = 7, total_tokens: int | None = None, schedule: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(recipe, position, key, source, pass_no, n_tokens) and (recipe, source, target_share, actual_share, tokens, documents, passes).

    ``total_tokens`` defaults to the largest total at which all shares are met within the repeats; with a
    given total, a capped source's shortfall goes to the others. Sources without documents and
    documents whose source is null or in no recipe take no part; their recipes' rows report 0.
    Repeated (recipe, source) rows add their shares and keep the largest cap; rows without a recipe
    form one recipe, rows without a source are reported with 0. Documents of 0 tokens are placed like
    any other. A source's last pass takes its documents in hash order until its demand is met, so its
    tokens differ from the demand by less than one document. ``schedule`` (recipe, source, at, weight)
    gives a source's weight at times in [0, 1], linear in between; it moves documents in time and
    leaves the shares. Sources it doesn't name keep the tilt by their mean length.
    """
    d = docs.select(F.col(key).alias("_key"), F.col(source).alias("_src"), F.col(size).cast("long").alias("_n")).where("_src is not null and _n is not null")
    t = targets.groupBy("recipe", "source").agg(F.coalesce(F.sum("target_share"), F.lit(0.0)).cast("double").alias("w"), F.coalesce(F.max("max_repeats"), F.lit(0)).alias("r"))
    t = cut_lineage(t)
    d = cut_lineage(d.join(t.select(F.col("source").alias("_src")).distinct(), "_src", "left_semi"))
    per = d.groupBy("_src").agg(F.sum("_n").alias("held"), F.count("*").alias("docs"), F.avg(F.log1p("_n")).alias("loglen"))
    per = cut_lineage(per)
    known = t.join(per.withColumnRenamed("_src", "source"), "source", "left").join(_schedules(schedule, t), ["recipe", "source"], "left")
    known = known.where("source is not null").select("recipe", "source", "w", "r", F.coalesce("held", F.lit(0)).alias("held"), F.coalesce("loglen", F.lit(0.0)).alias("loglen"), "knots")
    plan = cut_lineage(known.groupBy("recipe").applyInPandas(_plan(tilt, total_tokens), PLAN))
    n_docs = per.agg(F.sum("docs")).first()[0] or 0
    buckets = max(1, -(-n_docs // BUCKET_ROWS))
    # token prefix sums in hash order, per source: bucket totals first, then inside each bucket
    h = F.pmod(F.xxhash64(F.lit(seed), F.col("_key")), F.lit(1 << 40))
    d = d.withColumn("_h", h).withColumn("_b", F.floor(F.col("_h") * buckets / F.lit(1 << 40)).cast("int"))
    sums = d.groupBy("_src", "_b").agg(F.sum("_n").alias("bt"))
    before = sums.withColumn("base", F.sum("bt").over(Window.partitionBy("_src").orderBy("_b")) - F.col("bt")).select("_src", "_b", "base")
    inside = Window.partitionBy("_src", "_b").orderBy("_h", "_key").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(before, ["_src", "_b"]).withColumn("_at", F.col("base") + F.col("_in"))
    # a pass takes a document if its start lies within the demand
    spread = plan.where("demand > 0").select("recipe", F.col("source").alias("_src"), "demand", "held", F.expr(_SEGMENTS).alias("g"))
    spread = spread.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = d.withColumn("_salt", F.pmod(F.col("_h"), F.lit(SALTS)).cast("int")).join(spread, ["_src", "_salt"])
    last = F.floor((F.col("demand") - F.col("_at") - F.lit(1e-6)) / F.greatest(F.col("held"), F.lit(1))).cast("int")
    rows = rows.withColumn("_last", F.when(F.col("held") > 0, last).otherwise(0)).where("_last >= 0")
    rows = rows.withColumn("pass_no", F.explode(F.sequence(F.lit(0), F.col("_last"))))
    u = F.least(F.lit(1.0), (F.col("pass_no") * F.col("held") + F.col("_at") + F.col("_n") / 2) / F.col("demand"))
    rows = rows.withColumn("_y", u * F.col("g.c"))
    # the last segment that begins at or before the integral sought, and the root within it
    rows = rows.withColumn("_s", F.expr("element_at(filter(g.out, s -> s.h > 0 and s.c <= _y), -1)"))
    y0, rise, part = F.col("_s.y0"), F.col("_s.y1") - F.col("_s.y0"), F.col("_y") - F.col("_s.c")
    square = F.sqrt(F.greatest(y0 * y0 + 2 * rise / F.col("_s.h") * part, F.lit(0.0)))
    step = F.coalesce(F.try_divide(2 * part, y0 + square), F.lit(0.0))
    rows = rows.withColumn("position", F.least(F.col("_s.x") + F.least(step, F.col("_s.h")), F.lit(1.0)))
    mixed = rows.select("recipe", "position", F.col("_key").alias(key), F.col("_src").alias("source"), "pass_no", F.col("_n").alias("n_tokens"))
    actual = mixed.groupBy("recipe", "source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents"), (F.max("pass_no") + 1).alias("passes"))
    actual = actual.select(F.col("recipe").alias("_r"), F.col("source").alias("_s"), "tokens", "documents", "passes")
    report = t.join(actual, F.col("recipe").eqNullSafe(F.col("_r")) & (F.col("source") == F.col("_s")), "left")
    whole = Window.partitionBy("recipe")  # the targets of a recipe, not its documents
    report = report.select(
        "recipe", "source", F.coalesce(F.try_divide("w", F.sum("w").over(whole)), F.lit(0.0)).alias("target_share"),
        F.coalesce(F.col("tokens") / F.sum("tokens").over(whole), F.lit(0.0)).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("passes", F.lit(0)).alias("passes"),
    )
    return mixed, report
