"""Seeded sampling, top-k and budgeted selection. Draws depend on row keys and a seed, never on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.session import cut_lineage


def uniform(seed: int, *keys: str) -> Column:
    """A number in (0, 1) from the MD5 of seed and keys: the same in every engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def draw_key(seed: int, weight: Column, *keys: str) -> Column:
    """-ln(u) / w: ordering by it is a weighted draw without replacement; null where the weight isn't positive."""
    return F.when(weight > 0, -F.log(uniform(seed, *keys)) / weight)


def weighted_sample(df: DataFrame, n: int, weight: str, key: str, seed: int = 0) -> DataFrame:
    """n rows without replacement, in proportion to weight; fewer if fewer have a positive weight."""
    return df.withColumn("_d", draw_key(seed, F.col(weight), key)).where("_d is not null").orderBy("_d", key).limit(n).drop("_d")


def stratified_round_robin(df: DataFrame, n: int, stratum: str, weight: str, key: str, seed: int = 0) -> DataFrame:
    """n rows, one weighted draw per stratum and pass, strata in a seeded order.

    No stratum gives more than n rows, so each is first cut to its n best draws by a windowed top-n,
    which Spark limits per partition before the shuffle (rank limit pushdown).
    """
    d = df.withColumn("_d", draw_key(seed, F.col(weight), key)).where("_d is not null")
    d = d.withColumn("pass_no", F.row_number().over(Window.partitionBy(stratum).orderBy("_d", key))).where(F.col("pass_no") <= n)
    return d.withColumn("_s", uniform(seed, stratum)).orderBy("pass_no", "_s", key).limit(n).drop("_d", "_s")


def top_per_group(df: DataFrame, by: Sequence[str], score: Column, key: str) -> DataFrame:
    """The row with the highest score per group (ties: smallest key), by a partial aggregation."""
    cols = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.max_by(F.struct(*cols), F.struct(score, -F.col(key))).alias("_r")).select(*by, "_r.*")


def budgeted(df: DataFrame, budget: int, group: str, score: str, size: str, key: str, wave: int = 10_000) -> DataFrame:
    """Greedy selection under a budget, skipping what doesn't fit: each group's best first (groups in order), then the rest by score.

    The scan is sequential by definition, so it runs in waves: a distributed top-``wave`` of the rows
    after the last one looked at that still fit the budget left. It ends when none fits; sizes are
    positive integers, so at most ``budget`` rows are chosen, and one wave is held at a time.
    """
    spark = df.sparkSession
    fit = df.where((F.col(size) > 0) & (F.col(size) <= budget)).select(F.col(group).alias("g"), F.col(score).alias("s"), F.col(size).cast("long").alias("z"), F.col(key).alias("k"))
    best = fit.groupBy("g").agg(F.max_by("k", F.struct("s", -F.col("k"))).alias("b"))
    ranked = fit.join(best, "g").withColumn("o", F.struct((F.col("k") != F.col("b")).alias("later"), F.when(F.col("k") == F.col("b"), F.col("g")).alias("g"), (-F.col("s")).alias("s"), "k"))
    ranked = cut_lineage(ranked.select("o", "z", "k"))  # written once, every wave starts from it
    left, chosen, at = budget, [], None
    while True:
        rest = ranked.where(F.col("z") <= left)
        if at is not None:
            later = F.struct(F.lit(at["later"]).alias("later"), F.lit(at["g"]).cast(fit.schema["g"].dataType).alias("g"), F.lit(at["s"]).alias("s"), F.lit(at["k"]).cast(fit.schema["k"].dataType).alias("k"))
            rest = rest.where(F.col("o") > later)
        rows = rest.orderBy("o").limit(wave).select("o", "z", "k").collect()
        for r in rows:
            if r.z <= left:
                left -= r.z
                chosen.append((r.k,))
        if len(rows) < wave or left == 0:
            return spark.createDataFrame(chosen, f"`{key}` {df.schema[key].dataType.simpleString()}")
        at = rows[-1].o


def with_negative(df: DataFrame, chosen: DataFrame, negatives: DataFrame, budget: int, size: str, key: str, default: int = 2000) -> DataFrame:
    """key, negative: the chosen rows of ``df`` and the first of ``negatives`` by key, if it fits the budget they leave; a null size counts as ``default``. No later negative is tried."""
    used = df.join(chosen, key, "left_semi").agg(F.coalesce(F.sum(size), F.lit(0)).alias("_used"))
    first = negatives.select(key, F.coalesce(F.col(size), F.lit(default)).alias("_z")).orderBy(key).limit(1)
    fits = first.crossJoin(F.broadcast(used)).where(F.col("_used") + F.col("_z") <= budget)  # one row each
    return chosen.select(key, F.lit(False).alias("negative")).unionByName(fits.select(key, F.lit(True).alias("negative")))


def schedule(df: DataFrame, key: str, explicit: Column, agent: Column, test: Column, default: float = 210.0) -> DataFrame:
    """Longest first by estimated duration: the explicit one, else half the sum of both limits, else the default."""
    est = F.coalesce(explicit, (agent + test) / 2, F.lit(default))
    return df.select(key, est.alias("estimate")).orderBy(F.desc("estimate"), key)


def example_score(rate: Column, match: Column, tokens: Column) -> Column:
    near = F.greatest(F.lit(0.0), 1.0 - F.abs(F.coalesce(rate, F.lit(0.5)) - 0.5) * 3)
    small = F.greatest(F.lit(0.0), (8000 - F.coalesce(tokens, F.lit(5000))) / 8000) * 0.3
    return near + F.when(F.coalesce(match, F.lit(False)), 0.5).otherwise(0.0) + small


def topic_weights(results: DataFrame, old: DataFrame, topic: str, least_attempts: int = 2, floor: float = 0.05, places: int | None = None) -> DataFrame:
    """topic, weight, from the functional and learnable rates of past attempts; too few attempts keep the old weight (default 1).

    ``places``: decimals of weights that are written back, half to even; by default unrounded.
    """
    ok = F.col("stages.functional.passed").eqNullSafe(True)
    bad = ~ok & F.coalesce(F.col("status"), F.lit("")).contains("functional")
    c = F.col("classification")
    stats = results.where(F.col(topic).isNotNull()).groupBy(topic).agg(F.count_if(ok).alias("ok"), F.count_if(bad).alias("bad"), F.count_if(c.isin("learnable", "too_hard", "too_easy")).alias("evals"), F.count_if(c == "learnable").alias("good"))
    tried = F.col("ok") + F.col("bad")
    func = F.when(tried > 0, F.col("ok") / tried).otherwise(0.5)
    learn = F.when(F.col("evals") > 0, F.col("good") / F.col("evals")).otherwise(0.0)
    raw = F.when(func > 0, func * 0.4 + learn * 0.6).otherwise(0.0)
    kept = F.coalesce("old_weight", F.lit(1.0))
    few = F.coalesce(tried + F.col("evals"), F.lit(0)) < least_attempts
    new = F.greatest(F.lit(floor), raw if places is None else F.bround(raw, places))
    return old.join(stats, topic, "left").select(topic, F.when(few, kept).otherwise(new).alias("weight"))
