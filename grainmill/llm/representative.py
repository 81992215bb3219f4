"""Best representative of each group of duplicate records.

Two parts. The row choices (survivor, row whose classification is kept) follow stated precedence
rules, as partial aggregations of ordered structs: a group that holds a third of all rows never
gathers in one task. The field values of the fused record come from a latent two-sided quality
model: each source has a sensitivity (it states a value that is true) and a specificity (it stays
silent about one that is false), inferred per field by expectation-maximisation; a single-valued
field takes its most probable value, a multi-valued field keeps every value judged true.

Groups with the same pattern of statements share their probabilities. So the iterations run on the
distinct patterns with their counts, on the cluster; between them only the quality of each source
per field is kept. Probabilities stay in log space, so any number of sources may agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.operators.setjoin import word_counts
from grainmill.session import cut_lineage

#: Counters of the sketch that finds crowded groups.
SKETCH = 1 << 16

VALUES = ["task_dir", "failed_stage", "classification", "passes", "total", "pass_rate"]


def topic_key(topic: Column) -> Column:
    """Letters and digits only, ignoring case."""
    return F.regexp_replace(F.lower(topic), r"[^\p{L}\p{N}]", "")


def present(df: DataFrame, c: str) -> Column:
    """Null and blank strings are not present."""
    return F.col(c).isNotNull() & (F.trim(F.regexp_replace(F.col(c), r"\s", " ")) != "") if dict(df.dtypes)[c] == "string" else F.col(c).isNotNull()


def choose_rows(df: DataFrame, group: Sequence[str], row_id: str, recorded: str, values: Sequence[str], trusted: Column, kept: str) -> DataFrame:
    """group columns, survivor_id, class_row_id, n_rows of every group of two or more rows.

    The survivor has the most of ``values`` present, then the latest ``recorded``, then the largest
    ``row_id``. class_row_id is the row whose ``kept`` value is kept: trusted rows before others,
    then latest, then largest id; -1 if no row has one. Null times come last; groups are never split
    by nulls in other columns; repeated ids count as rows.
    """
    n = sum((present(df, c).cast("int") for c in values), F.lit(0))
    best = F.max(F.struct(n.alias("n"), F.col(recorded).alias("t"), F.col(row_id).alias("id")))["id"]
    keep = F.max(F.when(present(df, kept), F.struct(trusted.cast("int").alias("n"), F.col(recorded).alias("t"), F.col(row_id).alias("id"))))["id"]
    got = df.groupBy(*group).agg(F.count("*").alias("n_rows"), best.alias("survivor_id"), F.coalesce(keep, F.lit(-1)).cast("long").alias("class_row_id"))
    return got.where("n_rows > 1")


#: Sources of a pattern by position, and the values stated by the same set of sources: a number for the set, its positions, how many.
UNIT = "struct<field: string, present: array<string>, sets: array<struct<item: bigint, at: array<int>, m: bigint>>>"
#: Rows of source quality (one per field and source) and of patterns up to which they are broadcast; beyond they are joined by shuffle.
FEW = 100_000
#: Rows from which a group is spread over tasks.
HOT_ROWS = 50_000
#: Patterns of a partition.
PART_ROWS = 20_000
_HIDDEN = "\u0000"  # the field under which every row states that its source is present


def _facts(df: DataFrame, single: Sequence[str], multi: Sequence[str]) -> Column:
    stated = [F.struct(F.lit(c).alias("field"), F.when(present(df, c), F.trim(F.col(c).cast("string"))).alias("value")) for c in single]
    listed = lambda c: F.transform(F.coalesce(F.col(c), F.array()), lambda x: F.struct(F.lit(c).alias("field"), x.cast("string").alias("value")))
    lists = [listed(c) for c in multi]
    here = F.struct(F.lit(_HIDDEN).alias("field"), F.lit("").alias("value"))
    return F.filter(F.concat(F.array(here, *stated), *lists), lambda f: f["value"].isNotNull())


def _statements(df: DataFrame, group: Sequence[str], row_id: str, recorded: str, source: str, single: Sequence[str], multi: Sequence[str], hot: int) -> DataFrame:
    """g, names, present, sets: a row per group with the sets of sources that state its values.

    ``g`` is 128 bits of a digest of the group's columns, so that long keys travel once. Values of a
    field stated by the same sources are counted, with the latest of them; only multi-valued fields
    list them, as the result does. A group's rows meet in one exchange. Groups that may have more than
    ``hot`` rows, by a count sketch of fixed size, never gather: their equal values, then their equal
    sets of sources meet by partial aggregation.
    """
    names = F.struct(*group)
    rows = df.select(
        F.unhex(F.md5(F.to_json(names))).alias("g"), names.alias("names"), F.coalesce(F.col(source), F.lit("")).alias("src"),
        F.struct(F.col(recorded).alias("t"), F.col(row_id).alias("id")).alias("last"), _facts(df, single, multi).alias("facts"),
    )
    counts = word_counts(rows.select(F.col("g").alias("w")), SKETCH)
    crowded = np.flatnonzero(counts > hot).tolist()
    parts = [rows.repartition("g")]
    if crowded:
        # counters above ``hot``: at most the rows over ``hot``, and never more than the sketch has
        buckets = df.sparkSession.createDataFrame([(x,) for x in crowded], "b long")
        rows = rows.withColumn("b", F.pmod(F.xxhash64("g"), F.lit(len(counts))))
        parts = [rows.join(F.broadcast(buckets), "b", "left_anti").repartition("g"), rows.join(F.broadcast(buckets), "b", "left_semi")]
    out = []
    for part in parts:
        facts = part.select("g", "names", "src", "last", F.inline("facts")).withColumn("names", F.when(F.col("field") == _HIDDEN, F.col("names")))
        values = facts.groupBy("g", "field", "value").agg(F.sort_array(F.collect_set("src")).alias("claims"), F.max("last").alias("last"), F.max("names").alias("names"))
        listed = F.collect_list(F.when(F.col("field").isin(*multi), F.col("value"))) if multi else F.array().cast("array<string>")
        sets = values.groupBy("g", "field", "claims").agg(
            F.count("*").alias("m"), F.max(F.struct("last", "value")).alias("top"), F.max("names").alias("names"), listed.alias("listed")
        )
        entry = F.struct("field", F.xxhash64("claims").alias("item"), "claims", "m", "top", "listed")
        out.append(sets.groupBy("g").agg(
            F.max("names").alias("names"), F.max(F.when(F.col("field") == _HIDDEN, F.col("claims"))).alias("present"),
            F.collect_list(F.when(F.col("field") != _HIDDEN, entry)).alias("sets"),
        ))
    return reduce(DataFrame.unionByName, out)


def _units(single: Sequence[str]) -> Column:
    """The units of a group: of a single-valued field all sets of sources together, of a multi-valued one each set alone."""
    at = lambda claims: F.transform(claims, lambda s: F.array_position("present", s).cast("int"))
    small = lambda s, m: F.struct(s["item"].alias("item"), at(s["claims"]).alias("at"), m.alias("m"))
    unit = lambda field, sets: F.struct(field.alias("field"), F.col("present").alias("present"), sets.alias("sets"))
    own = lambda c: F.array_sort(F.transform(F.filter("sets", lambda s: s["field"] == c), lambda s: small(s, s["m"])))
    ones = F.array(*[unit(F.lit(c), own(c)) for c in single]).cast(f"array<{UNIT}>")
    ones = F.transform(F.filter(ones, lambda u: F.size(u["sets"]) > 0), lambda u: F.struct(u.alias("u"), F.lit(1).cast("bigint").alias("n")))
    alone = F.transform(
        F.filter("sets", lambda s: ~s["field"].isin(*single)),
        lambda s: F.struct(unit(s["field"], F.array(small(s, F.lit(1).cast("bigint")))).alias("u"), s["m"].alias("n")),
    )
    return F.concat(ones, alone)


# The steps of a round are SQL texts: a round is planned often, and a text is planned in one call.
_SUM = "aggregate({0}, 0D, (a, x) -> a + {1})"
_WEIGHTS = "transform(arrays_zip(sets, p), z -> struct(z.sets.at as at, n * z.sets.m * z.p as t, n * z.sets.m * (1 - z.p) as f))"
_COULD = "transform(concat(present, array(cast(null as string))), s -> struct(s as src, tall as t, 0D as tt, fall as f, 0D as ff))"
_DID = "flatten(transform(w, x -> transform(x.at, k -> struct(element_at(present, k) as src, 0D as t, x.t as tt, 0D as f, x.f as ff))))"


def _counts(patterns: DataFrame) -> DataFrame:
    """field, src, t, tt, f, ff: weight of true and false values that a source could have stated, and of those it did state.

    Of ``patterns`` with p, the probabilities of their sets. What all sources of a pattern share is added once per source; a row
    with a null source carries the field's own weights.
    """
    rows = patterns.selectExpr("field", "present", f"{_WEIGHTS} as w")
    rows = rows.selectExpr("field", "present", "w", f"{_SUM.format('w', 'x.t')} as tall", f"{_SUM.format('w', 'x.f')} as fall")
    return rows.selectExpr("field", f"inline(concat({_COULD}, {_DID}))")


def _quality(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sensitivity and specificity of each source, smoothed towards 2/3 and 4/5; under a null source the share of true values."""
    sums = counts.groupBy(*by).agg({"t": "sum", "tt": "sum", "f": "sum", "ff": "sum"})
    return sums.selectExpr(
        *by, "(`sum(tt)` + 4) / (`sum(t)` + 6) as sens", "(`sum(f)` - `sum(ff)` + 8) / (`sum(f)` + 10) as spec", "(`sum(t)` + 1) / (`sum(t)` + `sum(f)` + 2) as base"
    )


def _expect(patterns: DataFrame, quality: DataFrame, exclusive: bool, few: bool) -> DataFrame:
    """``patterns`` with p, the probability of each set: exclusive sets share one unit with a slack of 0.1, others stand for themselves.

    ``few``: the quality has at most FEW rows, counted, and is broadcast.
    """
    rows = patterns.selectExpr("pattern", "field", "struct(n, present, sets) as body", "posexplode(concat(present, array(cast(null as string)))) as (k, src)")
    rows = rows.selectExpr("pattern", "field", "if(k = 0, body, null) as body", "k", "src")
    q = quality.selectExpr(
        "field as f", "src as s", "if(src is null, 0D, ln((1 - sens) / spec)) as silent",
        "if(src is null, ln(base / (1 - base)), ln(sens / (1 - spec)) - ln((1 - sens) / spec)) as more",
    )
    met = rows.join(F.broadcast(q) if few else q, F.expr("field = f and src <=> s"))
    met = met.groupBy("pattern", "field").agg(F.expr("max(body) as body"), F.expr("sum(silent) as silent"), F.expr("array_sort(collect_list(struct(k, more))).more as more"))
    met = met.selectExpr("pattern", "field", "body.*", "more", f"transform(body.sets, s -> silent + {_SUM.format('s.at', 'element_at(more, x)')}) as l")
    if exclusive:
        met = met.selectExpr("*", "greatest(array_max(l), ln(0.1)) as most")
        met = met.selectExpr("*", f"{_SUM.format('arrays_zip(l, sets)', 'x.sets.m * exp(x.l - most)')} + exp(ln(0.1) - most) as whole")
        p = "transform(l, x -> exp(x - most) / whole)"
    else:
        p = "transform(l, x -> 1 / (1 + exp(-(x + element_at(more, -1)))))"  # the null source comes last
    return met.selectExpr("pattern", "field", "n", "present", "sets", f"{p} as p")


def _infer(patterns: DataFrame, single: Sequence[str], multi: Sequence[str], rounds: int) -> DataFrame:
    """pattern, ps (item, p of every set) after ``rounds`` iterations of the single-valued fields and half as many of the multi-valued ones.

    Single-valued fields start from the shares of the statements; their conflicts tell the sources
    apart. Multi-valued fields start from the sources' quality over all single-valued ones.
    """
    by = ["field", "src"]
    # few patterns need few partitions: those of one partition are summed without a shuffle
    patterns = patterns.coalesce(-(-max(patterns.count(), 1) // PART_ROWS))
    ones, others = patterns.where(F.col("field").isin(*single)), patterns.where(~F.col("field").isin(*single))
    heard = ones.selectExpr("*", f"{_SUM.format('sets', 'size(x.at) * x.m')} as heard")
    start = heard.selectExpr("*", "transform(sets, s -> 0.9D * size(s.at) / heard) as p")
    q = cut_lineage(_quality(_counts(start), by))
    few = patterns.select("field", F.explode("present")).distinct().limit(FEW + 1).count() <= FEW
    for _ in range(rounds - 1):
        q = cut_lineage(_quality(_counts(_expect(ones, q, True, few)), by))
    p = _expect(ones, q, True, few)
    if multi:
        pooled = _quality(_counts(p).where("src is not null"), ["src"])
        pairs = others.selectExpr("field", "explode(concat(present, array(cast(null as string)))) as src").distinct()
        q = pairs.join(pooled, "src", "left").selectExpr("field", "src", "coalesce(sens, 0.5D) as sens", "coalesce(spec, 0.5D) as spec", "0.5D as base")
        q = cut_lineage(q)
        for _ in range(rounds // 2):
            q = cut_lineage(_quality(_counts(_expect(others, q, False, few)), by))
        p = p.unionByName(_expect(others, q, False, few))
    return p.selectExpr("pattern", "transform(arrays_zip(sets, p), z -> struct(z.sets.item as item, z.p as p)) as ps")


def infer_truth(df: DataFrame, group: Sequence[str], row_id: str, recorded: str, source: str, single: Sequence[str], multi: Sequence[str], rounds: int = 8, hot: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(groups: g, names; units: g, field, sets): the sets of a group's values of a field, each with p, top (latest value) and listed.

    A group's sources are those with a row in it; each states or doesn't state each of the group's
    values. Of a single-valued field's values at most one is true, so they share one unit of
    probability; values of a multi-valued field stand for themselves.
    """
    groups = _statements(df, group, row_id, recorded, source, single, multi, hot)
    unit = lambda x: F.struct(F.xxhash64(x["u"]).alias("pattern"), x["u"].alias("u"), x["n"].alias("n"))
    groups = cut_lineage(groups.select("g", "names", "sets", F.transform(_units(single), unit).alias("units")))
    patterns = groups.select(F.inline("units")).groupBy("pattern").agg(F.sum("n").alias("n"), F.first("u").alias("u"))
    patterns = cut_lineage(patterns.select("pattern", "n", "u.field", "u.present", "u.sets"))
    p = cut_lineage(_infer(patterns, single, multi, rounds))
    p = F.broadcast(p) if p.limit(FEW + 1).count() <= FEW else p
    own = F.filter("sets", lambda s: F.array_contains(F.transform(F.col("x.u.sets"), lambda y: y["item"]), s["item"]) & (s["field"] == F.col("x.u.field")))
    slim = F.transform(own, lambda s: F.struct(s["item"].alias("item"), s["top"].alias("top"), s["listed"].alias("listed")))
    units = groups.select("g", "sets", F.explode("units").alias("x")).select("g", "x.pattern", F.col("x.u.field").alias("field"), slim.alias("own"))
    units = units.join(p, "pattern")
    scored = F.transform("own", lambda s: F.struct(F.get(F.filter("ps", lambda y: y["item"] == s["item"]), F.lit(0))["p"].alias("p"), s["top"].alias("top"), s["listed"].alias("listed")))
    return groups.select("g", "names"), units.select("g", "field", scored.alias("sets"))


def fuse(df: DataFrame, group: Sequence[str], row_id: str, recorded: str, source: str, single: Sequence[str], multi: dict[str, Column], threshold: float = 0.5, hot: int = HOT_ROWS) -> DataFrame:
    """group columns and one fused value per field.

    Single-valued fields take the most probable value (ties: latest, then largest id), as text;
    multi-valued ones keep every value with p >= threshold. Rows with a null group column are in no
    group; an empty table gives no row; a field that no row states is null.
    """
    rows = df.where(" and ".join(f"`{g}` is not null" for g in group)).select(
        *group, F.col(row_id).alias("_id"), F.col(recorded).alias("_t"), F.col(source).alias("_src"), *single, *[a.alias(m) for m, a in multi.items()]
    )
    groups, units = infer_truth(rows, group, "_id", "_t", "_src", single, list(multi), hot=hot)
    ranked = F.transform("sets", lambda s: F.struct(F.round(s["p"], 9).alias("p"), s["top"]["last"].alias("last"), s["top"]["value"].alias("value")))
    kept = F.flatten(F.transform(F.filter("sets", lambda s: s["p"] >= threshold), lambda s: s["listed"]))
    one = F.col("field").isin(*single)
    chosen = units.select("g", "field", F.when(one, F.array_max(ranked)["value"]).alias("value"), F.when(~one, kept).alias("kept"))
    chosen = chosen.where("value is not null or size(kept) > 0")
    every = groups.unionByName(chosen, allowMissingColumns=True)
    pick = lambda c, x: F.when(F.col("field") == c, F.col(x))
    out = every.groupBy("g").agg(
        F.max("names").alias("names"), *[F.max(pick(c, "value")).alias(c) for c in single],
        *[F.sort_array(F.array_distinct(F.flatten(F.collect_list(pick(m, "kept"))))).alias(m) for m in multi],
    )
    return out.select("names.*", *single, *[F.when(F.size(m) > 0, F.col(m)).alias(m) for m in multi])
