"""Deeply nested JSON reports -> flat tables with links from child to parent.

Nested ``transform`` calls attach the ancestors' keys and indices to every element, ``flatten``
joins the arrays of one kind, and one ``inline`` per target table emits its rows. Fields that come
in several shapes are read as JSON text first, so one odd value never voids a whole report.
The work is per report, inside the JVM: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRINGS = "array<string>"
RESULT = "topic string, task_dir string, status string, failed_stage string, classification string, retries string, duration_sec string, stages map<string,string>, validation_attempts array<string>"
STAGE = "status string, model string, functional string, classification string, usage struct<prompt_tokens: string, completion_tokens: string, total_tokens: string>"
CHECK = "passed string, attempt string, details string, execution_times string, issues array<string>"
TIER = "model string, passes string, total string, trials array<string>"
TRIAL = "trial string, resolved string, failure_mode string, input_tokens string, output_tokens string"
RUN = "exit_code string, timed_out string, stdout_tail string, stderr_tail string"


def results_json(doc: Column) -> Column:
    """The array of results, wherever a report keeps it: at the top, under results or under report.results."""
    return F.when(F.ltrim(doc).startswith("["), doc).otherwise(
        F.coalesce(F.get_json_object(doc, "$.results"), F.get_json_object(doc, "$.report.results"))
    )


def as_ms(x: str) -> str:
    """SQL for a printed duration in milliseconds; a bare number counts seconds."""
    number = f"try_cast(regexp_extract({x}, '^ *([0-9.]+(?:[eE][-+]?[0-9]+)?)', 1) as decimal(30,9))"
    unit = f"lower(regexp_extract({x}, '([a-zA-Zµ]*) *$', 1))"
    factor = f"case {unit} when '' then 1000 when 's' then 1000 when 'sec' then 1000 when 'ms' then 1 when 'us' then 0.001 when 'm' then 60000 when 'min' then 60000 when 'h' then 3600000 end"
    return f"cast(round({number} * ({factor})) as bigint)"


def as_flag(x: str) -> str:
    """SQL for true, false or unknown, from booleans, numbers and words."""
    return f"case when lower(trim({x})) in ('true', 't', 'yes', '1', '1.0') then 'true' when lower(trim({x})) in ('false', 'f', 'no', '0', '0.0') then 'false' else 'unknown' end"


def unnest_reports(df: DataFrame, key: str, doc: str) -> dict[str, DataFrame]:
    """Flat tables of nested reports: metrics, results, stages, checks (functional validations), their
    issues, times, builds and runs, tiers and trials, and the others: fields of results, tiers and
    trials that have no column, one row each (tier and trial_no tell where).

    Links: every row holds ``key``; below that, but for metrics, result_no (position in the report,
    from 0, null elements counted), attempt_no for checks and their children, tier for trials.
    attempt_no is 0 for stages.functional, N for stages.retry_N.functional and the printed ``attempt`` for elements of
    validation_attempts. Null, blank or broken reports give no rows; null elements keep their
    position; repeated reports give repeated rows. A result without a classification of its own takes
    that of its evaluation. Fields of a stage or check that have no column stay in ``extra`` as
    JSON text; stages.functional is a check only.
    """
    base = df.select(F.col(key).alias("_key"), F.from_json(results_json(F.col(doc)), STRINGS).alias("_results"))
    parsed = base.select("_key", F.expr(f"transform(_results, (x, i) -> struct(i as result_no, from_json(x, '{RESULT}') as r))").alias("_rs"))
    retry = "transform(map_entries(map_filter(s.r.stages, (k, v) -> k rlike '^retry_[0-9]+$')), e -> struct(cast(substr(e.key, 7) as int) as attempt_no, from_json(e.value, '" + STAGE + "').functional as doc))"
    listed = f"transform(coalesce(s.r.validation_attempts, array()), a -> struct(try_cast(from_json(a, '{CHECK}').attempt as int) as attempt_no, a as doc))"
    every = f"concat(array(struct(0 as attempt_no, s.r.stages['functional'] as doc)), coalesce({retry}, array()), {listed})"
    docs = parsed.select("_key", F.expr(f"""flatten(transform(filter(_rs, s -> s.r is not null), s ->
            transform(filter({every}, a -> a.doc is not null), a -> struct(s.result_no as result_no, a.attempt_no as attempt_no, a.doc as doc))))""").alias("_ds"))
    checks = docs.select("_key", F.expr(f"transform(_ds, x -> struct(x.result_no as result_no, x.attempt_no as attempt_no, from_json(x.doc, '{CHECK}') as c))").alias("_cs"))
    built = """transform(_cs, x -> struct(x.result_no as result_no, x.attempt_no as attempt_no, x.c as c, from_json(from_json(x.c.details, 'build string').build, 'success string, error string') as b,
        case when ltrim(x.c.execution_times) like '[%' then get(filter(from_json(x.c.execution_times, 'array<struct<phase string, seconds string>>'), p -> p.phase = 'build'), 0).seconds
             else from_json(x.c.execution_times, 'map<string,string>')['build'] end as printed))"""
    key_col = F.col("_key").alias(key)
    results = parsed.select(key_col, F.expr("""inline(transform(filter(_rs, s -> s.r is not null), s -> struct(s.result_no as result_no, s.r.topic as topic, s.r.task_dir as task_dir, s.r.status as status,
        s.r.failed_stage as failed_stage, coalesce(s.r.classification, from_json(s.r.stages['evaluation'], 'classification string').classification) as classification, try_cast(s.r.retries as int) as retries, try_cast(s.r.duration_sec as double) as duration_sec)))"""))
    other = lambda doc, *known: f"map_filter(coalesce(from_json({doc}, 'map<string,string>'), map()), (k, v) -> v is not null and k not in ({', '.join(map(repr, known))}))"
    flat_checks = docs.select("_key", F.expr(f"transform(_ds, x -> struct(x.result_no as result_no, x.attempt_no as attempt_no, from_json(x.doc, '{CHECK}') as c, {other('x.doc', 'passed', 'attempt', 'details', 'execution_times', 'issues')} as extra))").alias("_cs")).select(
        key_col, F.expr(f"inline(transform(_cs, x -> struct(x.result_no as result_no, x.attempt_no as attempt_no, {as_flag('x.c.passed')} as passed, size(coalesce(x.c.issues, array())) as n_issues, x.extra as extra)))")
    )
    issues = checks.select(key_col, F.expr("inline(filter(flatten(transform(_cs, x -> transform(coalesce(x.c.issues, array()), (v, n) -> struct(x.result_no as result_no, x.attempt_no as attempt_no, n as issue_no, v as issue)))), y -> y.issue is not null))"))
    listed_times = "transform(from_json(x.c.execution_times, 'array<struct<phase string, seconds string>>'), p -> struct(p.phase as key, p.seconds as value))"
    times = checks.select("_key", F.expr(f"""flatten(transform(_cs, x -> transform(coalesce(case when ltrim(x.c.execution_times) like '[%' then {listed_times} else map_entries(from_json(x.c.execution_times, 'map<string,string>')) end, array()),
        e -> struct(x.result_no as result_no, x.attempt_no as attempt_no, e.key as phase, e.value as printed))))""").alias("_es")).select(
        key_col, F.expr(f"inline(transform(_es, x -> struct(x.result_no as result_no, x.attempt_no as attempt_no, x.phase as phase, x.printed as printed, {as_ms('x.printed')} as ms)))")
    )
    runs = checks.select("_key", F.expr(f"""flatten(transform(_cs, x -> transform(filter(map_entries(coalesce(from_json(x.c.details, 'map<string,string>'), map())), e -> e.key <> 'build' and e.value is not null),
        e -> struct(x.result_no as result_no, x.attempt_no as attempt_no, e.key as run, from_json(e.value, '{RUN}') as u))))""").alias("_us")).select(
        key_col, F.expr(f"inline(transform(_us, x -> struct(x.result_no as result_no, x.attempt_no as attempt_no, x.run as run, try_cast(x.u.exit_code as int) as exit_code, {as_flag('x.u.timed_out')} as timed_out, x.u.stdout_tail as stdout_tail, x.u.stderr_tail as stderr_tail)))")
    )
    stages = parsed.select("_key", F.expr(f"""flatten(transform(filter(_rs, s -> s.r is not null), s -> transform(filter(map_entries(coalesce(s.r.stages, map())), e -> e.key <> 'functional' and e.value is not null),
        e -> struct(s.result_no as result_no, e.key as stage, from_json(e.value, '{STAGE}') as g, {other('e.value', 'status', 'model', 'classification', 'usage', 'functional', 'tier_results')} as extra))))""").alias("_gs")).select(
        key_col, F.expr("""inline(transform(_gs, x -> struct(x.result_no as result_no, x.stage as stage, x.g.status as status, x.g.model as model, x.g.classification as classification,
        try_cast(x.g.usage.prompt_tokens as bigint) as prompt_tokens, try_cast(x.g.usage.completion_tokens as bigint) as completion_tokens, try_cast(x.g.usage.total_tokens as bigint) as total_tokens, x.extra as extra)))""")
    )
    printed_metrics = F.coalesce(F.get_json_object(F.col(doc), "$.metrics"), F.get_json_object(F.col(doc), "$.report.metrics"))
    metrics = df.select(F.col(key), F.explode(F.from_json(printed_metrics, "map<string,string>")).alias("metric", "value"))
    builds = checks.select("_key", F.expr(built).alias("_bs")).select(
        key_col,
        F.expr(f"""inline(transform(filter(_bs, x -> x.b is not null), x -> struct(x.result_no as result_no, x.attempt_no as attempt_no,
            {as_flag('x.b.success')} as build_success, coalesce({as_ms('x.printed')}, -1L) as build_ms, x.b.error as build_error)))"""),
    )
    tiers = parsed.select("_key", F.expr(f"""flatten(transform(filter(_rs, s -> s.r is not null), s -> transform(map_entries(coalesce(from_json(from_json(s.r.stages['evaluation'], 'tier_results string').tier_results, 'map<string,string>'), map())),
        e -> struct(s.result_no as result_no, e.key as tier, from_json(e.value, '{TIER}') as t))))""").alias("_ts"))
    flat_tiers = tiers.select(key_col, F.expr("inline(transform(filter(_ts, x -> x.t is not null), x -> struct(x.result_no as result_no, x.tier as tier, x.t.model as model, try_cast(x.t.passes as bigint) as passes, try_cast(x.t.total as bigint) as total)))"))
    each = tiers.select("_key", F.expr(f"""flatten(transform(filter(_ts, x -> x.t is not null), x -> transform(coalesce(x.t.trials, array()),
        (j, n) -> struct(x.result_no as result_no, x.tier as tier, n as trial_no, j as j, from_json(j, '{TRIAL}') as y)))) as _ys"""))
    trials = each.select(key_col, F.expr(f"""inline(transform(_ys, x -> struct(x.result_no as result_no, x.tier as tier, x.trial_no as trial_no, x.y.trial as trial, {as_flag('x.y.resolved')} as resolved,
        try_cast(x.y.input_tokens as bigint) as input_tokens, try_cast(x.y.output_tokens as bigint) as output_tokens, x.y.failure_mode as failure_mode)))"""))
    # fields without a column, one row each
    unknown = lambda doc, known: f"map_entries({other(doc, *(x.split()[0] for x in known.split(', ')))})"
    row = "struct({} as result_no, {} as tier, {} as trial_no, e.key as field, e.value as value)"
    of_results = base.select(key_col, F.expr(f"""inline(flatten(transform(_results, (d, i) -> transform({unknown('d', RESULT)}, e -> {row.format('i', 'cast(null as string)', 'cast(null as int)')}))))"""))
    of_tiers = parsed.select(key_col, F.expr(f"""inline(flatten(flatten(transform(filter(_rs, s -> s.r is not null), s -> transform(map_entries(coalesce(from_json(from_json(s.r.stages['evaluation'],
        'tier_results string').tier_results, 'map<string,string>'), map())), t -> transform({unknown('t.value', TIER)}, e -> {row.format('s.result_no', 't.key', 'cast(null as int)')}))))))"""))
    of_trials = each.select(key_col, F.expr(f"inline(flatten(transform(_ys, x -> transform({unknown('x.j', TRIAL)}, e -> {row.format('x.result_no', 'x.tier', 'x.trial_no')}))))"))
    others = of_results.unionByName(of_tiers).unionByName(of_trials)
    return {
        "metrics": metrics, "results": results, "stages": stages, "checks": flat_checks, "issues": issues, "times": times, "builds": builds, "runs": runs,
        "tiers": flat_tiers, "trials": trials, "others": others,
    }
