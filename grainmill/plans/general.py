"""Queries of the general data problems (p1, p3, p4, p6) over the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.operators.drift import ALIASES, TRIAL_FIELDS, consistent_table, field_catalogue, field_lifespans, footer_catalogue, schema_changes
from grainmill.operators.logs import parse_log_entries
from grainmill.operators.nested import RESULT, unnest_reports
from grainmill.operators.timestamps import normalize_timestamps
from grainmill.session import table


def _printed_times(spark: SparkSession, d: str) -> DataFrame:
    """Every printed time of the project: one row per value, with its writer and record order."""
    trials = table(spark, d, "trials")
    status = table(spark, d, "task_status")
    both = F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("value")) for c in ("agent_started_at", "agent_ended_at")])
    trials = trials.select(F.lit("trials").alias("table_name"), F.col("trial_key").alias("row_id"), "host_tz", F.col("run_id").alias("writer"), F.inline(both))
    status = status.select(F.lit("task_status").alias("table_name"), F.col("status_id").alias("row_id"), "host_tz", F.col("task_dir").alias("writer"),
                           F.lit("updated_at").alias("field_name"), F.col("updated_at").alias("value"))
    return trials.unionByName(status)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """One instant per printed time that is not yet in the canonical form."""
    got = normalize_timestamps(_printed_times(spark, d), ["table_name", "row_id", "field_name"], "value", "host_tz", ["table_name", "field_name", "writer"], "row_id")
    return got.where("not canonical").select("table_name", "row_id", "field_name", "epoch_us").distinct()


def p3_inferred(spark: SparkSession, d: str) -> DataFrame:
    """The same values with no convention given: day order and repeated hours come from the record order alone."""
    got = normalize_timestamps(_printed_times(spark, d), ["table_name", "row_id", "field_name"], "value", "host_tz", ["table_name", "field_name", "writer"], "row_id",
                               slash_order=None, dot_order=None, repeated_hour=None)
    return got.where("not canonical").select("table_name", "row_id", "field_name", "epoch_us").distinct()


def _log_entries(spark: SparkSession, d: str, recorded: str | None = None) -> DataFrame:
    w = "details.without_solution."
    texts = {"stdout": F.col(w + "stdout_tail"), "stderr": F.col(w + "stderr_tail")}
    return parse_log_entries(table(spark, d, "validation_attempts"), ["attempt_id"], texts, recorded)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Log entries in the tails of validation attempts."""
    return _log_entries(spark, d).select("attempt_id", "stream_name", "first_line", "last_line", "log_level", "component").distinct()


def p1_fields(spark: SparkSession, d: str) -> DataFrame:
    """All fields of every entry: layout, printed time and instant, level, component, message."""
    return _log_entries(spark, d, "recorded_at")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Builds of every functional validation, linked to their result and report."""
    builds = unnest_reports(table(spark, d, "batch_reports"), "report_id", "report_json")["builds"]
    return builds.select("report_id", "result_no", "attempt_no", "build_success", "build_ms").distinct()


def _p4(name: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        return unnest_reports(table(spark, d, "batch_reports"), "report_id", "report_json")[name]

    return query


def _catalogue(spark: SparkSession, d: str) -> DataFrame:
    return field_catalogue(table(spark, d, "trial_files"), ["stream_id"], "file_no", "record_json")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Every change of a stream's top-level fields between its files."""
    return schema_changes(_catalogue(spark, d), ["stream_id"], "file_no").select("stream_id", "file_no", "field_name", "change_kind").distinct()


def p6_lifespans(spark: SparkSession, d: str) -> DataFrame:
    """The column lifespan catalogue of every stream."""
    return field_lifespans(_catalogue(spark, d), ["stream_id"], "file_no")


def p6_table(spark: SparkSession, d: str) -> DataFrame:
    """All valid records of all files under one schema."""
    return consistent_table(table(spark, d, "trial_files"), ["stream_id", "file_no", "record_no"], "record_json")


def p6_values(spark: SparkSession, d: str) -> DataFrame:
    """The plain fields of the consistent table, whatever name and form they were printed in."""
    return p6_table(spark, d).select("stream_id", "file_no", "record_no", "id", "failure_mode", "is_resolved", "total_input_tokens", "total_output_tokens")


def p6_footers(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue of the tables' own files, from their footers alone; a file whose footer can't be read is an error."""
    names = ["tasks", "trials", "documents", "trial_files", "pipeline_results", "pack_limits"]
    # every part of a table, whether it is one file or a folder
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load([f"{d}/{n}.parquet" for n in names])
    files = files.select(F.lit("tables").alias("set"), F.regexp_extract("path", r"/(\w+)\.parquet(?:/[^/]+)?$", 1).alias("file"), "path").where(F.col("file").isin(*names))
    got = footer_catalogue(files, ["set"], "file", "path")
    unread = F.raise_error(F.concat(F.lit("no footer can be read in a file of table "), "file")).cast("string")
    got = got.withColumn("printed", F.when(F.col("n_records").isNull(), unread).otherwise(F.col("printed"))).where("printed is not null")
    return got.groupBy(F.col("file").alias("file_name"), F.col("printed").alias("field_name")).agg(F.bit_or("kinds").alias("kinds"))


QUERIES = {
    "p1_found": p1_found,
    "p1_fields": p1_fields,
    "p3_found": p3_found,
    "p3_inferred": p3_inferred,
    "p4_found": p4_found,
    "p4_results": _p4("results"),
    "p4_checks": _p4("checks"),
    "p4_issues": _p4("issues"),
    "p4_times": _p4("times"),
    "p4_builds": _p4("builds"),
    "p4_runs": _p4("runs"),
    "p4_stages": _p4("stages"),
    "p4_metrics": _p4("metrics"),
    "p4_tiers": _p4("tiers"),
    "p4_trials": _p4("trials"),
    "p4_others": _p4("others"),
    "p6_found": p6_found,
    "p6_lifespans": p6_lifespans,
    "p6_table": p6_table,
    "p6_values": p6_values,
    "p6_footers": p6_footers,
}

_NAME = "case " + " ".join(f"when name in ({', '.join(repr(a) for a in [f, *names])}) then '{f}'" for f, names in ALIASES.items()) + " end"
_SNAKE = "lower(regexp_replace(name,'([a-z0-9])([A-Z])','\\1_\\2','g'))"
_FIELDS = ", ".join(f"'{f}'" for f in TRIAL_FIELDS)
ORACLES = {
    "p4_found": """with r as (select report_id, case when json_type(report_json)='ARRAY' then report_json::json else coalesce(json_extract(report_json,'$.results'), json_extract(report_json,'$.report.results')) end as rs from batch_reports where report_json is not null and json_valid(report_json)),
 e as (select report_id, unnest(range(json_array_length(rs)::bigint))::int as result_no, rs from r where json_type(rs)='ARRAY'), x as (select report_id, result_no, json_extract(rs, '$['||result_no||']') as j from e),
 c as (select report_id, result_no, 0 as attempt_no, json_extract(j,'$.stages.functional') as f from x
  union all select report_id, result_no, substr(k,7)::int, json_extract(j,'$.stages.'||k||'.functional') from (select *, unnest(json_keys(j,'$.stages')) as k from x where json_type(j,'$.stages')='OBJECT') where regexp_matches(k,'^retry_[0-9]+$')
  union all select report_id, result_no, json_extract(a,'$.attempt')::int, a from (select report_id, result_no, unnest(json_extract(j,'$.validation_attempts[*]')) as a from x)),
 d as (select *, case when json_type(f,'$.details')='VARCHAR' then json_extract_string(f,'$.details')::json else json_extract(f,'$.details') end as det from c where json_type(f)='OBJECT'),
 b as (select *, json_extract(det,'$.build') as b, case when json_type(f,'$.execution_times')='ARRAY' then json_extract_string(list_filter(json_extract(f,'$.execution_times[*]'), lambda p: json_extract_string(p,'$.phase')='build')[1],'$.seconds') else json_extract_string(f,'$.execution_times.build') end as t from d)
 select distinct report_id, result_no, attempt_no, case when lower(json_extract_string(b,'$.success')) in ('true','1') then 'true' when lower(json_extract_string(b,'$.success')) in ('false','0') then 'false' else 'unknown' end as build_success,
  coalesce(case when t like '%ms' then round(replace(t,'ms','')::decimal(18,6))::bigint else round(replace(t,'s','')::decimal(18,6)*1000)::bigint end, -1) as build_ms from b where json_type(b)='OBJECT'""",
    "p6_found": f"""with v as (select stream_id, file_no, record_json as j from trial_files where record_json is not null and json_valid(record_json)), o as (select * from v where json_type(j)='OBJECT'), k as (select stream_id, file_no, j, unnest(json_keys(j)) as name from o),
 t as (select stream_id, file_no, name, case when {_SNAKE} in ({_FIELDS}) then {_SNAKE} else coalesce({_NAME}, {_NAME.replace('name in', _SNAKE + ' in')}, name) end as field,
  case json_type(j, '$."'||name||'"') when 'BOOLEAN' then 'b' when 'VARCHAR' then 's' when 'OBJECT' then 'o' when 'ARRAY' then 'a' when 'NULL' then null else 'n' end as kind from k),
 f as (select stream_id, file_no, field, list_sort(list(distinct name)) as names, coalesce(string_agg(distinct kind,'' order by kind),'') as kinds from t group by all),
 n as (select stream_id, file_no, row_number() over (partition by stream_id order by file_no) as no from (select distinct stream_id, file_no from trial_files)),
 s as (select f.*, n.no from f join n using (stream_id, file_no)), p as (select b.stream_id, b.file_no, b.no from n b)
 select cur.stream_id, cur.file_no, cur.field as field_name, 'added' as change_kind from s cur where cur.no>1 and not exists (select 1 from s q where q.stream_id=cur.stream_id and q.field=cur.field and q.no=cur.no-1)
 union all select p.stream_id, p.file_no, old.field, 'removed' from s old join p on p.stream_id=old.stream_id and p.no=old.no+1 where not exists (select 1 from s q where q.stream_id=old.stream_id and q.field=old.field and q.no=old.no+1)
 union all select cur.stream_id, cur.file_no, cur.field, 'renamed' from s cur join s old on old.stream_id=cur.stream_id and old.field=cur.field and old.no=cur.no-1 where not list_has_any(cur.names, old.names)
 union all select cur.stream_id, cur.file_no, cur.field, 'retyped' from s cur join s old on old.stream_id=cur.stream_id and old.field=cur.field and old.no=cur.no-1 where cur.kinds<>'' and old.kinds<>'' and cur.kinds<>old.kinds""",
}


#: Results, functional validations, tiers and trials of the reports as JSON, each with its links.
_REPORTS = """r as (select report_id, case when json_type(report_json)='ARRAY' then report_json::json else coalesce(json_extract(report_json,'$.results'), json_extract(report_json,'$.report.results')) end as rs,
  coalesce(json_extract(report_json,'$.metrics'), json_extract(report_json,'$.report.metrics')) as ms from batch_reports where report_json is not null and json_valid(report_json)),
 e as (select report_id, unnest(range(json_array_length(rs)::bigint))::int as result_no, rs from r where json_type(rs)='ARRAY'), x as (select report_id, result_no, json_extract(rs, '$['||result_no||']') as j from e),
 o as (select * from x where json_type(j)='OBJECT'),
 c as (select report_id, result_no, 0 as attempt_no, json_extract(j,'$.stages.functional') as f from o
  union all select report_id, result_no, substr(k,7)::int, json_extract(j,'$.stages.'||k||'.functional') from (select *, unnest(json_keys(j,'$.stages')) as k from o where json_type(j,'$.stages')='OBJECT') where regexp_matches(k,'^retry_[0-9]+$')
  union all select report_id, result_no, json_extract(a,'$.attempt')::int, a from (select report_id, result_no, unnest(json_extract(j,'$.validation_attempts[*]')) as a from o)),
 ch as (select * from c where json_type(f)='OBJECT'),
 de as (select *, case when json_type(f,'$.details')='VARCHAR' then json_extract_string(f,'$.details')::json else json_extract(f,'$.details') end as det from ch),
 ti as (select report_id, result_no, k as tier, json_extract(j, '$.stages.evaluation.tier_results."'||k||'"') as t from (select *, unnest(json_keys(j,'$.stages.evaluation.tier_results')) as k from o where json_type(j,'$.stages.evaluation.tier_results')='OBJECT')),
 tt as (select * from ti where json_type(t)='OBJECT'),
 tr as (select report_id, result_no, tier, (unnest(range(json_array_length(t,'$.trials')::bigint)))::int as trial_no, t from tt where json_type(t,'$.trials')='ARRAY'), tl as (select report_id, result_no, tier, trial_no, json_extract(t,'$.trials['||trial_no||']') as q from tr)"""
_s = lambda j, k: f"json_extract_string({j},'$.{k}')"
_flag = lambda x: f"case when lower({x}) in ('true','t','yes','1','1.0') then 'true' when lower({x}) in ('false','f','no','0','0.0') then 'false' else 'unknown' end"
_ms = "case when {0} like '%ms' then round(trim(replace({0},'ms',''))::decimal(18,6))::bigint else round(trim(replace({0},'s',''))::decimal(18,6)*1000)::bigint end"
ORACLES |= {
    "p4_results": f"""with {_REPORTS} select report_id, result_no, {_s('j', 'topic')} as topic, {_s('j', 'task_dir')} as task_dir, {_s('j', 'status')} as status, {_s('j', 'failed_stage')} as failed_stage,
 coalesce({_s('j', 'classification')}, {_s('j', 'stages.evaluation.classification')}) as classification, try_cast({_s('j', 'retries')} as int) as retries, try_cast({_s('j', 'duration_sec')} as double) as duration_sec from o""",
    "p4_tiers": f"with {_REPORTS} select report_id, result_no, tier, {_s('t', 'model')} as model, try_cast({_s('t', 'passes')} as bigint) as passes, try_cast({_s('t', 'total')} as bigint) as total from tt",
    "p4_trials": f"""with {_REPORTS} select report_id, result_no, tier, trial_no, {_s('q', 'trial')} as trial, {_flag(_s('q', 'resolved'))} as resolved, try_cast({_s('q', 'input_tokens')} as bigint) as input_tokens,
 try_cast({_s('q', 'output_tokens')} as bigint) as output_tokens, {_s('q', 'failure_mode')} as failure_mode from tl""",
    "p4_others": f"""with {_REPORTS}, u as (select report_id, result_no, null::varchar as tier, null::int as trial_no, unnest(json_keys(j)) as field, j as d from o union all select report_id, result_no, tier, null, unnest(json_keys(t)), t from tt
  union all select report_id, result_no, tier, trial_no, unnest(json_keys(q)), q from tl where json_type(q)='OBJECT')
 select report_id, result_no, tier, trial_no, field, json_extract_string(d,'$."'||field||'"') as value from u where json_extract_string(d,'$."'||field||'"') is not null and
  field not in ({', '.join(repr(x.split()[0]) for x in RESULT.split(', '))}) and (tier is null or trial_no is not null or field not in ('model','passes','total','trials')) and (trial_no is null or field not in ('trial','resolved','failure_mode','input_tokens','output_tokens'))""",
    "p4_metrics": f"with {_REPORTS}, m as (select report_id, unnest(json_keys(ms)) as metric, ms from r where json_type(ms)='OBJECT') select report_id, metric, json_extract_string(ms, '$.\"'||metric||'\"') as value from m",
    "p4_builds": f"""with {_REPORTS}, b as (select *, json_extract(det,'$.build') as b, case when json_type(f,'$.execution_times')='ARRAY' then json_extract_string(list_filter(json_extract(f,'$.execution_times[*]'), lambda p: json_extract_string(p,'$.phase')='build')[1],'$.seconds') else {_s('f', 'execution_times.build')} end as t from de)
 select report_id, result_no, attempt_no, {_flag(_s('b', 'success'))} as build_success, coalesce({_ms.format('t')}, -1) as build_ms, {_s('b', 'error')} as build_error from b where json_type(b)='OBJECT'""",
    "p4_issues": f"""with {_REPORTS}, i as (select report_id, result_no, attempt_no, (unnest(range(json_array_length(f,'$.issues')::bigint)))::int as issue_no, f from ch where json_type(f,'$.issues')='ARRAY')
 select report_id, result_no, attempt_no, issue_no, json_extract_string(f,'$.issues['||issue_no||']') as issue from i where json_extract_string(f,'$.issues['||issue_no||']') is not null""",
    "p4_times": f"""with {_REPORTS}, t as (select report_id, result_no, attempt_no, {_s('p', 'phase')} as phase, {_s('p', 'seconds')} as printed from (select *, unnest(json_extract(f,'$.execution_times[*]')) as p from ch where json_type(f,'$.execution_times')='ARRAY')
  union all select report_id, result_no, attempt_no, k, json_extract_string(f,'$.execution_times."'||k||'"') from (select *, unnest(json_keys(f,'$.execution_times')) as k from ch where json_type(f,'$.execution_times')='OBJECT'))
 select report_id, result_no, attempt_no, phase, printed, {_ms.format('printed')} as ms from t""",
    "p4_runs": f"""with {_REPORTS}, k as (select *, unnest(json_keys(det)) as run from de where json_type(det)='OBJECT'), u as (select *, json_extract(det, '$."'||run||'"') as u from k where run<>'build')
 select report_id, result_no, attempt_no, run, try_cast({_s('u', 'exit_code')} as int) as exit_code, {_flag(_s('u', 'timed_out'))} as timed_out, {_s('u', 'stdout_tail')} as stdout_tail, {_s('u', 'stderr_tail')} as stderr_tail from u where json_type(u)<>'NULL'""",
    "p6_lifespans": f"""with v as (select stream_id, file_no, record_json as j from trial_files where record_json is not null and json_valid(record_json)), o as (select * from v where json_type(j)='OBJECT'), k as (select stream_id, file_no, j, unnest(json_keys(j)) as name from o),
 t as (select stream_id, file_no, name, case when {_SNAKE} in ({_FIELDS}) then {_SNAKE} else coalesce({_NAME}, {_NAME.replace('name in', _SNAKE + ' in')}, name) end as field,
  case json_type(j, '$."'||name||'"') when 'BOOLEAN' then 1 when 'VARCHAR' then 4 when 'OBJECT' then 8 when 'ARRAY' then 16 when 'NULL' then 0 else 2 end as kind from k),
 f as (select stream_id, file_no, field, string_agg(distinct name, ',' order by name) as printed, bit_or(kind)::int as kinds from t group by all),
 n as (select stream_id, file_no, row_number() over (partition by stream_id order by file_no) as no from (select distinct stream_id, file_no from trial_files)),
 s as (select f.*, no, no - lag(no) over w = 1 and printed = lag(printed) over w and kinds = lag(kinds) over w as same from f join n using (stream_id, file_no) window w as (partition by stream_id, field order by no)),
 i as (select *, sum(case when same then 0 else 1 end) over (partition by stream_id, field order by no) as island from s)
 select stream_id, field, printed, kinds, min(file_no)::int as first_file, max(file_no)::int as last_file, count(*) as n_files from i group by stream_id, field, island, printed, kinds""",
    "p6_values": """with v as (select stream_id, file_no, record_no, record_json as j from trial_files where record_json is not null and json_valid(record_json)), o as (select * from v where json_type(j)='OBJECT'),
 w as (select stream_id, file_no, record_no, coalesce(j->>'is_resolved', j->>'isResolved', j->>'resolved', j->>'solved') as r, coalesce(j->>'total_input_tokens', j->>'totalInputTokens', j->>'input_tokens', j->>'prompt_tokens') as i, coalesce(j->>'total_output_tokens', j->>'completion_tokens') as u,
  j->>'id' as id, j->>'failure_mode' as failure_mode from o)
 select stream_id, file_no, record_no, id, failure_mode, case when lower(r) in ('true','1','1.0') then true when lower(r) in ('false','0','0.0') then false end as is_resolved,
  try_cast(replace(case when i like '{%' then i->>'count' else i end, ',', '') as bigint) as total_input_tokens, try_cast(replace(case when u like '{%' then u->>'count' else u end, ',', '') as bigint) as total_output_tokens from w""",
    "p6_footers": """select distinct table_name as file_name, column_name as field_name, case when data_type='BOOLEAN' then 1 when data_type like '%[]' then 16 when data_type like 'STRUCT%' or data_type like 'MAP%' then 8
 when data_type in ('TINYINT','SMALLINT','INTEGER','BIGINT','FLOAT','DOUBLE') then 2 else 4 end as kinds from duckdb_columns() where table_name in ('tasks','trials','documents','trial_files','pipeline_results','pack_limits')""",
}


def _log_sql() -> str:
    """p1_found in SQL: one pattern per layout on lines without colour codes, segments by running counts."""
    lv = "(?i:(trace|debug|dbg|info|inf|notice|warning|warn|wrn|error|err|critical|crit|fatal))"
    day, clock, name = r"\d{4}-\d\d-\d\d", r"\d\d:\d\d:\d\d", r"([^\s\[\]():|]+)"
    layouts = [  # pattern, group of the level, group of the component (0: none)
        (rf"^{day}T{clock}[.,]?\d*Z? \[{lv}\] {name}: ", 1, 2),
        (rf"^{day} {clock},\d+ - (\S+) - {lv} +- ", 2, 1),
        (rf"^\[\d{{9,19}}\.?\d*\] <{lv}> (\S+) :: ", 1, 2),
        (rf"^\[{day} {clock}\] ([^\s:]+)\.{lv}: ", 2, 1),
        (rf"^{day} {clock}\.\d+ \| {lv} *\| ([^\s:|]+):[^\s:]+:\d+ - ", 1, 2),
        (rf"^[A-Z][a-z]{{2}} [ \d]\d {clock} \S+ ([^\s\[\]]+)\[\d+\]: {lv}: ", 2, 1),
        (rf"^\d{{4}}/\d\d/\d\d {clock} \[{lv}\] \d+#\d+: ", 1, 0),
        (rf"^{clock}[.,]\d+ \[[^\]]+\] {lv} +(\S+) - ", 1, 2),
        (rf"^{lv} {day}T{clock}[.,]?\d*\S* \(([^\s()]+)\) ", 1, 2),
        (rf"^([DIWECF])\d{{4}} {clock}\.\d+ +\d+ ([^\s:\]]+):\d+\] ", 1, 2),
    ]
    q = lambda p: "'" + p.replace("'", "''") + "'"
    level = " ".join(f"when regexp_matches(s,{q(p)}) then regexp_extract(s,{q(p)},{a})" for p, a, _ in layouts)
    comp = " ".join(f"when regexp_matches(s,{q(p)}) then {f'regexp_extract(s,{q(p)},{b})' if b else q('')}" for p, _, b in layouts)
    pairs = r"^(time=\S*\d\d:\d\d\S* level=|level=\S+ time=\S*\d\d:\d\d)"
    j = lambda *ks: "coalesce(" + ", ".join(f"""json_extract_string(js,'$."{k}"')""" for k in ks) + ")"
    level = f"case {level} when regexp_matches(s,{q(pairs)}) then regexp_extract(s,'(^| )level=(\\S+)',2) when js is not null and {j('ts', 'time', '@timestamp', 'timestamp')} is not null then {j('lvl', 'level', 'severity')} end"
    comp = f"case {comp} when regexp_matches(s,{q(pairs)}) then regexp_extract(s,' component=(\\S+)',1) when js is not null then coalesce({j('logger', 'component', 'name')},'') end"
    word = "case when lower(lv) in ('trace','debug','dbg','d') then 'DEBUG' when lower(lv) in ('info','inf','notice','i') then 'INFO' when lower(lv) in ('warning','warn','wrn','w') then 'WARNING' when lower(lv) in ('error','err','e') then 'ERROR' when lower(lv) in ('critical','crit','fatal','c','f') then 'CRITICAL' end"
    w = "details.without_solution."
    return f"""with t as (select attempt_id, 'stdout' as stream_name, {w}stdout_tail as x from validation_attempts union all select attempt_id, 'stderr', {w}stderr_tail from validation_attempts),
 l as (select attempt_id, stream_name, unnest(string_split(x, chr(10))) as line, generate_subscripts(string_split(x, chr(10)), 1) as n from t where x <> ''),
 c as (select *, regexp_replace(rtrim(line, chr(13)), '\\x1b\\[[0-9;]*m', '', 'g') as s from l), d as (select *, case when starts_with(s,'{{') and json_valid(s) then s::json end as js from c),
 h as (select attempt_id, stream_name, n, regexp_full_match(line, '\\s*') as empty, {level} as lv, {comp} as comp from d),
 k as (select *, {word} as log_level from h), g as (select *, count(*) filter (log_level is not null or empty) over (partition by attempt_id, stream_name order by n) as seg from k)
 select distinct attempt_id, stream_name, min(n)::int as first_line, max(n)::int as last_line, any_value(log_level) as log_level, coalesce(any_value(comp) filter (log_level is not null),'') as component from g group by attempt_id, stream_name, seg having count(log_level)>0"""


ORACLES["p1_found"] = _log_sql()


def _times_sql() -> str:
    """p3_found in SQL: one format per shape, the stated conventions, the earlier of two occurrences."""
    parts = [("trials", "trial_key", "agent_started_at"), ("trials", "trial_key", "agent_ended_at"), ("task_status", "status_id", "updated_at")]
    rows = " union all ".join(f"select '{t}' as table_name, {k} as row_id, '{c}' as field_name, {c} as raw, host_tz from {t}" for t, k, c in parts)
    hours = "case zone when 'UTC' then 0 when 'GMT' then 0 when 'Z' then 0 when 'z' then 0 when 'EST' then -5 when 'EDT' then -4 when 'PST' then -8 when 'PDT' then -7 when 'CET' then 1 when 'CEST' then 2 when 'AEST' then 10 when 'AEDT' then 11 when 'JST' then 9 end"
    return f"""with v as ({rows}), s as (select *, trim(raw, ' ' || chr(9) || chr(10) || chr(13)) as x from v where raw is not null and not regexp_full_match(raw, '\\d{{4}}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d\\.\\d{{6}}\\+00:00')),
 p as (select *, case when regexp_full_match(x,'\\d{{10}}') then try_cast(x as bigint)*1000000 when regexp_full_match(x,'\\d{{13}}') then try_cast(x as bigint)*1000 when regexp_full_match(x,'\\d{{16}}') then try_cast(x as bigint) when regexp_full_match(x,'\\d{{10}}\\.\\d{{3}}') then try_cast(replace(x,'.','') as bigint)*1000 end as ep,
  case when regexp_matches(x,'^\\d{{4}}-') then try_strptime(replace(upper(substr(x,1,16)),'T',' ')||':'||coalesce(nullif(regexp_extract(x,'^.{{16}}:(\\d\\d)',1),''),'00'),'%Y-%m-%d %H:%M:%S') when regexp_matches(x,'^\\d{{8}}[-T]') then try_strptime(substr(x,1,8)||substr(x,10,6),'%Y%m%d%H%M%S')
   when contains(x,'/') then try_strptime(x,'%m/%d/%Y %I:%M:%S %p') when regexp_matches(x,'^\\d\\d\\.') then try_strptime(x,'%d.%m.%Y %H:%M:%S') when regexp_matches(x,'^[A-Za-z]{{3}} [A-Za-z]{{3}} ') then try_strptime(x,'%a %b %d %H:%M:%S %Y')
   else try_strptime(regexp_extract(x,'(\\d{{1,2}} [A-Za-z]{{3}} \\d{{4}} \\d\\d:\\d\\d:\\d\\d)',1),'%d %b %Y %H:%M:%S') end as lt,
  case when regexp_matches(x,'^\\d{{4}}-.*:\\d\\d[.,]\\d') then rpad(substr(regexp_extract(x,':\\d\\d[.,](\\d+)',1),1,6),6,'0')::bigint else 0 end as us,
  regexp_extract(x,'([Zz]|[+-]\\d\\d(:?\\d\\d)?|[A-Z]{{3,4}}|\\[[^\\]]+\\])$',1) as zone from s),
 o as (select *, case when starts_with(zone,'[') then substr(zone,2,length(zone)-2) when zone='' then coalesce(host_tz,'UTC') end as region, case when regexp_matches(zone,'^[+-]') then (case when zone[1]='-' then -1 else 1 end)*(substr(zone,2,2)::int*60+coalesce(nullif(regexp_extract(zone,'^...:?(\\d\\d)$',1),''),'0')::int) else ({hours})*60 end as off from p),
 e as (select *, epoch_us(timezone(region, lt)) as late from o), f as (select *, case when timezone(region, timezone('UTC', make_timestamp(late-3600000000)))=lt then late-3600000000 else late end as early from e)
 select distinct table_name, row_id, field_name, coalesce(ep, case when region is not null then early else epoch_us(lt)-off::bigint*60000000 end + us) as epoch_us from f where ep is not null or lt is not null"""


ORACLES["p3_found"] = _times_sql()
