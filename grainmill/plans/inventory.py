"""Queries of the engine's own operators over the project's tables, each with its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.session import cut_lineage, table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


from grainmill.functions import fixed, scalars as S  # noqa: E402
from grainmill.operators import codefeatures, diversity, merge, metrics, quality, sampling, trials, validate  # noqa: E402
from grainmill.sources import readers  # noqa: E402

_GEN_A = "coalesce(status,'') not in ('generation_failed','retry_generation_failed') and not starts_with(coalesce(status,''),'error')"
_GEN_B = "coalesce(status,'') <> 'generation_failed' and not starts_with(coalesce(status,''),'error')"
_RATIO = "coalesce({0}::double / nullif({1}, 0), 0.0)"


def _funnel_sql(generated: str, evaluated: str, group: str, extra: str = "") -> str:
    return f"""
with f as (select batch, count(*) as total, count(*) filter ({generated}) as generated, count(*) filter (coalesce(stages.structural.passed, false)) as structural,
 count(*) filter (coalesce(stages.functional.passed, false)) as functional, count(*) filter ({evaluated}) as evaluated, count(*) filter (classification='learnable') as learnable,
 count(*) filter (classification='too_easy') as too_easy, count(*) filter (classification='too_hard') as too_hard, coalesce(sum(stages.generate.usage.total_tokens),0)::bigint as tokens,
 coalesce(sum(round(duration_sec*10)::bigint),0)::bigint as duration_ds{extra} from pipeline_results group by {group})
select *, {_RATIO.format('learnable', 'total')} as learnable_yield, {_RATIO.format('functional', 'generated')} as functional_rate, {_RATIO.format('learnable', 'evaluated')} as learnable_rate from f"""


_FUNNEL_A = _funnel_sql(_GEN_A, "coalesce(classification<>'', false)", "rollup(batch)")


def _results(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pipeline_results")


def _trials(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "trials")


@query(_FUNNEL_A)
def batch_funnel(spark, d):
    """Funnel counts and rates of every batch and, under a null batch, of all."""
    return metrics.funnel(_results(spark, d), ["batch"], overall=True)


@query(f"""with c as ({_funnel_sql(_GEN_A, "coalesce(classification<>'', false)", "batch")}),
 s as (select batch, unnest([0,1,2,3,4,5]) as step_no, unnest(['total','generated','structural','functional','evaluated','learnable']) as step, unnest([total,generated,structural,functional,evaluated,learnable]) as n from c)
 select batch, step_no, step, n, case when step_no > 0 then coalesce(n::double / nullif(lag(n) over (partition by batch order by step_no), 0), 0.0) end as conversion from s""")
def funnel_conversion(spark, d):
    """Ratio of every funnel step to the one before, per batch."""
    return metrics.funnel_steps(metrics.funnel(_results(spark, d), ["batch"]), ["batch"])


@query(_funnel_sql(_GEN_B, "stages.evaluation is not null", "batch"))
def batch_report(spark, d):
    """A batch's own report: its other notions of generated and evaluated."""
    aggregates = metrics.funnel_aggregates(metrics.generated_per_batch(), F.col("stages.evaluation").isNotNull())
    return metrics.with_rates(_results(spark, d).groupBy("batch").agg(*aggregates))


@query("""select batch, count(*) filter (stages.functional is not null) as functional_tested, count(*) filter (coalesce(status,'') not in ('generation_failed','error')) as succeeded from pipeline_results group by batch""")
def stage_presence(spark, d):
    """Rows whose functional stage exists and rows kept for diversity."""
    return _results(spark, d).groupBy("batch").agg(F.count_if(F.col("stages.functional").isNotNull()).alias("functional_tested"), F.count_if(metrics.succeeded()).alias("succeeded"))


@query("""with c as (select batch, case when coalesce(status,'')='completed' then null when coalesce(failed_stage,'')<>'' then failed_stage when status='generation_failed' or starts_with(status,'phase') then 'generation'
 when contains(status,'structural') then 'structural' when contains(status,'functional') or contains(status,'infrastructure') then 'functional' when starts_with(status,'error') then 'exception' else 'other' end as category from pipeline_results)
 select batch, category, count(*) as n from c where category is not null group by all""")
def error_taxonomy(spark, d):
    """Error categories of every batch."""
    return _results(spark, d).select("batch", metrics.error_category().alias("category")).where("category is not null").groupBy("batch", "category").agg(F.count("*").alias("n"))


@query("""with s as (select batch, 'generate' as kind, stages.generate.usage.prompt_tokens as p, stages.generate.usage.completion_tokens as c from pipeline_results
 union all select batch, regexp_replace(e.key,'_[0-9]+$',''), e.value.usage.prompt_tokens, e.value.usage.completion_tokens from (select batch, unnest(map_entries(extra_stages)) as e from pipeline_results) where regexp_matches(e.key,'^(regenerate|retry_|difficulty_adj_)'))
 select batch, sum(coalesce(p,0))::bigint as prompt, sum(coalesce(c,0))::bigint as completion, sum(coalesce(p,0)*(case kind when 'generate' then 3 when 'retry' then 2 else 0 end)+coalesce(c,0)*(case kind when 'generate' then 15 when 'retry' then 10 else 0 end))::bigint as cost_units from s group by batch""")
def usage_by_batch(spark, d):
    """Tokens of all generation stages of a batch, weighted by a given rate table."""
    rates = spark.createDataFrame([("generate", 3, 15), ("retry", 2, 10)], "kind string, prompt_rate long, completion_rate long")
    return metrics.weighted_usage(metrics.stage_usage(_results(spark, d), "result_id"), rates, ["batch"])


@query("""select stage, count(*) as n, sum(p)::bigint as prompt, sum(c)::bigint as completion from (select 'generate' as stage, coalesce(stages.generate.usage.prompt_tokens,0) as p, coalesce(stages.generate.usage.completion_tokens,0) as c from pipeline_results
 union all select e.key, coalesce(e.value.usage.prompt_tokens,0), coalesce(e.value.usage.completion_tokens,0) from (select unnest(map_entries(extra_stages)) as e from pipeline_results) where regexp_matches(e.key,'^(regenerate|retry_|difficulty_adj_)')) group by stage""")
def usage_by_stage(spark, d):
    """Cumulative usage over attempts, by stage key."""
    return metrics.stage_usage(_results(spark, d), "result_id").groupBy("stage").agg(F.count("*").alias("n"), F.sum("prompt").alias("prompt"), F.sum("completion").alias("completion"))


@query("select result_id, batch, topic, coalesce(pass_rate,0.0) as pass_rate, coalesce(retries,0) as retries from pipeline_results where classification='learnable'")
def learnable_inventory(spark, d):
    """All learnable rows with defaults."""
    return _results(spark, d).where("classification = 'learnable'").select("result_id", "batch", "topic", F.coalesce("pass_rate", F.lit(0.0)).alias("pass_rate"), F.coalesce("retries", F.lit(0)).alias("retries"))


_CLS = "coalesce(trim(classification)<>'',false)"


@query(f"""with rep as (select * from pipeline_results where origin='report'), inc as (select * from pipeline_results where origin<>'report'),
 late as (select * from (select *, row_number() over (partition by batch, topic order by recorded_at desc, result_id desc) as rn from inc where {_CLS} and batch in (select batch from rep)) where rn=1)
 select r.batch, case when not {_CLS.replace('classification', 'r.classification')} and l.result_id is not null then l.result_id else r.result_id end as result_id from rep r left join late l on r.batch=l.batch and r.topic=l.topic
 union all select l.batch, l.result_id from late l where not exists (select 1 from rep r where r.batch=l.batch and r.topic=l.topic)
 union all select batch, result_id from inc where batch not in (select batch from rep)""")
def report_merge(spark, d):
    """Reports merged with their incremental logs: which row stands."""
    r = _results(spark, d)
    cols = ["batch", "topic", "recorded_at", "result_id", "classification"]
    got = merge.report_merge(r.where("origin = 'report'").select(cols), r.where("origin <> 'report'").select(cols), ["batch", "topic"], ["recorded_at", "result_id"], F.coalesce(F.trim("classification") != "", F.lit(False)))
    return got.select("batch", "result_id")


@query("select distinct topic from pipeline_results where topic<>'' and status='completed'")
def completed_topics(spark, d):
    return readers.completed_topics(_results(spark, d).where("status = 'completed'"))


@query("select task_key, task_id from tasks t where not exists (select 1 from trials r where r.task_id=t.task_id)")
def remaining_tasks(spark, d):
    """Registered tasks without any trial."""
    return merge.remaining(table(spark, d, "tasks").select("task_key", "task_id"), _trials(spark, d), "task_id").select("task_key", "task_id")


@query("""select task_id, position, arg_max(trial_key, trial_key) as trial_key from trials join (select task_id, min(task_key) as position from tasks group by task_id) using (task_id)
 where trial_key in (select max(trial_key) from trials where coalesce(ingested_at >= timestamp '2025-05-01', false) group by task_id) or task_id not in (select task_id from trials where task_id is not null and coalesce(ingested_at >= timestamp '2025-05-01', false)) group by all""")
def resume_plan(spark, d):
    """Latest trial of every planned task, those after a restart winning over those before."""
    t = _trials(spark, d).select("task_id", "trial_key", F.coalesce(F.col("ingested_at") >= F.lit("2025-05-01").cast("timestamp_ntz"), F.lit(False)).alias("fresh"))
    plan = table(spark, d, "tasks").groupBy("task_id").agg(F.min("task_key").alias("position"))
    got = merge.resume_merge(t.where("not fresh").drop("fresh"), t.where("fresh").drop("fresh"), plan, "task_id", "trial_key")
    return got.select("task_id", "position", "trial_key")


@query("select task_id, trial_name, trial_key from (select *, row_number() over (partition by task_id, trial_name order by ingested_at desc nulls last, trial_key desc) as rn from trials) where rn=1")
def trial_dedup(spark, d):
    """The latest delivery of every trial."""
    return merge.last_wins(_trials(spark, d).select("task_id", "trial_name", "ingested_at", "trial_key"), ["task_id", "trial_name"], ["ingested_at", "trial_key"]).drop("ingested_at")


@query("""with e as (select distinct task_id from tasks), a as (select task_id, count(*) as n, count(*) filter (coalesce(is_resolved,false)) as r from trials group by task_id)
 select coalesce(e.task_id,a.task_id) as task_id, coalesce(n,0) as n_actual, coalesce(r,0) as n_resolved, case when e.task_id is null then 'unexpected' when coalesce(n,0)=0 then 'not_started' when n<5 then 'incomplete' when n=r then 'passed' else 'failed' end as state from e full join a on e.task_id=a.task_id""")
def run_status(spark, d):
    """Registered tasks against their trials."""
    return merge.run_status(table(spark, d, "tasks"), _trials(spark, d), "task_id", 5, F.col("is_resolved"))


@query("select task_id from tasks group by task_id having task_id not in (select task_id from trials where task_id is not null group by task_id having count(*) >= 5)")
def resume_incomplete(spark, d):
    """Tasks that still lack some of their attempts."""
    done = _trials(spark, d).groupBy("task_id").agg(F.count("*").alias("n")).where("n >= 5")
    return table(spark, d, "tasks").select("task_id").distinct().join(done, "task_id", "left_anti")


@query("select distinct task_id from trials where task_id is not null except select task_id from tasks")
def unexpected_tasks(spark, d):
    return _trials(spark, d).select("task_id").where("task_id is not null").distinct().subtract(table(spark, d, "tasks").select("task_id"))


@query("""select task_dir, stage, classification, pass_rate, status_id from (select *, row_number() over (partition by task_dir order by received_at desc nulls last, status_id desc) as rn from task_status) where rn=1""")
def latest_status(spark, d):
    """The latest status document of every task."""
    s = table(spark, d, "task_status").select("task_dir", "stage", "classification", "pass_rate", "received_at", "status_id")
    return merge.last_wins(s, ["task_dir"], ["received_at", "status_id"]).drop("received_at")


@query("""with st as (select task_dir, classification, pass_rate from (select *, row_number() over (partition by task_dir order by received_at desc nulls last, status_id desc) as rn from task_status) where rn=1),
 rs as (select task_dir, classification, pass_rate from (select *, row_number() over (partition by task_dir order by recorded_at desc nulls last, result_id desc) as rn from pipeline_results where task_dir is not null) where rn=1)
 select b.task_dir, coalesce(st.classification, rs.classification) as classification, coalesce(st.pass_rate, rs.pass_rate) as pass_rate from (select task_dir from st union select task_dir from rs) b left join st using (task_dir) left join rs using (task_dir)""")
def status_precedence(spark, d):
    """Class and rate of every task directory: from its status if it has them, else from its latest result."""
    st = merge.last_wins(table(spark, d, "task_status").select("task_dir", "classification", "pass_rate", "received_at", "status_id"), ["task_dir"], ["received_at", "status_id"])
    rs = merge.last_wins(_results(spark, d).where("task_dir is not null").select("task_dir", "classification", "pass_rate", "recorded_at", "result_id"), ["task_dir"], ["recorded_at", "result_id"])
    return merge.by_precedence(st.select("task_dir").union(rs.select("task_dir")), [st, rs], "task_dir", ["classification", "pass_rate"])


@query("""select result_id, max(cast(substr(e.key, 16) as int)) as round_no from (select result_id, unnest(map_entries(extra_stages)) as e from pipeline_results) where starts_with(e.key,'difficulty_adj_') group by result_id""")
def latest_adjustment(spark, d):
    """The last adjustment round of every result that has one."""
    e = _results(spark, d).select("result_id", F.explode("extra_stages").alias("key", "value")).where(F.col("key").startswith("difficulty_adj_"))
    return e.groupBy("result_id").agg(F.max(F.substring("key", 16, 9).cast("int")).alias("round_no"))


@query("""with a as (select task_dir, attempt, passed from (select *, row_number() over (partition by task_dir, attempt order by recorded_at desc nulls last, attempt_id desc) as rn from validation_attempts) where rn=1)
 select task_dir, attempt, passed, coalesce((select bool_or(b.passed <> a.passed) from a b where b.task_dir=a.task_dir and b.attempt<a.attempt), false) as overshot from a where attempt is not null and passed is not null""")
def attempt_flips(spark, d):
    """Attempts whose outcome differs from an earlier one of the task."""
    a = merge.last_wins(table(spark, d, "validation_attempts").select("task_dir", "attempt", "passed", "recorded_at", "attempt_id"), ["task_dir", "attempt"], ["recorded_at", "attempt_id"])
    a = a.where("attempt is not null and passed is not null")
    return trials.overshoots(a, "task_dir", "attempt", "passed").select("task_dir", "attempt", "passed", "overshot")


@query("""with l as (select result_id, regexp_replace(replace(lower(substr(topic,1,30)),' ','-'),'[^a-z0-9-]','','g') as p from pipeline_results where topic is not null), n as (select distinct task_dir from pipeline_results where task_dir is not null and task_dir<>'')
 select result_id, min(task_dir) as task_dir from l join n on contains(task_dir, p) where p<>'' group by result_id""")
def topic_directory(spark, d):
    """The first task directory whose name contains the topic's short slug."""
    r = _results(spark, d)
    return merge.contains_match(r.select("result_id", S.short_slug(F.col("topic")).alias("p")), "result_id", "p", r.select("task_dir"), "task_dir")


@query("""select batch, result_id, coalesce(result_id > (select min(result_id) from pipeline_results q where q.batch=p.batch and coalesce(starts_with(q.status,'error'),false)), false) as skipped from pipeline_results p""")
def circuit_breaker(spark, d):
    """Rows after a batch's first error."""
    r = _results(spark, d).select("batch", "result_id", "status")
    return merge.tripped(r, "result_id", F.coalesce(F.col("status").startswith("error"), F.lit(False)), ["batch"]).select("batch", "result_id", "skipped")


@query("""select 0 as stream, status_id as seq, coalesce(received_at, timestamp '1970-01-01') as at from task_status union all select 1, attempt_id, coalesce(recorded_at, timestamp '1970-01-01') from validation_attempts""")
def merged_events(spark, d):
    """Status updates and validation attempts in one stable time order."""
    a = table(spark, d, "task_status").select(F.col("received_at").cast("timestamp").alias("at"), F.col("status_id").alias("seq"))
    b = table(spark, d, "validation_attempts").select(F.col("recorded_at").cast("timestamp").alias("at"), F.col("attempt_id").alias("seq"))
    a, b = (x.withColumn("at", F.unix_micros("at")) for x in (a, b))
    return merge.merge_events(a, b, "at", "seq").withColumn("at", F.timestamp_micros("at").cast("timestamp_ntz"))


_K = "unnest([1,2,4,8,16,32,64,128,256,512,1024,5,10])"


@query(f"""with p as (select task_id, count(*) as n, count(*) filter (coalesce(is_resolved,false)) as c from trials group by task_id), k as (select distinct {_K}::bigint as k)
 select k, count(*) as n_tasks, avg(case when c=0 then 0.0 when n-c<k then 1.0 else 1.0-list_reduce(list_transform(range(n-c+1,n+1), lambda i: 1.0-k::double/i), lambda a, b: a*b) end) as pass_at_k
 from p join k on n>=k where k<=(select min(n) from p) group by k""")
def pass_at_k(spark, d):
    """Mean pass@k over tasks."""
    return trials.pass_at_k_table(_trials(spark, d), "task_id", F.col("is_resolved"))


@query("""select task_id, count(*) as n, count(*) filter (coalesce(is_resolved,false)) as c, case when count(*) filter (coalesce(is_resolved,false))=0 then 0.0 when count(*)<2 then null when count(*)-count(*) filter (coalesce(is_resolved,false))<2 then 1.0
 else 1.0-((count(*)-count(*) filter (coalesce(is_resolved,false)))*(count(*)-count(*) filter (coalesce(is_resolved,false))-1))::double/(count(*)*(count(*)-1)) end as pass_at_2 from trials group by task_id""")
def task_pass_at_2(spark, d):
    """pass@2 of every task with two or more attempts, in closed form as the check."""
    per = _trials(spark, d).groupBy("task_id").agg(F.count("*").alias("n"), F.count_if(F.coalesce("is_resolved", F.lit(False))).alias("c"))
    n, c = F.col("n"), F.col("c")
    closed = F.when(c == 0, 0.0).when(n < 2, None).when(n - c < 2, 1.0).otherwise(1.0 - ((n - c) * (n - c - 1)) / (n * (n - 1)))
    return per.withColumn("pass_at_2", closed)


@query(f"""select run_id, count(*) filter (coalesce(is_resolved,false)) as n_resolved, count(*) filter (not coalesce(is_resolved,false)) as n_unresolved, {_RATIO.format('count(*) filter (coalesce(is_resolved,false))', 'count(*)')} as accuracy from trials group by run_id""")
def run_accuracy(spark, d):
    return trials.run_accuracy(_trials(spark, d), ["run_id"], F.col("is_resolved"))


@query("""select coalesce(failure_mode,'unset') as failure_mode, count(*) filter (not coalesce(is_resolved,false)) as n, count(*) filter (not coalesce(is_resolved,false))::double/(select count(*) from trials) as share from trials group by 1 having count(*) filter (not coalesce(is_resolved,false))>0""")
def failure_modes(spark, d):
    return trials.failure_modes(_trials(spark, d), "failure_mode", F.col("is_resolved"))


@query("""select run_id, sum(coalesce(total_input_tokens,0))::bigint as input_tokens, sum(coalesce(total_output_tokens,0))::bigint as output_tokens, sum(coalesce(total_input_tokens,0))::double/count(*) as mean_input, count(distinct failure_mode) as n_modes from trials group by run_id""")
def run_tokens(spark, d):
    """Token totals and mean per run, and the number of failure modes met."""
    i, o = (F.coalesce(c, F.lit(0)) for c in ("total_input_tokens", "total_output_tokens"))
    return _trials(spark, d).groupBy("run_id").agg(F.sum(i).alias("input_tokens"), F.sum(o).alias("output_tokens"), (F.sum(i) / F.count("*")).alias("mean_input"), F.count_distinct("failure_mode").alias("n_modes"))


@query("""select trial_key, coalesce(len(list_filter(map_values(parser_results), lambda v: v='passed')),0)::int as passed, coalesce(cardinality(parser_results),0)::int as total, case when parser_results is null then false else coalesce(len(list_filter(map_values(parser_results), lambda v: v is null or v<>'passed'))=0, true) end as resolved from trials""")
def trial_tests(spark, d):
    """Tests passed and run of every trial, and whether it counts as resolved."""
    p, t = trials.tests_passed(F.col("parser_results"))
    return _trials(spark, d).select("trial_key", p.cast("int").alias("passed"), t.cast("int").alias("total"), trials.all_passed(F.col("parser_results")).alias("resolved"))


@query("""with x as (select task_id, len(list_filter(map_values(parser_results), lambda v: v='passed')) as p, cardinality(parser_results) as t from trials where cardinality(parser_results)>0) select task_id, round(avg(p::double/t),9) as mean_rate, count(*) as n from x group by task_id""")
def mean_test_rate(spark, d):
    """Mean over trials of their share of passed tests."""
    p, t = trials.tests_passed(F.col("parser_results"))
    x = _trials(spark, d).select("task_id", p.alias("p"), t.alias("t")).where("t > 0")
    return x.groupBy("task_id").agg(F.round(F.avg(F.col("p") / F.col("t")), 9).alias("mean_rate"), F.count("*").alias("n"))


def _stop_sql(decide: str) -> str:
    return f"""with o as (select task_id, row_number() over (partition by task_id order by trial_key) as n, coalesce(is_resolved,false)::int as r from trials), s as (select task_id, n, (sum(r) over (partition by task_id order by n))::int as p from o where n<=5),
 j as (select *, case {decide} end as d from s where n>=3), f as (select task_id, min(case when d is not null then n end) as hit, max(n) as lst from j group by task_id), a as (select distinct task_id from s)
 select a.task_id, coalesce(hit,lst)::int as decided_at, j.p as passes, j.d as decision from a left join f on a.task_id is not distinct from f.task_id left join j on j.task_id is not distinct from f.task_id and j.n=coalesce(hit,lst)"""


@query(_stop_sql("when p>=1 and p+5-n<=3 then 'learnable' when p>3 then 'too_easy' when p+5-n<1 then 'too_hard'"))
def early_stop_class(spark, d):
    """When each task's class was certain."""
    return trials.early_stop(_trials(spark, d), "task_id", ["trial_key"], F.col("is_resolved"))


@query(_stop_sql("when p>=3 then 'skip' when p+5-n<3 then 'proceed'"))
def early_stop_filter(spark, d):
    """When it was certain whether each task reaches three passes."""
    return trials.early_stop(_trials(spark, d), "task_id", ["trial_key"], F.col("is_resolved"), skip_at=3)


@query("""with t as (select result_id, stages.evaluation.tier_results as m from pipeline_results where stages.evaluation is not null)
 select result_id, case when coalesce(m['weak'].should_skip,false) then 'weak' when coalesce(m['middle'].should_skip,false) then 'middle' when coalesce(m['final'].should_skip,false) then 'final' end as filtered_at,
 case when coalesce(m['weak'].should_skip,false) then m['weak'].passes when coalesce(m['middle'].should_skip,false) then m['middle'].passes when coalesce(m['final'].should_skip,false) then m['final'].passes when m['final'] is not null then m['final'].passes when m['middle'] is not null then m['middle'].passes else m['weak'].passes end as passes,
 case when coalesce(m['weak'].should_skip,false) then m['weak'].total when coalesce(m['middle'].should_skip,false) then m['middle'].total when coalesce(m['final'].should_skip,false) then m['final'].total when m['final'] is not null then m['final'].total when m['middle'] is not null then m['middle'].total else m['weak'].total end as total from t""")
def tier_cascade(spark, d):
    """The tier that decided each evaluation."""
    r = _results(spark, d).where("stages.evaluation is not null")
    return trials.tier_cascade(r, "result_id", F.col("stages.evaluation.tier_results"), ["weak", "middle", "final"])


@query("""with m as (select task_id, source, n_chars//4 as n, coalesce(sum(n_chars//4) over (partition by task_id order by doc_id rows between unbounded preceding and 1 preceding),0) as b from documents)
 select task_id, coalesce(sum(b) filter (source='trial_transcript'),0)::bigint as input_tokens, coalesce(sum(n) filter (source='trial_transcript'),0)::bigint as output_tokens from m group by task_id""")
def conversation_tokens(spark, d):
    """Documents of a task as a conversation in which transcripts are the answers."""
    return trials.conversation_tokens(table(spark, d, "documents"), "task_id", "doc_id", F.coalesce(F.col("source") == "trial_transcript", F.lit(False)), F.floor(F.col("n_chars") / 4))


@query("select coalesce(category,'unknown') as category, count(*) as n from topic_entries group by 1")
def topic_counts(spark, d):
    return diversity.group_counts(table(spark, d, "topic_entries"), "category").orderBy(F.desc("n"), "category")


@query("""with c as (select count(*)::double as n from tasks group by category), t as (select sum(n) as t, count(*) as g from c) select any_value(g) as n_groups, round(case when any_value(g)<=1 then 0.0 else -sum(n/t*log2(n/t))/any_value(log2(g)) end, 9) as entropy from c, t""")
def category_entropy(spark, d):
    return diversity.entropy(table(spark, d, "tasks"), "category").withColumn("entropy", F.round("entropy", 9))


@query("""with f as (select distinct category as c from tasks), e as (select unnest([{}]) as c) select count(f.c)::double/count(*) as coverage, coalesce(string_agg(case when f.c is null then e.c end, ',' order by e.c),'') as missing from e left join f on e.c=f.c""".format(",".join(f"'{c}'" for c in [*fixed.CATEGORIES, "security"])))
def category_coverage(spark, d):
    """Share of the expected categories that occur, and those that don't."""
    return diversity.coverage(table(spark, d, "tasks"), "category", [*fixed.CATEGORIES, "security"])


@query("""select min(length(topic))::int as least, max(length(topic))::int as greatest, avg(length(topic)) as mean, list_extract(list_sort(list(length(topic)) filter (topic is not null)), count(topic)//2+1)::bigint as upper_median, median(length(topic)) as median, count(topic) as n from topic_entries""")
def topic_lengths(spark, d):
    return diversity.length_stats(table(spark, d, "topic_entries").select(F.length("topic").alias("x")), "x").withColumn("upper_median", F.col("upper_median").cast("long"))


_WORDS = "list_sort(list_distinct(regexp_extract_all(lower({0}),'[a-z]+')))"
_PAIRS = f"""select a.topic_id as topic_id_a, b.topic_id as topic_id_b, len(list_intersect(a.w,b.w))::double/(len(a.w)+len(b.w)-len(list_intersect(a.w,b.w))) as similarity from (select topic_id, {_WORDS.format('topic')} as w from topic_entries where topic is not null) a
 join (select topic_id, {_WORDS.format('topic')} as w from topic_entries where topic is not null) b on a.topic_id<b.topic_id and len(list_intersect(a.w,b.w))>=0.7*(len(a.w)+len(b.w)-len(list_intersect(a.w,b.w)))"""


@query(_PAIRS)
def topic_pairs(spark, d):
    """Pairs of topics with word similarity of 0.7 or more."""
    t = table(spark, d, "topic_entries").where("topic is not null").select("topic_id", S.letter_words(F.col("topic")).alias("w"))
    return diversity.prefix_pairs(t, "topic_id", "w", 0.7)


@query(f"with p as ({_PAIRS}), u as (select topic_id_a as t from p union select topic_id_b from p) select (select count(*) from topic_entries) - (select count(*) from p) as minus_pairs, (select count(*) from topic_entries) - (select count(*) from u) as minus_members")
def unique_topics(spark, d):
    """Both notions of the number of unique topics: less the pairs, and less the topics in any pair."""
    t = table(spark, d, "topic_entries")
    # the pairs are made once: every topic's number of pairs gives both counts, as each pair has two ends
    ends = topic_pairs(spark, d).select(F.explode(F.array("topic_id_a", "topic_id_b")).alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    found = ends.agg((F.coalesce(F.sum("n"), F.lit(0)) / -2).cast("long").alias("minus_pairs"), (-F.count("*")).alias("minus_members"))
    whole = t.agg(F.count("*").alias("minus_pairs"), F.count("*").alias("minus_members"))
    return whole.unionByName(found).agg(F.sum("minus_pairs").alias("minus_pairs"), F.sum("minus_members").alias("minus_members"))


_LANG = "case " + " ".join(f"when contains(lower(coalesce(topic,'')), '{w}') then '{v}'" for w, v in fixed.LANGUAGE_RULES) + " else 'unknown' end"


@query(f"select {_LANG} as language, count(*) as n from topic_entries group by 1")
def topic_languages(spark, d):
    return table(spark, d, "topic_entries").groupBy(S.topic_language(F.col("topic")).alias("language")).agg(F.count("*").alias("n"))


_TOK = "list_distinct(list_filter(regexp_split_to_array(instruction,'\\s+'), lambda x: x<>''))"


@query(f"""with n as (select task_key, instruction, {_TOK} as w from tasks where instruction is not null and registered_at>=timestamp '2025-06-01'), c as (select task_key, instruction, {_TOK} as w from tasks where instruction is not null and registered_at<timestamp '2025-06-01'),
 e as (select n.task_key as new_key, min(c.task_key) as old_key from n join c on n.instruction=c.instruction group by 1),
 s as (select n.task_key as new_key, c.task_key as old_key, len(list_intersect(n.w,c.w))::double/(len(n.w)+len(c.w)-len(list_intersect(n.w,c.w))) as s from n, c where n.task_key not in (select new_key from e))
 select new_key, old_key, 1.0::double as similarity, 'exact' as how from e union all select new_key, old_key, s, 'similar' from (select *, row_number() over (partition by new_key order by s desc, old_key) as rn from s where s>=0.7) where rn=1""")
def instruction_match(spark, d):
    """New instructions against the earlier corpus: exact copy first, else the most similar."""
    t = table(spark, d, "tasks").where("instruction is not null")
    cut = F.lit("2025-06-01").cast("timestamp_ntz")
    new = t.where(F.col("registered_at") >= cut).select(F.col("task_key").alias("new_key"), "instruction")
    old = t.where(F.col("registered_at") < cut).select(F.col("task_key").alias("old_key"), "instruction")
    return diversity.best_match(new, "new_key", old, "old_key", "instruction", S.blank_words, 0.7)


@query("select substr(sha256(text),1,16) as digest, min(doc_id) as kept, count(*) as n from documents where text is not null group by 1 having count(*)>1")
def exact_duplicates(spark, d):
    """Documents stored more than once."""
    return table(spark, d, "documents").where("text is not null").groupBy(F.substring(F.sha2("text", 256), 1, 16).alias("digest")).agg(F.min("doc_id").alias("kept"), F.count("*").alias("n")).where("n > 1")


_METRICS = ["total_input_tokens", "total_output_tokens"]
_UNP = "select trial_key, coalesce(is_resolved,false) as r, 'total_input_tokens' as metric, total_input_tokens::double as value from trials union all select trial_key, coalesce(is_resolved,false), 'total_output_tokens', total_output_tokens::double from trials"


@query(f"""with u as (select * from ({_UNP}) where value is not null), s as (select metric, r, count(*) as n, avg(value) as mean, median(value) as median from u group by all)
 select coalesce(a.metric,b.metric) as metric, a.n as a_n, a.mean as a_mean, a.median as a_median, b.n as b_n, b.mean as b_mean, b.median as b_median from (select * from s where r) a full join (select * from s where not r) b on a.metric=b.metric""")
def cohort_compare(spark, d):
    """Token statistics of resolved against unresolved trials."""
    t = _trials(spark, d).withColumn("r", F.coalesce("is_resolved", F.lit(False)))
    return quality.compare_cohorts(t.where("r"), t.where("not r"), "trial_key", _METRICS)


@query(f"""with u as (select * from ({_UNP}) where value is not null), s as (select metric, min(value) as lo, max(value) as hi from u where r group by metric)
 select trial_key, u.metric, value, lo, hi from u join s on u.metric=s.metric where not r and (value < lo-(case when hi=lo then 1.0 else hi-lo end)*0.05 or value > hi+(case when hi=lo then 1.0 else hi-lo end)*0.05)""")
def token_outliers(spark, d):
    """Unresolved trials outside the resolved ones' range."""
    t = _trials(spark, d).withColumn("r", F.coalesce("is_resolved", F.lit(False)))
    return quality.outliers(t.where("not r"), t.where("r"), "trial_key", _METRICS, 0.05)


_FLAGS = ["passed", "tests_fail_without_solution", "tests_pass_with_solution", "solution_idempotent", "image_builds"]


@query(" union all ".join(f"select '{f}' as flag, count(*) filter (coalesce({f},false)) as n_true, count(*) filter (coalesce({f},false))::double/count(*) as share from validation_attempts" for f in _FLAGS))
def attempt_flags(spark, d):
    return quality.true_shares(table(spark, d, "validation_attempts"), _FLAGS)


@query("""with s as (select doc_id, regexp_split_to_array(text, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]') as p, text from documents where text is not null)
 select doc_id, (len(p) - (case when p[len(p)]='' then 1 else 0 end))::int as lines, len(list_filter(p, lambda x: regexp_matches(x,'[^ \\t\\r\\n\\x0b\\f]')))::int as full_lines, len(regexp_extract_all(text,'(?m)^\\s*def\\s+test_'))::int as tests from s""")
def document_lines(spark, d):
    """Lines, non-blank lines and test definitions of every document."""
    t = F.col("text")
    return table(spark, d, "documents").where("text is not null").select("doc_id", S.line_count(t).cast("int").alias("lines"), S.code_lines(t).cast("int").alias("full_lines"), S.test_functions(t).cast("int").alias("tests"))


@query("""with c as (select author_name, category, count(*) as n from tasks where category is not null group by author_name, category) select author_name, category as mode, n from (select *, row_number() over (partition by author_name order by n desc, category) as rn from c) where rn=1""")
def author_modes(spark, d):
    """The most frequent category of every author."""
    return quality.modes(table(spark, d, "tasks"), ["author_name"], "category")


@query("select classification, count(*) as n, avg(retries) as avg_retries, avg(passes) as avg_passes from pipeline_results group by classification")
def class_patterns(spark, d):
    return quality.class_patterns(_results(spark, d), "classification", ["retries", "passes"])[0]


@query("""with x as (select classification, unnest(stages.functional.issues) as kind from pipeline_results), c as (select classification, kind, count(*) as n from x group by all) select classification, kind, n, n::double/sum(n) over (partition by classification) as share from c""")
def issue_distribution(spark, d):
    """Issues per class and their share."""
    return quality.class_patterns(_results(spark, d), "classification", ["retries"], "stages.functional.issues")[1]


@query("""with a as (select classification, avg(retries) as r, avg(passes) as p from pipeline_results group by 1), l as (select * from a where classification='learnable'), h as (select * from a where classification='too_easy')
 select 'avg_retries' as finding from l, h where h.r > l.r + 0.01 union all select 'avg_passes' from l, h where h.p > l.p * 1.3""")
def pattern_findings(spark, d):
    """Averages of too easy rows beyond those of learnable ones."""
    p = quality.class_patterns(_results(spark, d), "classification", ["retries", "passes"])[0]
    return quality.findings(p, "classification", "learnable", "too_easy", [("avg_retries", "plus", 0.01), ("avg_passes", "times", 1.3)])


_U = "(('0x'||substr(md5('7|'||{0}::varchar),1,12))::bigint::double+0.5)/281474976710656.0"
_DRAW = "-ln(" + _U.format("topic_id") + ")/(1+length(topic))"


@query(f"select topic_id from (select topic_id, {_DRAW} as dk from topic_entries where topic is not null) order by dk, topic_id limit 50")
def weighted_topics(spark, d):
    """Fifty topics drawn in proportion to a weight."""
    t = table(spark, d, "topic_entries").where("topic is not null").select("topic_id", "category", (1 + F.length("topic")).alias("w"))
    return sampling.weighted_sample(t, 50, "w", "topic_id", seed=7).select("topic_id")


@query(f"""select topic_id, category, pass_no from (select topic_id, category, {_U.format('category')} as s, row_number() over (partition by category order by {_DRAW}, topic_id)::int as pass_no from topic_entries where topic is not null and category is not null) order by pass_no, s, topic_id limit 40""")
def stratified_topics(spark, d):
    """Forty topics, one draw per category and pass."""
    t = table(spark, d, "topic_entries").where("topic is not null and category is not null").select("topic_id", "category", (1 + F.length("topic")).alias("w"))
    return sampling.stratified_round_robin(t, 40, "category", "w", "topic_id", seed=7).select("topic_id", "category", "pass_no")


@query("""select category, task_key from (select category, task_key, row_number() over (partition by category order by max_agent_timeout_sec desc nulls last, task_key) as rn from tasks) where rn=1""")
def top_per_category(spark, d):
    """The task with the longest limit per category."""
    t = table(spark, d, "tasks").select("category", "task_key", "max_agent_timeout_sec")
    return sampling.top_per_group(t, ["category"], F.col("max_agent_timeout_sec"), "task_key").select("category", "task_key")


@query()
def budget_selection(spark, d):
    """Greedy choice of tasks under a token budget: each category's best, then by score."""
    t = table(spark, d, "tasks").where("instruction is not null").select("task_key", F.coalesce("category", F.lit("unknown")).alias("category"), F.floor(F.octet_length("instruction") / 4).alias("tokens"))
    t = t.withColumn("score", sampling.example_score(F.lit(None).cast("double"), F.col("category") == "debugging", F.col("tokens")))
    return sampling.budgeted(t, 4000, "category", "score", "tokens", "task_key")


@query("select task_key, coalesce(estimated_duration_sec, (max_agent_timeout_sec+max_test_timeout_sec)/2, 210.0) as estimate from tasks")
def longest_first(spark, d):
    """Tasks by estimated duration, longest first."""
    return sampling.schedule(table(spark, d, "tasks"), "task_key", F.col("estimated_duration_sec"), F.col("max_agent_timeout_sec"), F.col("max_test_timeout_sec"))


@query("select category, difficulty, language, count(*) as n from topic_entries group by grouping sets ((category),(difficulty),(language))")
def bank_stats(spark, d):
    t = table(spark, d, "topic_entries")
    return t.groupingSets([["category"], ["difficulty"], ["language"]], "category", "difficulty", "language").agg(F.count("*").alias("n"))


@query("select coalesce(source,'unknown') as source, sum(octet_length(encode(text))//4)::bigint as approx_tokens from documents where text is not null group by 1")
def approx_tokens(spark, d):
    """A quarter of the bytes of every document, floored per document."""
    return table(spark, d, "documents").where("text is not null").groupBy(F.coalesce("source", F.lit("unknown")).alias("source")).agg(F.sum(F.floor(F.octet_length("text") / 4)).alias("approx_tokens"))


@query("""with s as (select topic, count(*) filter (coalesce(stages.functional.passed,false)) as ok, count(*) filter (not coalesce(stages.functional.passed,false) and contains(coalesce(status,''),'functional')) as bad, count(*) filter (classification in ('learnable','too_hard','too_easy')) as ev, count(*) filter (classification='learnable') as good from pipeline_results where topic is not null group by topic)
 select topic, case when ok+bad+ev<2 then 1.0 else greatest(0.05, case when (case when ok+bad>0 then ok::double/(ok+bad) else 0.5 end)>0 then (case when ok+bad>0 then ok::double/(ok+bad) else 0.5 end)*0.4+(case when ev>0 then good::double/ev else 0.0 end)*0.6 else 0.0 end) end as weight from s""")
def topic_weights(spark, d):
    """Sampling weights of topics from past outcomes."""
    r = _results(spark, d)
    old = r.where("topic is not null").select("topic").distinct().withColumn("old_weight", F.lit(1.0))
    return sampling.topic_weights(r, old, "topic")


_SLUG = "regexp_replace(regexp_replace(regexp_replace(replace(lower(topic),' ','-'),'[^a-z0-9-]','','g'),'-+','-','g'),'^-+|-+$','','g')"


@query(f"""with s as (select topic_id, {_SLUG} as f from topic_entries where topic is not null), h as (select *, substr(f,1,53) as p, 53-strpos(reverse(substr(f,1,53)),'-') as cut from s)
 select topic_id, case when length(f)<=60 then f else (case when strpos(p,'-')>0 and cut>=26 then substr(p,1,cut) else p end)||'-'||substr(sha256(f),1,6) end as slug from h""")
def slugs(spark, d):
    return table(spark, d, "topic_entries").where("topic is not null").select("topic_id", S.slug(F.col("topic")).alias("slug"))


_SIGNS = [f"regexp_matches(instruction, '{p}')" for p in fixed.INSTRUCTION_SIGNS]
_NW = "len(list_filter(regexp_split_to_array(instruction,'\\s+'), lambda x: x<>''))"


@query(f"""with x as (select task_key, {_NW}::int as words, length(instruction)::int as chars, {_SIGNS[0]} as names_files, {_SIGNS[1]} as names_functions, {_SIGNS[2]} as names_errors, {_SIGNS[3]} as states_behaviour from tasks where instruction is not null),
 y as (select *, names_files::int+names_functions::int+states_behaviour::int+(words>50)::int as s from x) select task_key, words, chars, names_files, names_functions, states_behaviour, names_errors, case when s<=1 then 'low' when s=2 then 'medium' else 'high' end as specificity from y""")
def instruction_features(spark, d):
    return table(spark, d, "tasks").where("instruction is not null").select("task_key", *S.instruction_features(F.col("instruction")))


@query("""select task_key, array_to_string(list_filter([case when instruction is null or trim(instruction)='' then 'missing instruction' end, case when difficulty is null or trim(difficulty)='' then 'missing difficulty' end, case when parser_name is null or trim(parser_name)='' then 'missing parser_name' end,
 case when difficulty not in ('easy','medium','hard') then 'invalid difficulty' end, case when length(trim(instruction))<50 then 'instruction shorter than 50' end], lambda x: x is not null), ';') as issues from tasks""")
def task_issues(spark, d):
    """Issues of every registered task."""
    return validate.task_rows(table(spark, d, "tasks"), "task_key").select("task_key", F.array_join("issues", ";").alias("issues"))


@query("""select attempt_id, coalesce(image_builds,false) and coalesce(tests_fail_without_solution,false) and coalesce(tests_pass_with_solution,false) and coalesce(solution_idempotent,true) as derived, coalesce(len(list_filter(issues, lambda x: regexp_matches(lower(x),'time ?out|time out|connection')))>0,false) as transient,
 coalesce(map_extract_value(execution_times,'test_without_solution'),0.0)>5 as slow from validation_attempts""")
def attempt_checks(spark, d):
    """Outcome derived from the checks, transient issues and slow phases of every attempt."""
    return table(spark, d, "validation_attempts").select(
        "attempt_id", validate.attempt_passed().alias("derived"), S.any_keyword(F.col("issues"), ["time ?out", "time out", "connection"]).alias("transient"),
        (F.coalesce(F.try_element_at("execution_times", F.lit("test_without_solution")), F.lit(0.0)) > 5).alias("slow"))


@query("select trial_key, date_diff('second', date_trunc('second', trial_started_at), date_trunc('second', trial_ended_at)) as seconds from trials where trial_started_at is not null and trial_ended_at is not null")
def trial_seconds(spark, d):
    """Whole seconds between the printed ISO forms of a trial's start and end."""
    iso = lambda c: F.date_format(F.col(c).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    return _trials(spark, d).where("trial_started_at is not null and trial_ended_at is not null").select("trial_key", S.seconds_between(iso("trial_started_at"), iso("trial_ended_at")).alias("seconds"))


@query(f"""select attempt_id, coalesce(regexp_matches(details.without_solution.stdout_tail, '(?i){'|'.join(f'(?:{p})' for p in fixed.FAILURE_SIGNS)}'), false) as failed from validation_attempts""")
def failure_signs(spark, d):
    """Attempts whose standard output without the solution tells of failed tests, as its SQL states; failure_signs_by_run reads all of the output."""
    return table(spark, d, "validation_attempts").select("attempt_id", S.signs_failure(F.col("details.without_solution.stdout_tail")).alias("failed"))


#: The tails an attempt keeps: the run and the stream.
_TAILS = [(r, s) for r in ("without_solution", "with_solution") for s in ("stdout", "stderr")]


def _failed_sql(run: str) -> str:
    signs = "|".join(f"(?:{p})" for p in fixed.FAILURE_SIGNS)
    return " or ".join(f"coalesce(regexp_matches(details.{r}.{s}_tail, '(?i){signs}'), false)" for r, s in _TAILS if r == run)


@query(f"""select attempt_id, failed_without, failed_with, failed_without or failed_with as failed from
 (select attempt_id, {_failed_sql("without_solution")} as failed_without, {_failed_sql("with_solution")} as failed_with from validation_attempts)""")
def failure_signs_by_run(spark, d):
    """Attempts whose output tells of failed tests: a flag for each run over both of its streams, and either run."""
    flag = lambda run: reduce(lambda a, b: a | b, [S.signs_failure(F.col(f"details.{r}.{s}_tail")) for r, s in _TAILS if r == run])
    got = table(spark, d, "validation_attempts").select("attempt_id", flag("without_solution").alias("failed_without"), flag("with_solution").alias("failed_with"))
    return got.withColumn("failed", F.col("failed_without") | F.col("failed_with"))


@query()
def test_logs(spark, d):
    """Results of the test logs held in the tails of validation attempts: both runs, both streams."""
    tails = F.array(*[F.struct(F.lit(r).alias("run"), F.lit(s).alias("stream_name"), F.col(f"details.{r}.{s}_tail").alias("log")) for r, s in _TAILS])
    rows = table(spark, d, "validation_attempts").select("attempt_id", F.inline(tails))
    return rows.select("attempt_id", "run", "stream_name", F.explode(S.test_log_results(F.col("log"))).alias("test", "status"))


@query()
def instruction_revisions(spark, d):
    """Change regions, sentence by sentence, between a new instruction and the earlier one it copies."""
    t = table(spark, d, "tasks").select("task_key", F.regexp_replace("instruction", r"\. ", ".\n").alias("text"))
    pairs = cut_lineage(instruction_match(spark, d).where("how = 'similar'").select("new_key", "old_key"))
    t = diversity.listed(t, "task_key", pairs, ["new_key", "old_key"])
    both = pairs.join(t.select(F.col("task_key").alias("new_key"), F.col("text").alias("after")), "new_key").join(t.select(F.col("task_key").alias("old_key"), F.col("text").alias("before")), "old_key")
    return codefeatures.diff_rows(both, ["new_key", "old_key"], "before", "after")


@query(ORACLES["latest_status"])
def stream_latest_status(spark, d):
    """The same as latest_status, kept by a stream that upserts micro-batches."""
    import uuid

    from grainmill.session import ensure_checkpoint_dir
    from grainmill.sources.sinks import read_latest
    from grainmill.streaming.live import stream_parquet, upsert_status

    at = f"{ensure_checkpoint_dir(spark).rstrip('/')}/status-{uuid.uuid4().hex}"
    path = f"{d}/task_status.parquet"
    # a pattern, as a plain path would have to be a directory
    s = stream_parquet(spark, path[:-1] + "[t]", spark.read.parquet(path)).select("task_dir", "stage", "classification", "pass_rate", "received_at", "status_id")
    upsert_status(s, f"{at}/table", ["task_dir"], ["received_at", "status_id"], f"{at}/log").awaitTermination()
    return read_latest(spark, f"{at}/table").drop("received_at")
