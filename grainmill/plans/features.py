"""Queries of scalar functions, code features, validation and summaries over the given tables, each with its SQL.

Task folders are built from the table of tasks by rule, so that SQL knows what they hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.functions import fixed
from grainmill.functions import scalars as S
from grainmill.operators import codefeatures, diversity, merge, metrics, sampling, trials, validate
from grainmill.operators.nested import unnest_reports
from grainmill.operators.quality import position_gaps, task_quality
from grainmill.plans import general, inventory
from grainmill.session import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def _key() -> Column:
    return F.col("task_key")


def _script(lines: list) -> Column:
    return F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in lines])


def _folders(spark: SparkSession, d: str) -> DataFrame:
    """task_key, path, content: a folder per task. Every seventh has no solution, every fifth solution writes a file that isn't there."""
    t = table(spark, d, "tasks").select("task_key", F.coalesce("instruction", F.lit("")).alias("instruction"))
    functions = F.expr("repeat('def f():\\n    return 1\\n', cast(task_key % 3 as int))")
    source = lambda n: _script([f"import os\nimport sys\nLIMIT = {n}\n", functions])
    more = F.when(_key() % 5 == 0, 'echo "x" > /etc/extra.py\n').otherwise("")
    files = {
        "main.py": source(10),
        "solution.sh": F.when(_key() % 7 != 0, _script(["cat > /app/main.py << 'EOF'\n", source(11), "EOF\n", more])),
        "tests/test_a.py": F.expr("repeat('def test_case_one():\\n    assert 1 == 1\\n', cast(task_key % 4 as int))"),
        "Dockerfile": F.when(_key() % 6 == 0, "RUN x\n").otherwise("FROM x\nRUN y\nWORKDIR /app\n"),
        "run-tests.sh": F.lit("python -m pytest tests\n"),
        "task.yaml": F.when(_key() % 11 != 0, F.col("instruction")),
    }
    rows = F.array(*[F.struct(F.lit(p).alias("path"), c.alias("content")) for p, c in files.items()])
    return t.select("task_key", F.inline(rows)).where("content is not null")


_LOC = "(3+2*(task_key%3))"


@query(f"""select task_key, case when task_key%7<>0 then 1 end as files_changed, case when task_key%7<>0 then 1 end as n_hunks, case when task_key%7<>0 then 2 end as lines_changed,
 case when task_key%7<>0 then {_LOC} end as source_loc, case when task_key%7=0 then 'no solution script' when task_key%5=0 then 'not found: extra.py;single region' else 'single region' end as warnings from tasks""")
def solution_diffs(spark, d):
    """What each task's solution changes, with warnings."""
    got = codefeatures.task_diffs(_folders(spark, d), "task_key", "path", "content")
    return got.select("task_key", "files_changed", "n_hunks", "lines_changed", "source_loc", F.array_join("warnings", ";").alias("warnings"))


@query("select task_key, 'main.py' as file, 3 as position, 'off_by_one' as kind, 'LIMIT = 10' as removed, 'LIMIT = 11' as added from tasks where task_key%7<>0")
def solution_hunks(spark, d):
    """The change regions of every solution, with their kind."""
    got = codefeatures.solution_changes(_folders(spark, d), "task_key", "path", "content")
    return got.select("task_key", "file", "position", "kind", F.array_join("removed", "\n").alias("removed"), F.array_join("added", "\n").alias("added"))


@query("select task_key, (task_key%4)::int as n_tests, 0 as n_docstrings, (task_key%4)::int as n_descriptive, (task_key%4)::int as n_assertions, false as uses_subprocess from tasks")
def test_module_features(spark, d):
    """Structure of the test modules of every task."""
    files = _folders(spark, d).where("path like 'tests/%.py'")
    return codefeatures.test_features(files, ["task_key"], "content").drop("kinds")


@query(f"select task_key, 'python' as language, {_LOC}::int as loc, (task_key%3)::int as n_functions, 0 as n_classes, 2 as n_imports, 0 as depth from tasks")
def source_module_features(spark, d):
    """Structure of the source files of every task."""
    return codefeatures.source_features(_folders(spark, d).where("path = 'main.py'"), ["task_key"], "path", "content")


@query(f"""select task_key, case when task_key%7<>0 then 1 end as files_changed, case when task_key%7<>0 then 1 else 0 end as n_changes, case when task_key%7<>0 then 'off_by_one' end as kinds, (task_key%4)::int as n_tests,
 {_LOC}::int as loc, (task_key%3)::int as n_functions, 0 as max_gap, len(list_filter(regexp_split_to_array(instruction,'\\s+'), lambda x: x<>''))::int as words from tasks""")
def task_features(spark, d):
    """The full feature row of every task: changes, kinds, places, tests, source and instruction."""
    got = codefeatures.full_features(table(spark, d, "tasks"), _folders(spark, d), "task_key", "path", "content", "instruction")
    return got.select("task_key", "files_changed", "n_changes", F.array_join(F.map_keys("change_kinds"), ";").alias("kinds"), "n_tests", "loc", "n_functions", "max_gap", "words")


@query("""select task_key, 5 + (task_key%7<>0)::int - (task_key%11=0)::int as n_files, case when task_key%6=0 then 1 else 3 end as dockerfile_lines, case when task_key%7<>0 then 5+2*(task_key%3)+(task_key%5=0)::int end as solution_lines,
 (task_key%4)::bigint as n_tests, (2*(task_key%4))::bigint as test_lines, false as has_compose from tasks""")
def folder_quality(spark, d):
    """Structural features of every task folder."""
    got = task_quality(_folders(spark, d), "task_key", "path", "content")
    return got.select("task_key", "n_files", "dockerfile_lines", "solution_lines", "n_tests", "test_lines", "has_compose")


@query("""select task_key, array_to_string(list_filter([case when task_key%11=0 then 'missing file task.yaml' end, case when task_key%6=0 then 'Dockerfile has no FROM' end,
 case when task_key%7<>0 and task_key%5=0 and task_key%6<>0 then 'writes outside the work directory' when task_key%7<>0 and task_key%5=0 then 'writes outside the work directory' end], lambda x: x is not null), ';') as issues from tasks""")
def folder_issues(spark, d):
    """Issues of every task folder: files, container file, scripts and paths."""
    return validate.task_files(_folders(spark, d), "task_key", "path", "content").select("task_key", F.array_join("issues", ";").alias("issues"))


@query("""select task_key, 'main.py' as file, length('import os'||chr(10)||'import sys'||chr(10)||'LIMIT = 11'||chr(10))+(task_key%3)*length('def f():'||chr(10)||'    return 1'||chr(10)) as n from tasks where task_key%7<>0
 union all select task_key, 'extra.py', 2 from tasks where task_key%7<>0 and task_key%5=0""")
def script_writes(spark, d):
    """Files that the solution scripts write, with the length of what they write."""
    scripts = _folders(spark, d).where("path = 'solution.sh'")
    return codefeatures.exploding(scripts, ["task_key"], ["content"], codefeatures.script_files, "file string, text string").select("task_key", "file", F.length("text").cast("long").alias("n"))


@query("""select task_key, case when task_key%6=0 then '/app' else '/app' end as root, case when task_key%5=0 then '/etc/extra.py' else '' end as outside, case when task_key%5=0 then 2 else 1 end as n_written from tasks where task_key%7<>0""")
def script_paths(spark, d):
    """Work directory of every container file and the paths that the solution writes outside it."""
    files = _folders(spark, d).groupBy("task_key").agg(*[F.max(F.when(F.col("path") == p, F.col("content"))).alias(a) for p, a in (("Dockerfile", "docker"), ("solution.sh", "script"))])
    root = S.work_dir(F.col("docker"))
    outside = S.written_outside(F.col("script"), root)
    return files.where("script is not null").select("task_key", root.alias("root"), F.array_join(outside, ";").alias("outside"), F.size(S.written_paths(F.col("script"))).alias("n_written"))


@query("select task_key, 'FROM x'||chr(10)||'WORKDIR /app'||chr(10) as kept from tasks where task_key%6<>0")
def stripped_containers(spark, d):
    """Container files without the commands that install things, continuation lines included."""
    files = _folders(spark, d).where("path = 'Dockerfile' and content like 'FROM%'").select("task_key", F.replace("content", F.lit("RUN y"), F.lit("RUN apt-get \\\n  y")).alias("kept"))
    return codefeatures.strip_commands(files, "kept", ["RUN apt-get"])


@query("select task_id as key, substr(sha256(string_agg(doc_id::varchar||chr(0)||sha256(text), chr(10) order by doc_id::varchar)),1,16) as digest from documents where text is not null and task_id is not null group by task_id")
def content_digests(spark, d):
    """One digest over the documents of a task in the order of their names."""
    docs = table(spark, d, "documents").where("text is not null and task_id is not null").select(F.col("task_id").alias("key"), F.col("doc_id").cast("string").alias("path"), "text")
    return diversity.content_digest(docs, "key", "path", "text")


@query("select author_name as author, md5(string_agg('**'||task_key::varchar||'**'||chr(10)||instruction, chr(10) order by task_key::varchar)) as text_md5 from tasks where author_name is not null and instruction is not null group by author_name")
def ordered_texts(spark, d):
    """Instructions of an author under their keys, in order, as one text (its digest)."""
    t = table(spark, d, "tasks").where("author_name is not null and instruction is not null").select(F.col("author_name").alias("author"), F.col("task_key").cast("string").alias("path"), "instruction")
    return diversity.ordered_text(t, "author", "path", "instruction").select("author", F.md5("text").alias("text_md5"))


_EXT = [".py", ".c", ".GO", ".js", ".sh", ".txt", "", ".rs"]
_EXT_SQL = "['python','c','go','javascript','bash','unknown','unknown','rust']"


@query(f"select task_key, {_EXT_SQL}[(task_key%8)::int+1] as language from tasks where task_id is not null")
def file_languages(spark, d):
    """Language by the extension of a file name."""
    name = F.concat("task_id", F.lit("/main"), F.element_at(F.array(*[F.lit(x) for x in _EXT]), (_key() % 8 + 1).cast("int")))
    return table(spark, d, "tasks").where("task_id is not null").select("task_key", S.file_language(name).alias("language"))


_LANG = "case " + " ".join(f"when contains(lower(topic), '{w}') then '{v}'" for w, v in fixed.LANGUAGE_RULES if w != "typescript") + " else 'other' end"


@query(f"""with b as (select topic, min(language) as language from topic_entries where topic is not null and language is not null and topic_id%2=0 group by topic)
 select t.topic_id, coalesce(b.language, case when t.topic is null then 'other' else {_LANG.replace('topic', 't.topic')} end) as language from topic_entries t left join b on b.topic=t.topic""")
def known_languages(spark, d):
    """Language of a topic: looked up in a table of known topics first, else by keyword."""
    t = table(spark, d, "topic_entries").select("topic_id", "topic", "language")
    known = t.where("topic is not null and language is not null and topic_id % 2 = 0").groupBy("topic").agg(F.min("language").alias("known"))
    return t.drop("language").join(known, "topic", "left").select("topic_id", S.known_or_topic_language(F.col("known"), F.col("topic")).alias("language"))


@query("""select report_id, json_valid(regexp_extract(report_json, '\\{.*\\}', 0, 's')) as readable from batch_reports where report_json is not null and report_json like '{%' and report_json like '%}'""")
def fenced_replies(spark, d):
    """Whether the outermost braces of a fenced reply hold JSON."""
    r = table(spark, d, "batch_reports").where("report_json is not null and report_json like '{%' and report_json like '%}'")
    reply = F.concat(F.lit("Here it is:\n```json\n"), "report_json", F.lit("\n```\nDone."))
    return r.select("report_id", S.fenced_json(reply).isNotNull().alias("readable"))


@query("""with n as (select task_key, instruction as x, ((length(instruction)-length(replace(instruction,'the','')))//3)::int as n from tasks where instruction is not null)
 select task_key, n as n_matches, case when n=1 then replace(x,'the','a') end as text from n""")
def exact_replacements(spark, d):
    """A word replaced in the instructions that hold it exactly once."""
    got = table(spark, d, "tasks").where("instruction is not null").select("task_key", S.replace_once(F.col("instruction"), F.lit("the"), F.lit("a")).alias("r"))
    return got.select("task_key", "r.n_matches", "r.text")


_DUR = "floor(greatest(coalesce(duration_sec,0),0))::bigint"


@query(f"""select result_id, case when coalesce(total,0)=0 then '- %' else printf('%.1f%%', 100.0*coalesce(passes,0)/total) end as percent, case when {{0}} < 60 then {{0}}||'s' when {{0}} < 3600 then ({{0}}//60)||'m '||lpad(({{0}}%60)::varchar,2,'0')||'s'
 else ({{0}}//3600)||'h '||lpad((({{0}}%3600)//60)::varchar,2,'0')||'m' end as took, case when pass_rate is null then '-' when abs(pass_rate)<0.01 then printf('$%.4f', pass_rate) else printf('$%.2f', pass_rate) end as money,
 round_even(passes::double/nullif(total,0),4) as rate, case when passes>0 then passes else total end as reported, right(status,5) as status_end, 5.0*power(2.0,coalesce(retries,0)) as delay, ceil(total::double/greatest(least(total,4),1))*900 as limit_sec from pipeline_results""".replace("{0}", _DUR))
def printed_scalars(spark, d):
    """Percentages, durations, money, rates, reported counts, tails, delays and wave limits of every result."""
    c = F.col
    return inventory._results(spark, d).select(
        "result_id", S.percent_text(F.coalesce("passes", F.lit(0)), c("total")).alias("percent"), S.duration_text(F.greatest(F.floor(F.coalesce("duration_sec", F.lit(0))), F.lit(0))).alias("took"), S.money_text(c("pass_rate")).alias("money"),
        S.pass_rate(c("passes"), c("total")).alias("rate"), S.reported_or(c("passes"), c("total")).alias("reported"), S.tail(c("status"), 5).alias("status_end"),
        S.retry_delay(F.coalesce("retries", F.lit(0))).alias("delay"), S.wave_timeout(c("total"), F.lit(900)).cast("double").alias("limit_sec"),
    )


@query("""select task_key, epoch_us(date_trunc('second', registered_at))//1000000 as epoch, case when registered_at is not null then registered_at < timestamp '2025-06-01' - interval 1200 seconds else false end as stale,
 concat_ws(chr(10)||chr(10), case when instruction is not null then 'Task: '||right(instruction,1500) end, case when difficulty='hard' then 'Level: '||difficulty end) as feedback from tasks""")
def batch_feedback(spark, d):
    """Epoch of a batch's id, whether it is stale, and feedback put together from the sections that apply."""
    at = F.col("registered_at").cast("timestamp")
    parts = [(F.col("instruction").isNotNull(), "Task: ", S.tail(F.col("instruction"), 1500)), (F.col("difficulty") == "hard", "Level: ", F.col("difficulty"))]
    return table(spark, d, "tasks").select(
        "task_key", S.batch_epoch(F.date_format(at, "yyyyMMdd-HHmmss")).alias("epoch"), S.older_than(at, F.lit("2025-06-01").cast("timestamp")).alias("stale"), S.sectioned(parts).alias("feedback")
    )


@query("""select trial_key, 'BIGINT' as kind_tokens, 'STRING' as kind_name, case when is_resolved is null then null else 'BOOLEAN' end as kind_flag from trials where total_input_tokens is not null and trial_name is not null""")
def inferred_types(spark, d):
    """The type that a printed value denotes."""
    t = table(spark, d, "trials").where("total_input_tokens is not null and trial_name is not null")
    kind = lambda c: F.when(F.col(c).isNotNull(), S.inferred_type(F.col(c).cast("string")))
    return t.select("trial_key", kind("total_input_tokens").alias("kind_tokens"), kind("trial_name").alias("kind_name"), kind("is_resolved").alias("kind_flag"))


@query("""select result_id, f.passed as stated, coalesce(f.image_builds,false) and coalesce(f.tests_fail_without_solution,false) and coalesce(f.tests_pass_with_solution,false) as plain,
 coalesce(f.image_builds,false) and coalesce(f.tests_fail_without_solution,false) and coalesce(f.tests_pass_with_solution,false) and coalesce(f.solution_idempotent,false) and coalesce(f.tests_deterministic,false) as extended,
 coalesce(f.image_size_mb>2048,false) as too_large, coalesce(f.image_size_mb>1024 and f.image_size_mb<=2048,false) as large from (select result_id, stages.functional as f from pipeline_results where stages.functional is not null)""")
def functional_checks(spark, d):
    """Outcome of functional validations, plain and extended, and their size findings."""
    r = inventory._results(spark, d).where("stages.functional is not null").select("result_id", "stages.functional.*")
    none = F.lit(None).cast("boolean")
    three = F.col("image_builds"), F.col("tests_fail_without_solution"), F.col("tests_pass_with_solution")
    bad, warn = validate.size_findings(F.col("image_size_mb"), F.lit(None).cast("double"))
    return r.select(
        "result_id", F.col("passed").alias("stated"), validate.functional_passed(*three, none).alias("plain"),
        validate.functional_passed(*three, none, F.col("solution_idempotent"), F.col("tests_deterministic")).alias("extended"), (F.size(bad) > 0).alias("too_large"), (F.size(warn) > 0).alias("large"),
    )


@query("""select attempt_id, coalesce(image_builds,false) and (coalesce(tests_fail_without_solution,false) or coalesce(details.without_solution.timed_out,false)) and coalesce(tests_pass_with_solution,false) as passed, coalesce(map_extract_value(execution_times,'test_without_solution')>60,false) as slow from validation_attempts""")
def attempt_outcomes(spark, d):
    """Outcome of every attempt, where running out of time without the solution counts as failing, and slow test phases."""
    c = F.col
    slow = validate.size_findings(F.lit(None).cast("double"), F.try_element_at("execution_times", F.lit("test_without_solution")))[1]
    ok = validate.functional_passed(c("image_builds"), c("tests_fail_without_solution"), c("tests_pass_with_solution"), c("details.without_solution.timed_out"))
    return table(spark, d, "validation_attempts").select("attempt_id", ok.alias("passed"), (F.size(slow) > 0).alias("slow"))


@query("select task_dir, count(*) filter (coalesce(passed,false))=3 as deterministic from validation_attempts group by task_dir")
def deterministic_tasks(spark, d):
    """Whether three attempts of a task passed."""
    return validate.deterministic(table(spark, d, "validation_attempts").withColumn("passed", F.coalesce("passed", F.lit(False))), "task_dir", "passed")


@query("""select trial_key, case when parser_results is null and coalesce(failure_mode,'unset')='unset' then 'parse_error' when coalesce(failure_mode,'unset')<>'unset' then failure_mode else 'unset' end as settled,
 case failure_mode when 'agent_timeout' then 'timeout' when 'test_timeout' then 'timeout' else 'unknown_agent_error' end as group_of from trials""")
def settled_failures(spark, d):
    """One failure mode per trial and the group it belongs to, by a given table."""
    t, mode = table(spark, d, "trials"), F.col("failure_mode")
    lost = F.col("parser_results").isNull() & (F.coalesce(mode, F.lit("unset")) == "unset")
    known = {"agent_timeout": "timeout", "test_timeout": "timeout"}
    return t.select("trial_key", trials.settle_failure(mode, F.lit(None).cast("string"), lost).alias("settled"), trials.failure_of(F.coalesce(mode, F.lit("")), known).alias("group_of"))


@query("""select task_id, count(*) filter (coalesce(is_resolved,false)) as passes, case when count(*) filter (coalesce(is_resolved,false)) between 1 and 3 then 'learnable' when count(*) filter (coalesce(is_resolved,false))>3 then 'too_easy' else 'too_hard' end as label from trials group by task_id""")
def final_classes(spark, d):
    """The class of every task over all of its trials."""
    per = table(spark, d, "trials").groupBy("task_id").agg(F.count_if(F.coalesce("is_resolved", F.lit(False))).alias("passes"))
    return per.select("task_id", "passes", trials.final_class(F.col("passes")).alias("label"))


@query("""with o as (select task_id, row_number() over (partition by task_id order by trial_key) as n, coalesce(is_resolved,false)::int as r from trials), s as (select task_id, n, (1+sum(r) over (partition by task_id order by n))::int as p from o where n<=3),
 j as (select *, case when p>=1 and p+3-n<=3 then 'learnable' when p>3 then 'too_easy' when p+3-n<1 then 'too_hard' end as d from s where n+2>=3), f as (select task_id, min(case when d is not null then n end) as hit, max(n) as lst from j group by task_id)
 select f.task_id, (coalesce(hit,lst)+2)::int as decided_at, j.p as passes, j.d as decision from f join j on j.task_id is not distinct from f.task_id and j.n=coalesce(hit,lst)""")
def resumed_early_stop(spark, d):
    """When each task's class was certain if an interrupted run had left one pass in two trials."""
    return trials.early_stop(table(spark, d, "trials"), "task_id", ["trial_key"], F.col("is_resolved"), prior=(1, 2))


@query("select run_id, trial_key, case when coalesce(is_resolved,false) then 'resolved' else 'unresolved' end as outcome from trials")
def run_outcomes(spark, d):
    """The resolved and unresolved trials of every run, as rows rather than lists."""
    return trials.run_outcomes(table(spark, d, "trials"), "run_id", "trial_key", F.col("is_resolved"))


_USAGE = inventory.ORACLES["usage_by_batch"]
_COST = "coalesce(u.cost_units,0)"


@query(f"""with u as ({_USAGE}), c as (select batch, count(*) as total, count(*) filter (classification='learnable') as learnable, count(*) filter (stages.functional is not null) as functional_tested, coalesce(sum(round(duration_sec*10)::bigint),0) as ds from pipeline_results group by batch),
 e as (select batch, string_agg(category||'='||n, ';' order by category) as errors from ({inventory.ORACLES['error_taxonomy']}) group by batch)
 select c.batch, total, learnable, functional_tested, round_even(ds/600.0,1)::double as duration_min, coalesce(errors,'') as errors, {_COST} as cost_units, coalesce({_COST}::double/nullif(learnable,0),0.0) as cost_per_learnable from c left join u using (batch) left join e using (batch)""")
def batch_summaries(spark, d):
    """The whole report row of every batch: counts, errors, cost, durations."""
    r = inventory._results(spark, d)
    got = metrics.batch_summary(r, inventory.usage_by_batch(spark, d), "batch")
    errors = F.array_join(F.transform(F.map_entries("errors"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    return got.select("batch", "total", "learnable", "functional_tested", "duration_min", errors.alias("errors"), "cost_units", "cost_per_learnable")


@query(f"""with u as ({_USAGE}), c as (select batch, count(*) as total, count(*) filter (classification='learnable') as learnable from pipeline_results group by batch)
 select c.batch, learnable, round_even(100.0*learnable/total,1)::double as yield_pct, {_COST} as cost_units, coalesce(round_even({_COST}::double/nullif(learnable,0),2),0.0) as cost_per_learnable from c left join u using (batch)""")
def batch_trends(spark, d):
    """Yield and cost of every batch."""
    return metrics.batch_trend(inventory._results(spark, d), inventory.usage_by_batch(spark, d), "batch")


@query("""with f as (select batch, count(*) as total, count(*) filter (classification='learnable') as l, count(*) filter (classification<>'') as ev from pipeline_results group by batch)
 select batch, round_even(l::double/total,4)::double as learnable_yield, coalesce(round_even(l::double/nullif(ev,0),4)::double,0.0) as learnable_rate from f""")
def printed_rates(spark, d):
    """Rates of every batch as a report prints them, with four decimals."""
    got = metrics.with_rates(inventory._results(spark, d).groupBy("batch").agg(*metrics.funnel_aggregates()), places=4)
    return got.select("batch", "learnable_yield", "learnable_rate")


@query(f"select topic, case when weight=1.0 then 1.0 else greatest(0.05, round_even(weight,2)::double) end as weight from ({inventory.ORACLES['topic_weights']})")
def printed_weights(spark, d):
    """Sampling weights with the two decimals in which they are written back."""
    r = inventory._results(spark, d)
    old = r.where("topic is not null").select("topic").distinct().withColumn("old_weight", F.lit(1.0))
    return sampling.topic_weights(r, old, "topic", places=2)


@query("""select count(*) as total, count(*) filter (stage in ('completed','failed')) as done, count(*) filter (stage in ('generating','structural','functional','evaluating')) as running, count(*) filter (stage='failed') as failed,
 count(*) filter (classification='learnable') as learnable, count(*) filter (classification='too_easy') as too_easy, count(*) filter (classification='too_hard') as too_hard, coalesce(sum(coalesce(pass_rate,0))/nullif(count(*) filter (classification='learnable'),0),0.0) as cost_per_learnable from task_status""")
def header_counts(spark, d):
    """Counts of all status documents in one pass."""
    return metrics.header_counts(table(spark, d, "task_status"), F.col("stage"), F.coalesce("pass_rate", F.lit(0.0)))


_IN, _OUT = (f"coalesce(try_cast(json_extract_string(q,'$.{k}_tokens') as bigint),0)" for k in ("input", "output"))


@query(f"""with {general._REPORTS}, m as (select tl.*, json_extract_string(tt.t,'$.model') as model from tl join tt using (report_id, result_no, tier))
 select report_id, sum({_IN})::bigint as input_tokens, sum({_OUT})::bigint as output_tokens, sum(case when model like 'eval-model-%' then {_IN}*2+{_OUT}*7 else 0 end)::bigint as cost_units from m group by report_id""")
def evaluation_costs(spark, d):
    """Tokens of the trials of all tiers of a report, weighted by a given table of rates per model."""
    t = unnest_reports(table(spark, d, "batch_reports"), "report_id", "report_json")
    rates = t["tiers"].where("model like 'eval-model-%'").select("model").distinct().select("model", F.lit(2).alias("input_rate"), F.lit(7).alias("output_rate"))
    return metrics.evaluation_usage(t["trials"], t["tiers"], rates, ["report_id", "result_no", "tier"], ["report_id"])


#: The greedy choice row by row.
ORACLES["budget_selection"] = """with recursive t as (select task_key, coalesce(category,'unknown') as g, (octet_length(encode(instruction))//4)::bigint as z from tasks where instruction is not null),
 s as (select *, greatest(0.0, 1.0)+(case when g='debugging' then 0.5 else 0.0 end)+greatest(0.0,(8000-z)/8000.0)*0.3 as sc from t where z between 1 and 4000),
 b as (select g, arg_min(task_key, {{k}}) as best from (select *, row_number() over (partition by g order by sc desc, task_key) as rk from s) group by g), o as (select s.task_key, z, row_number() over (order by s.task_key<>best, case when s.task_key=best then s.g end, sc desc, s.task_key) as n from s join b on s.g=b.g),
 w(n, spent, took) as (select 0::bigint, 0::bigint, null::bigint union all select o.n, case when spent+z<=4000 then spent+z else spent end, case when spent+z<=4000 then o.task_key end from w join o on o.n=w.n+1) select took as task_key from w where took is not null""".replace("{{k}}", "rk")


@query("""with c as (select task_key, coalesce(category,'unknown') as g, 100::bigint as z from tasks), s as (select task_key from (select *, row_number() over (partition by g order by task_key) as rn from c) where rn=1)
 select task_key, false as negative from s union all select min(task_key), true from tasks where instruction is null having count(*)>0 and (select 100*count(*) from s)+2000<=(select 100*count(*)+2000 from s)""")
def negative_choice(spark, d):
    """One task per category and, within the budget left, the first one without an instruction as a negative example."""
    t = table(spark, d, "tasks").select("task_key", F.coalesce("category", F.lit("unknown")).alias("g"), F.lit(100).cast("long").alias("z"), "instruction")
    chosen = t.groupBy("g").agg(F.min("task_key").alias("task_key")).select("task_key")
    bad = t.where("instruction is null").select("task_key", F.lit(None).cast("long").alias("z"))
    n = chosen.count()  # one per category
    return sampling.with_negative(t, chosen, bad, 100 * n + 2000, "z", "task_key")


@query("select task_key, coalesce(list_max(list_transform(range(1,len(p)), lambda i: p[i+1]-p[i])),0)::bigint as max_gap, case when len(p)<2 then 0.0 else (p[len(p)]-p[1])::double/(len(p)-1) end as avg_gap, case when len(p)<2 then 0.0 else round_even((p[len(p)]-p[1])/100.0,2)::double end as spread from (select task_key, list_sort([task_key%7, task_key%13, task_key%29][1:(task_key%4)::int]) as p from tasks)")
def gap_features(spark, d):
    """Gaps between positions and their span."""
    p = F.slice(F.array(_key() % 7, _key() % 13, _key() % 29), F.lit(1), F.least(_key() % 4, F.lit(3)).cast("int"))
    got = position_gaps(table(spark, d, "tasks").select("task_key", p.alias("p")), "task_key", "p", F.lit(100))
    return got.select("task_key", F.col("max_gap").cast("long").alias("max_gap"), "avg_gap", F.bround("spread", 2).alias("spread"))


@query("""select task_key, f.file, (select min(path) from (select 'main.py' as path) m where m.path=f.file) as path from tasks, (select unnest(['main.py','none.py','test_a.py']) as file) f""")
def source_of_files(spark, d):
    """The shallowest source file of every wanted name, tests left out."""
    wanted = table(spark, d, "tasks").select("task_key", F.explode(F.array(F.lit("main.py"), F.lit("none.py"), F.lit("test_a.py"))).alias("file"))
    return merge.basename_match(wanted, ["task_key"], "file", _folders(spark, d).select("task_key", "path"), "path")


@query("""select t.task_key, t.task_id, case when t.difficulty='hard' and u.d is not null then u.d else t.category end as category from tasks t left join (select task_id, min(difficulty) as d from tasks where task_key%2=0 and difficulty is not null group by task_id) u on u.task_id=t.task_id""")
def overlaid_tasks(spark, d):
    """Values of a patch laid over a table where the key is known and a rule allows it."""
    t = table(spark, d, "tasks").select("task_key", "task_id", "category", "difficulty")
    patch = t.where("task_key % 2 = 0 and difficulty is not null").groupBy("task_id").agg(F.min("difficulty").alias("category"))
    return merge.overlay(t, patch, ["task_id"], "category", F.coalesce(F.col("difficulty") == "hard", F.lit(False))).select("task_key", "task_id", "category")


def _log_sql() -> str:
    tails = " union all ".join(f"select attempt_id, '{r}' as run, '{s}' as stream_name, details.{r}.{s}_tail as x from validation_attempts" for r, s in inventory._TAILS)
    head = r"(?is)=+\s*short test summary info\s*=+(.*)"
    passing, failing = (", ".join(repr(x) for x in v) for v in (fixed.PASSING, fixed.FAILING))
    return f"""with t as ({tails}), b as (select attempt_id, run, stream_name, regexp_extract(x, '{head}', 1) as body from t where regexp_matches(x, '{head}')),
 l as (select attempt_id, run, stream_name, unnest(regexp_split_to_array(body, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]')) as x, generate_subscripts(regexp_split_to_array(body, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]'), 1) as no from b),
 c as (select *, case when starts_with(x,'FAILED') and contains(x,' - ') then substr(x, 1, length(x)-strpos(reverse(x),' - ')-2) else x end as cut from l),
 n as (select *, regexp_extract(cut, '^\\s*([A-Z]+):*\\s+\\S', 1) as word, trim(regexp_extract(cut, '^\\s*\\S+\\s+(.*?)\\s*$', 1)) as name from c),
 p as (select attempt_id, run, stream_name, no, case when contains(name,'::') then substr(name, strpos(name,'::')+2) else name end as test, case when word in ({passing}) then 'passed' when word in ({failing}) then 'failed' end as status from n)
 select attempt_id, run, stream_name, test, arg_max(status, no) as status from p where status is not null and test<>'' group by all"""


ORACLES["test_logs"] = _log_sql()
