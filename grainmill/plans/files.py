"""Queries of sources, sinks and streams: the given tables are written in the layouts of the logs, reports and folders, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.operators import metrics, sampling
from grainmill.plans.inventory import ORACLES as KNOWN
from grainmill.session import ensure_checkpoint_dir, table
from grainmill.sources import readers, sinks
from grainmill.streaming import live

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def _scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own beside the checkpoints, which all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _results(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pipeline_results")


@query("""with f as (select *, case origin when 'report' then 1 else 2 end as no from pipeline_results), m as (select batch, min(no) as no from f group by batch)
 select batch, (row_number() over (partition by batch order by result_id) - 1)::int as position, topic, status, classification from f join m using (batch, no)""")
def report_scan(spark, d):
    """Results of the first report of every batch: one document per report, in batch folders."""
    r = _results(spark, d).withColumn("no", F.when(F.col("origin") == "report", 1).otherwise(2))
    packed = r.groupBy("batch", "no").agg(F.array_sort(F.collect_list(F.struct("result_id", "topic", "status", "classification"))).alias("results"))
    at = _scratch(spark, "reports")
    packed.select("batch", "no", F.to_json(F.struct("results")).alias("value")).repartition("batch", "no").write.partitionBy("batch", "no").text(at)
    got = readers.read_reports(spark, f"{at}/batch=*/no=*/*.txt", r"batch=([^/]+)/no=\d+/[^/]+$")
    return got.select("batch", "position", "topic", "status", "classification")


@query("""select batch, count(*) as n_results, count(*) filter (classification='learnable') as learnable from pipeline_results group by batch""")
def report_write(spark, d):
    """Reports with their metrics, one document per batch, written and read back."""
    r, at = _results(spark, d), _scratch(spark, "report")
    sinks.write_report(metrics.funnel(r, ["batch"]), r.select("batch", "result_id", "topic"), "batch", at)
    got = spark.read.schema("batch string, metrics struct<learnable: bigint>, results array<struct<result_id: bigint>>").json(at)
    return got.select("batch", F.size("results").cast("long").alias("n_results"), F.col("metrics.learnable").alias("learnable"))


@query("select result_id, topic, status, classification from pipeline_results where origin='incremental'")
def append_log_scan(spark, d):
    """An append log with blank and broken lines between its records."""
    at = _scratch(spark, "log")
    sinks.append_lines(_results(spark, d).where("origin = 'incremental'").select("result_id", "topic", "status", "classification"), at)
    spark.range(40).select(F.when(F.col("id") % 2 == 0, "").otherwise('{"topic": "cut o').alias("value")).coalesce(1).write.mode("append").text(at)
    return readers.read_json_lines(spark, f"{at}/part-*", "result_id long, topic string, status string, classification string").select("result_id", "topic", "status", "classification")


@query("select batch, count(*) as total, count(*) filter (classification='learnable') as learnable from pipeline_results group by batch")
def metrics_document(spark, d):
    """The metrics document replaced as a whole and read back; a missing document is empty."""
    at = _scratch(spark, "metrics")
    got = metrics.funnel(_results(spark, d), ["batch"]).select("batch", "total", "learnable")
    sinks.write_document(got.limit(0), at)
    sinks.write_document(got, at)
    schema = "batch string, total long, learnable long"
    return readers.read_json_lines(spark, f"{at}/part-*", schema).unionByName(readers.read_json_lines(spark, f"{at}-none/*", schema)).select("batch", "total", "learnable")


@query("""select batch, report_id::varchar as report, case when report_json is null then 'no_results' when json_valid(report_json) then 'ok' else 'parse_error' end as read_status from batch_reports""")
def result_files(spark, d):
    """One result file per report in its batch's folder: read, unreadable or missing."""
    reports, at = table(spark, d, "batch_reports"), _scratch(spark, "results")
    rows = reports.where("report_json is not null").select("batch", F.col("report_id").alias("report"), F.regexp_replace("report_json", r"[\r\n]+", " ").alias("value"))
    rows.repartition("batch", "report").write.partitionBy("batch", "report").text(at)
    expected = reports.select(F.concat(F.lit("batch="), "batch").alias("task_dir"), F.concat(F.lit("report="), F.col("report_id")).alias("trial_dir"))
    got = readers.read_trials(spark, f"{at}/batch=*/report=*/*.txt", expected)
    return got.select(F.substring("task_dir", 7, 99).alias("batch"), F.substring("trial_dir", 8, 99).alias("report"), "read_status")


@query("select max(batch) as batch from pipeline_results")
def latest_report(spark, d):
    """The batch of the last report by name."""
    at = _scratch(spark, "latest")
    _results(spark, d).select("batch", F.lit("{}").alias("value")).distinct().repartition("batch").write.partitionBy("batch").text(at)
    path = readers.latest_file(spark, f"{at}/batch=*/*.txt")
    return spark.createDataFrame([(path.split("batch=")[1].split("/")[0],)], "batch string")


@query("select task_key, task_id from tasks where (task_id like '%-a%' or task_id like 'f%') and not task_id like '%-1__'")
def selected_tasks(spark, d):
    """Tasks by glob lists of names to take and to leave."""
    readers.check_selection(d, None, None)
    return readers.chosen(table(spark, d, "tasks").select("task_key", "task_id"), "task_id", ["*-a*", "f*"], ["*-1??"])


@query("select distinct run_id from trials where run_id is not null")
def run_list(spark, d):
    return readers.runs(table(spark, d, "trials"), "run_id")


_RUN = "run_id||'-'||(epoch_us(coalesce(trial_started_at, timestamp '2020-01-01'))//1000000)::varchar"


@query(f"select distinct {_RUN} as run, (epoch_us(trial_started_at)//1000000)::bigint as run_epoch from trials where run_id is not null and trial_started_at >= timestamp '2025-03-01'")
def live_run_scan(spark, d):
    """Runs whose name ends in an epoch that isn't before a start."""
    at = F.unix_seconds(F.coalesce(F.col("trial_started_at").cast("timestamp"), F.lit("2020-01-01").cast("timestamp")))
    named = table(spark, d, "trials").where("run_id is not null").select(F.concat("run_id", F.lit("-"), at.cast("string")).alias("run")).distinct()
    return readers.live_runs(named, "run", F.unix_seconds(F.lit("2025-03-01").cast("timestamp"))).select("run", "run_epoch")


@query("""select task_key, case when instruction is null then 'not a mapping' when contains(parser_name, 'x') then 'unreadable' end as issue,
 case when instruction is not null and not contains(coalesce(parser_name,''), 'x') then instruction end as instruction, case when instruction is not null and not contains(coalesce(parser_name,''), 'x') then coalesce(max_agent_timeout_sec,0)::double end as max_agent_timeout_sec from tasks""")
def task_documents(spark, d):
    """Task documents as YAML: mappings, lists in their place, and unreadable ones."""
    t = table(spark, d, "tasks")
    limit = F.coalesce("max_agent_timeout_sec", F.lit(0)).cast("double").cast("string")
    good = F.concat(F.lit("instruction: "), F.to_json(F.struct(F.col("instruction").alias("x"))), F.lit("\nmax_agent_timeout_sec: "), limit)
    text = F.when(F.col("instruction").isNull(), "- no mapping").when(F.col("parser_name").contains("x"), "a: [").otherwise(good)
    got = readers.parse_yaml(t.select("task_key", text.alias("text")), ["task_key"], "text", "instruction struct<x: string>, max_agent_timeout_sec double")
    return got.select("task_key", "issue", F.col("doc.instruction.x").alias("instruction"), F.col("doc.max_agent_timeout_sec").alias("max_agent_timeout_sec"))


@query("""select coalesce(category,'none') as category, count(*)::bigint as lines, sum(octet_length(encode(topic))+1)::bigint as bytes from topic_entries where topic is not null and not contains(topic, chr(10)) group by 1""")
def folder_scan(spark, d):
    """Folders of text files: every file below them with its length and content, but none that begins with a dot or underscore."""
    at = _scratch(spark, "folders")
    rows = table(spark, d, "topic_entries").where("topic is not null and not contains(topic, chr(10))").select(F.coalesce("category", F.lit("none")).alias("category"), F.col("topic").alias("value"))
    rows.repartition("category").write.partitionBy("category").text(at)
    files = readers.source_files(readers.read_task_files(spark, at), ["task.yaml"])
    n = F.size(F.split("content", "\n")) - 1
    return files.groupBy(F.substring("task_dir", 10, 99).alias("category")).agg(F.sum(n).cast("long").alias("lines"), F.sum("length").alias("bytes"))


@query("select task_id from tasks where task_id is not null except select task_id from trials")
def new_task_rows(spark, d):
    """Registered tasks that the table of trials doesn't know, one row each, as they would be inserted."""
    t = table(spark, d, "tasks").where("task_id is not null").select("task_id")
    return sinks.insert_new(t, table(spark, d, "trials").where("task_id is not null"), "task_id")


@query("""select task_key from tasks where instruction is not null and not exists (select 1 from topic_entries e where e.topic = tasks.instruction) and task_key not in
 (select b.task_key from tasks a join tasks b on a.instruction=b.instruction and a.task_key<b.task_key)""")
def promoted_tasks(spark, d):
    """Tasks whose instruction is no exact copy of an earlier one, appended to a curated table."""
    t, at = table(spark, d, "tasks").where("instruction is not null").select("task_key", "instruction"), _scratch(spark, "curated")
    first = t.groupBy("instruction").agg(F.min("task_key").alias("first"))
    copies = t.join(first, "instruction").where("task_key > first").select("task_key")
    named = t.join(table(spark, d, "topic_entries").select(F.col("topic").alias("instruction")), "instruction", "left_semi").select("task_key")
    sinks.promote(t.where("task_key % 2 = 0"), copies.union(named), "task_key", at)
    sinks.promote(t.where("task_key % 2 = 1"), copies.union(named), "task_key", at)
    return spark.read.parquet(at).select("task_key")


@query("select task_dir, attempt, count(*) as n, count(*) filter (coalesce(passed,false)) as n_passed from validation_attempts where task_dir is not null and attempt is not null group by all")
def attempt_snapshots(spark, d):
    """Validation attempts as snapshots under the folder of their attempt, appended in two runs and read back."""
    a, at = table(spark, d, "validation_attempts").where("task_dir is not null and attempt is not null").select("task_dir", "attempt", "attempt_id", "passed"), _scratch(spark, "snapshots")
    for half in (0, 1):
        sinks.write_snapshots(a.where(F.col("attempt_id") % 2 == half), at, ["attempt"])
    got = spark.read.schema("task_dir string, attempt_id long, passed boolean, attempt int").json(at)
    return got.groupBy("task_dir", "attempt").agg(F.count("*").alias("n"), F.count_if(F.coalesce("passed", F.lit(False))).alias("n_passed"))


@query(KNOWN["topic_weights"])
def weights_written_back(spark, d):
    """Weights written back as a table and read as the old ones of the next run, which changes nothing where attempts decide."""
    r, at = _results(spark, d), _scratch(spark, "weights")
    old = r.where("topic is not null").select("topic").distinct().withColumn("old_weight", F.lit(1.0))
    sinks.write_weights(sampling.topic_weights(r, old, "topic"), at)
    return sampling.topic_weights(r, spark.read.parquet(at).withColumnRenamed("weight", "old_weight"), "topic")


@query("""select task_key, 'task.yaml' as path, instruction as content from tasks where instruction is not null union all select task_key, 'tags.txt', array_to_string(tags, chr(10)) from tasks where tags is not null and len(tags)>0""")
def task_file_rows(spark, d):
    """Files of a task as rows: lists joined by line feeds, paths that leave the folder dropped."""
    t = table(spark, d, "tasks")
    listed = F.when(F.size("tags") > 0, F.to_json("tags"))
    files = F.map_filter(F.create_map(F.lit("task.yaml"), F.col("instruction"), F.lit("tags.txt"), listed, F.lit("../out"), F.col("task_id"), F.lit("/etc/x"), F.col("task_id")), lambda _, v: v.isNotNull())
    return sinks.task_file_rows(t.select("task_key", files.alias("files")), "task_key", "files")


@query("select result_id, batch, status from pipeline_results")
def stream_append(spark, d):
    """An append log followed by a stream; the restarted stream adds only what is new."""
    at = _scratch(spark, "stream")
    rows = _results(spark, d).select("result_id", "batch", "status")
    for half in (0, 1):
        sinks.append_lines(rows.where(F.col("result_id") % 2 == half), f"{at}/in")
        for _ in range(2):
            live.append_to(live.stream_json(spark, f"{at}/in", "result_id long, batch string, status string"), f"{at}/out", f"{at}/log").awaitTermination()
    return spark.read.parquet(f"{at}/out")


@query("select stage, count(*) as n from task_status group by stage")
def stream_counts(spark, d):
    """Counts per stage kept by a stream in complete mode."""
    at, path = _scratch(spark, "counts"), f"{d}/task_status.parquet"
    s = live.stream_parquet(spark, path[:-1] + "[t]", spark.read.parquet(path))
    live.complete_counts(s, ["stage"], f"{at}/out", f"{at}/log").awaitTermination()
    return spark.read.parquet(f"{at}/out").select("stage", "n")


@query("select trial_key, run_id, epoch_us(trial_started_at)//1000000 as run_epoch from trials join (select run_id, min(epoch_us(ingested_at))//1000000 - 86400 as s from trials group by run_id) using (run_id) where epoch_us(trial_started_at)//1000000 >= s")
def runs_since_start(spark, d):
    """Trials of a run that began after the run's start (a day before its first delivery), by a join of the stream with the starts."""
    t = table(spark, d, "trials")
    us = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    starts = t.groupBy("run_id").agg((F.min(us("ingested_at")) - 86400).alias("start_epoch"))
    at, path = _scratch(spark, "since"), f"{d}/trials.parquet"
    s = live.stream_parquet(spark, path[:-1] + "[t]", t).select("trial_key", "run_id", us("trial_started_at").alias("run_epoch"))
    live.append_to(live.since(s, starts, "run_id").select("trial_key", "run_id", "run_epoch"), f"{at}/out", f"{at}/log").awaitTermination()
    return spark.read.parquet(f"{at}/out")


@query(f"select task_id as task, decided_at, passes, decision from ({KNOWN['early_stop_class']}) where decision is not null and task_id is not null")
def stream_running_class(spark, d):
    """Each task's class, put out once by a stateful stream when it is certain."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    at, path = _scratch(spark, "running"), f"{d}/trials.parquet"
    s = live.stream_parquet(spark, path[:-1] + "[t]", spark.read.parquet(path)).where("task_id is not null")
    s = s.select(F.col("task_id").alias("task"), F.col("trial_key").alias("seq"), F.coalesce("is_resolved", F.lit(False)).alias("resolved"))
    live.append_to(live.running_class(s), f"{at}/out", f"{at}/log").awaitTermination()
    return spark.read.parquet(f"{at}/out")
