"""Readers of batch reports, append logs, trial results, task files and registries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

USAGE = "struct<prompt_tokens: bigint, completion_tokens: bigint, total_tokens: bigint>"
RESULT = (
    "topic string, task_dir string, status string, failed_stage string, classification string, passes bigint, total bigint, pass_rate double, retries int, duration_sec double, "
    f"stages struct<structural: struct<passed: boolean, output: string>, functional: struct<passed: boolean, issues: array<string>>, generate: struct<status: string, model: string, usage: {USAGE}>, "
    "evaluation: struct<classification: string, passes: bigint, total: bigint>>"
)
TRIAL = "id string, trial_name string, task_id string, instruction string, is_resolved boolean, failure_mode string, parser_results map<string,string>, total_input_tokens bigint, total_output_tokens bigint, agent_started_at string, agent_ended_at string"


def path_part(pattern: str) -> Column:
    """A part of the file's path, e.g. the batch folder of a report."""
    return F.nullif(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1), F.lit(""))


def paths_exist(spark: SparkSession, glob: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(glob)
    got = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return got is not None and len(got) > 0


def read_json_lines(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """Lines of append logs with their file; blank and malformed lines are skipped, a missing glob is empty."""
    if not paths_exist(spark, glob):
        return spark.createDataFrame([], f"{schema}, file string")
    return spark.read.schema(schema).json(glob, mode="DROPMALFORMED").select("*", F.col("_metadata.file_path").alias("file"))


def read_reports(spark: SparkSession, glob: str, batch: str = r"([^/]+)/[^/]+$", schema: str = RESULT) -> DataFrame:
    """Results of the first report (by path) of each batch; broken reports count as empty."""
    if not paths_exist(spark, glob):
        return spark.createDataFrame([], f"batch string, position int, {schema}")
    docs = spark.read.text(glob, wholetext=True).select(path_part(batch).alias("batch"), F.col("_metadata.file_path").alias("file"), "value")
    first = docs.groupBy("batch").agg(F.min_by("value", "file").alias("value"))
    parsed = first.select("batch", F.from_json(F.get_json_object("value", "$.results"), f"array<struct<{_struct(schema)}>>").alias("r"))
    return parsed.select("batch", F.posexplode("r").alias("position", "x")).select("batch", "position", "x.*")


def _struct(ddl: str) -> str:
    return T._parse_datatype_string(ddl).simpleString()[7:-1]


def latest_file(spark: SparkSession, glob: str, by_time: bool = False) -> str | None:
    """The last matching path by name, or the most recently modified one (auto-resume)."""
    files = spark.read.format("binaryFile").load(glob).select("path", "modificationTime")
    row = files.agg(F.max_by("path", F.struct("modificationTime", "path") if by_time else F.col("path")).alias("p")).first()
    return row.p


def read_trials(spark: SparkSession, glob: str, expected: DataFrame | None = None) -> DataFrame:
    """Trial results, one file each, with status ok or parse_error; expected (task_id, trial_name) rows without a file get no_results."""
    docs = spark.read.text(glob, wholetext=True).select(path_part(r"([^/]+)/[^/]+/[^/]+$").alias("task_dir"), path_part(r"([^/]+)/[^/]+$").alias("trial_dir"), F.from_json("value", TRIAL).alias("t"), F.try_parse_json("value").alias("v"))
    rows = docs.select("task_dir", "trial_dir", "t.*", F.when(F.col("v").isNull(), "parse_error").otherwise("ok").alias("read_status"))
    if expected is None:
        return rows
    return expected.join(rows, ["task_dir", "trial_dir"], "left").withColumn("read_status", F.coalesce("read_status", F.lit("no_results")))


def read_task_files(spark: SparkSession, root: str, hidden: bool = False) -> DataFrame:
    """task_dir, path (below the task), length, content of every file under root/<task>/; dot and underscore files are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    rel = F.element_at(F.split("path", "/" + root.rstrip("/").split("/")[-1] + "/", 2), 2)
    rows = files.select(F.substring_index(rel, "/", 1).alias("task_dir"), F.regexp_replace(rel, "^[^/]+/", "").alias("path"), "length", F.decode("content", "UTF-8").alias("content"))
    return rows if hidden else rows.where(~F.col("path").rlike("(^|/)[._]"))


def source_files(files: DataFrame, infra: Sequence[str]) -> DataFrame:
    """A task's own source files: without infrastructure, tests, and validation or underscore files."""
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(~name.isin(*infra) & ~name.rlike("^(_|validation_)") & ~F.col("path").startswith("tests/"))


def cohort(files: DataFrame) -> DataFrame:
    """Files of the directories that are tasks, that is, hold a task.yaml."""
    return files.join(files.where("path = 'task.yaml'").select("task_dir").distinct(), "task_dir", "left_semi")


def parse_yaml(df: DataFrame, keep: Sequence[str], text: str, schema: str) -> DataFrame:
    """YAML mappings as a struct ``doc`` and an ``issue`` (not a mapping, unreadable, or null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        import yaml

        for b in batches:
            docs, bad = [], []
            for t in b.column("_t").to_pylist():
                try:
                    v = yaml.safe_load(t) if t is not None else None
                    docs.append(json.dumps(v, default=str) if isinstance(v, dict) else None)
                    bad.append(None if isinstance(v, dict) else "not a mapping")
                except yaml.YAMLError:
                    docs.append(None)
                    bad.append("unreadable")
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], pa.array(docs, pa.string()), pa.array(bad, pa.string())], names=[*keep, "json", "issue"])

    rows = df.select(*keep, F.col(text).alias("_t"))
    kinds = dict(rows.dtypes)
    got = rows.mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", json string, issue string")
    return got.select(*keep, F.from_json("json", schema).alias("doc"), "issue")


def chosen(df: DataFrame, name: str, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Rows whose name matches an include glob and no exclude glob; an include that matches nothing is an error."""
    regex = lambda g: "^" + "".join(".*" if c == "*" else "." if c == "?" else "\\" + c if not c.isalnum() and c != "_" else c for c in g) + "$"
    for g in include:
        if df.where(F.col(name).rlike(regex(g))).isEmpty():
            raise ValueError(f"no name matches {g}")
    hit = F.lit(not include)
    for g in include:
        hit = hit | F.col(name).rlike(regex(g))
    for g in exclude:
        hit = hit & ~F.col(name).rlike(regex(g))
    return df.where(hit)


def check_selection(path: str | None, name: str | None, version: str | None) -> None:
    """A dataset is named by its path or by name and version, not both."""
    if (path is None) == (name is None):
        raise ValueError("give either a path or a name")
    if name is not None and version is None:
        raise ValueError("a name needs a version")


def live_runs(df: DataFrame, run: str, since_epoch: Column) -> DataFrame:
    """Runs whose id ends in an epoch that isn't before the given start."""
    at = F.regexp_extract(run, r"-(\d{9,})$", 1).try_cast("long")
    return df.withColumn("run_epoch", at).where(at >= since_epoch)


def runs(df: DataFrame, run: str) -> DataFrame:
    return df.select(run).where(F.col(run).isNotNull()).distinct()


def completed_topics(df: DataFrame, topic: str = "topic") -> DataFrame:
    return df.where(F.coalesce(F.col(topic) != "", F.lit(False))).select(topic).distinct()
