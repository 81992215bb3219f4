"""Sinks: append logs, reports, status upserts, curated tables. All write through Spark's commit protocol."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.operators.merge import last_wins


def append_lines(df: DataFrame, path: str) -> None:
    """Append log: one JSON object a line; a task's lines appear only when it commits."""
    df.write.mode("append").json(path)


def write_report(metrics: DataFrame, results: DataFrame, by: str, path: str) -> None:
    """One JSON document per group: its metrics and the array of its results (bounded by a batch)."""
    packed = results.groupBy(by).agg(F.collect_list(F.struct(*[c for c in results.columns if c != by])).alias("results"))
    metrics.select(by, F.struct(*[c for c in metrics.columns if c != by]).alias("metrics")).join(packed, by, "left").write.mode("overwrite").json(path)


def write_document(df: DataFrame, path: str) -> None:
    """A result table as JSON lines, replaced as a whole."""
    df.write.mode("overwrite").json(path)


BUCKETS = 64


def upsert_latest(spark: SparkSession, new: DataFrame, path: str, key: Sequence[str], order: Sequence[str]) -> None:
    """Latest row per key of the table at ``path`` and the new rows.

    Rows lie in buckets of a hash of their key. A call merges the buckets that its rows fall in and
    writes them as a new version; the others stay as they are. Readers take the newest version of
    each bucket among those with a success marker, so a lost job leaves the old ones in force. A
    bucket keeps the version before its newest for readers that began earlier.
    """
    bucket = F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")
    rows = new.withColumn("_bucket", bucket)
    touched = sorted(r[0] for r in rows.select("_bucket").distinct().collect())  # at most BUCKETS numbers
    if not touched:
        return
    parts = _versions(spark, path)
    old = [f"{path}/v{parts[b][0]}/_bucket={b}" for b in touched if b in parts]
    if old:
        rows = spark.read.parquet(*old).withColumn("_bucket", bucket).unionByName(rows, allowMissingColumns=True)
    version = 1 + max((v[0] for v in parts.values()), default=-1)
    last_wins(rows, key, order).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/v{version}")
    fs, at = _fs(spark, path)
    for b in touched:
        for v in parts.get(b, [])[1:]:
            fs.delete(at(f"{path}/v{v}/_bucket={b}"), True)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _versions(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """The complete versions of each bucket, newest first."""
    fs, at = _fs(spark, path)
    done = {int(x.getPath().getParent().getName()[1:]) for x in fs.globStatus(at(f"{path}/v*/_SUCCESS")) or []}
    out: dict[int, list[int]] = {}
    for x in fs.globStatus(at(f"{path}/v*/_bucket=*")) or []:
        v, b = int(x.getPath().getParent().getName()[1:]), int(x.getPath().getName().split("=")[1])
        if v in done:
            out.setdefault(b, []).append(v)
    return {b: sorted(v, reverse=True) for b, v in out.items()}


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``upsert_latest`` keeps; fails if nothing was written."""
    return spark.read.option("mergeSchema", "true").parquet(*[f"{path}/v{v[0]}/_bucket={b}" for b, v in sorted(_versions(spark, path).items())])


def insert_new(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't in the table yet, one per key; hand it to ``write.jdbc`` or a table append."""
    fresh = df.join(existing.select(key).distinct(), key, "left_anti")
    return fresh.dropDuplicates([key])


def promote(candidates: DataFrame, matches: DataFrame, key: str, path: str) -> None:
    """Appends the candidates without a match to a curated table."""
    candidates.join(matches.select(key), key, "left_anti").write.mode("append").parquet(path)


def write_snapshots(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Adjustment snapshots and validation attempts: appended under their keys' folders."""
    df.write.mode("append").partitionBy(*by).json(path)


def write_weights(weights: DataFrame, path: str) -> None:
    """A small table of weights, replaced as a whole; the next run reads it as the old weights."""
    weights.write.mode("overwrite").parquet(path)


def task_file_rows(df: DataFrame, key: str, files: str) -> DataFrame:
    """key, path, content from a map of path to JSON text: lists are joined by line feeds, paths that leave the folder are dropped."""
    rows = df.select(key, F.explode(files).alias("path", "raw"))
    listed = F.from_json("raw", "array<string>")
    text = F.when(F.ltrim("raw").startswith("["), F.array_join(listed, "\n")).otherwise(F.col("raw"))
    inside = ~F.col("path").startswith("/") & ~F.col("path").rlike(r"(^|/)\.\.(/|$)")
    return rows.where(inside).select(key, "path", text.alias("content"))
