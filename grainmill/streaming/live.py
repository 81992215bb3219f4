"""Live views: append logs as streams, latest status, running classification, resume."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from heapq import nsmallest

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from grainmill.sources.sinks import upsert_latest


def stream_json(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """An append log as a stream of files; malformed lines are dropped."""
    return spark.readStream.schema(schema).option("mode", "DROPMALFORMED").option("maxFilesPerTrigger", files_per_trigger).json(path)


def stream_parquet(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.readStream.schema(like.schema).parquet(path)


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once append by the sink's commit log; restarting with the same checkpoint resumes."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_status(df: DataFrame, path: str, key: Sequence[str], order: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Latest row per key, merged micro-batch by micro-batch; replaying a batch changes nothing."""

    def merge(batch: DataFrame, _: int) -> None:
        upsert_latest(batch.sparkSession, batch, path, key, order)

    return df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(df: DataFrame, time: str, by: str, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts per event-time window; rows later than the watermark are dropped by design of the stream."""
    return df.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("n"))


def complete_counts(df: DataFrame, by: Sequence[str], path: str, checkpoint: str) -> StreamingQuery:
    """Counts per group over everything read so far, the result table replaced as a whole by every micro-batch (complete mode)."""

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    counts = df.groupBy(*by).agg(F.count("*").alias("n"))
    return counts.writeStream.outputMode("complete").foreachBatch(replace).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class RunningClass(StatefulProcessor):
    """Per task: passes and trials so far; emits the class once, when it is certain."""

    def __init__(self, n: int = 5, first: int = 3, low: int = 1, high: int = 3) -> None:
        self.n, self.first, self.low, self.high = n, first, low, high

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("counts", "passes int, total int, done boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        passes, total, done = self.state.get() if self.state.exists() else (0, 0, False)
        out, head = [], []
        for pdf in rows:  # a batch of one task may come in several frames; its first n trials decide
            head = nsmallest(self.n, [*head, *zip(pdf["seq"].tolist(), pdf["resolved"].tolist())], key=lambda x: x[0])
        for _, ok in head:
            if done or total >= self.n:
                break
            passes, total = passes + bool(ok), total + 1
            label = self.decide(passes, self.n - total) if total >= self.first else None
            if label:
                done = True
                out.append((key[0], total, passes, label))
        self.state.update((passes, total, done))
        yield pd.DataFrame(out, columns=["task", "decided_at", "passes", "decision"])

    def decide(self, passes: int, left: int) -> str | None:
        if passes > self.high:
            return "too_easy"
        if passes + left < self.low:
            return "too_hard"
        return "learnable" if passes >= self.low and passes + left <= self.high else None

    def close(self) -> None:
        pass


def running_class(trials: DataFrame, **limits) -> DataFrame:
    """task, decided_at, passes, decision from a stream of (task, seq, resolved)."""
    return trials.groupBy("task").transformWithStateInPandas(RunningClass(**limits), "task string, decided_at int, passes int, decision string", "append", "None")


def since(runs: DataFrame, starts: DataFrame, batch: str) -> DataFrame:
    """A stream of runs joined to the batches' start times, stale runs (before the start) left out."""
    return runs.join(starts, batch).where(F.col("run_epoch") >= F.col("start_epoch"))
