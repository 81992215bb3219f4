"""The general data problems against plain versions, and their edge cases."""

import json

import pytest
from brute_general import builds, changes, entries
from brute_times import read
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.operators.drift import TRIAL_FIELDS, canonical_name, consistent_table, field_catalogue, field_lifespans, footer_catalogue, schema_changes
from grainmill.operators.logs import parse_log_entries
from grainmill.operators.nested import unnest_reports
from grainmill.operators.timestamps import normalize_timestamps, viterbi
from grainmill.plans import general
from grainmill.session import table


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_p1_whole_table(spark, data):
    want = set()
    for x in table(spark, data, "validation_attempts").select("attempt_id", "details.without_solution.stdout_tail", "details.without_solution.stderr_tail").collect():
        for name, text in (("stdout", x[1]), ("stderr", x[2])):
            want |= {(x[0], name, *e) for e in entries(text or "")}
    assert rows(general.p1_found(spark, data)) == sorted(want) and want


LOG = """4-14 07:15:03,347 - store - ERROR - cut off
2025-04-14 07:15:03,347 - store - ERROR - first
  more of it
\t
not part of it
{"ts": 1741488979.271, "lvl": "crit", "logger": "a.b", "msg": "x"}
2025/04/05 06:16:12 [warning] 6017#2: *11 no component\r
ERROR in column 3
I0508 12:38:53.486787  1295 watch_dirs.cc:96] letter
2025-01-15,387,matrix"""


def parse(spark, texts, **extra):
    schema = "k long, text string, stream_name string, layout int"
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], schema)
    return parse_log_entries(df, ["k"], {"text": F.col("text")})


def test_log_edges(spark):
    got = [tuple(r) for r in parse(spark, [LOG, None, "", "\n\n", "x" * 300_000]).orderBy("first_line").select("k", "first_line", "last_line", "log_level", "component", "message").collect()]
    assert got == [
        (0, 2, 3, "ERROR", "store", "first\n  more of it"),
        (0, 6, 6, "CRITICAL", "a.b", "x"),
        (0, 7, 8, "WARNING", "", "*11 no component\nERROR in column 3"),
        (0, 9, 10, "INFO", "watch_dirs.cc", "letter\n2025-01-15,387,matrix"),
    ]
    assert parse(spark, []).count() == 0


OPEN = """2025-01-01 00:00:00 INFO root: x
[12:00:00] INFO app: y
12:00:00 WARN z

{ "ts": "2025-01-01T00:00:00Z", "level": "info", "msg": "m" }
INFO: [2025-01-01T00:00:00Z] a.b - hello
1741488979 error | disk full
at 12:00:00 INFO no
12:00:00 informative text
ERROR at column 3"""


def test_log_open_layouts(spark):
    got = [tuple(r) for r in parse(spark, [OPEN]).orderBy("first_line").select("first_line", "last_line", "log_level", "component", "message").collect()]
    assert got == [
        (1, 1, "INFO", "root", "x"), (2, 2, "INFO", "app", "y"), (3, 3, "WARNING", "", "z"), (5, 5, "INFO", "", "m"), (6, 6, "INFO", "a.b", "hello"),
        (7, 10, "ERROR", "", "disk full\nat 12:00:00 INFO no\n12:00:00 informative text\nERROR at column 3"),
    ]


def test_log_instants(spark):
    from grainmill.operators.logs import entry_instant

    cases = [
        ("2025-04-14 07:15:03,347", "2025-04-14 07:15:03.347"), ("2025-04-14T07:15:03.5+02:00", "2025-04-14 05:15:03.5"), ("1741488979.271", "2025-03-09 02:56:19.271"),
        ("2025/04/05 06:16:12", "2025-04-05 06:16:12"), ("0105 12:38:53.486787", "2025-01-05 12:38:53.486787"), ("1231 12:38:53.486787", "2024-12-31 12:38:53.486787"),
        ("Jan  5 12:38:53", "2025-01-05 12:38:53"), ("Dec 31 23:00:00", "2024-12-31 23:00:00"), ("09:59:59.5", "2025-01-05 09:59:59.5"), ("10:00:01", "2025-01-04 10:00:01"),
        ("05/Jan/2025:10:00:00 +0000", "2025-01-05 10:00:00"), ("1399 12:38:53.0", None), ("soon", None), (None, None),
    ]
    df = spark.createDataFrame(cases, "t string, want string").withColumn("rec", F.lit("2025-01-05 10:00:00").cast("timestamp"))
    got = df.select("t", entry_instant(F.col("t"), F.col("rec")).cast("string").alias("got"), F.col("want").cast("timestamp").cast("string").alias("want")).collect()
    assert [(r.t, r.got) for r in got] == [(r.t, r.want) for r in got]
    none = spark.createDataFrame([("10:00:01",), ("2025-04-14 07:15:03",)], "t string").select(entry_instant(F.col("t"), F.lit(None).cast("timestamp")).alias("x")).collect()
    assert none[0].x is None and none[1].x is not None


def test_p3_whole_tables(spark, data):
    want = set()
    for t, k, fs in (("trials", "trial_key", ("agent_started_at", "agent_ended_at")), ("task_status", "status_id", ("updated_at",))):
        for x in table(spark, data, t).select(k, "host_tz", *fs).collect():
            want |= {(t, x[0], f, u) for f in fs if (u := read(x[f], x.host_tz)) is not None}
    got = {(r.table_name, r.row_id, r.field_name, r.epoch_us) for r in general.p3_found(spark, data).collect()}
    assert got == want and want


def times(spark, values, zone="UTC", **kw):
    df = spark.createDataFrame([(i, v, zone, "s", "clash") for i, v in enumerate(values)], "k long, v string, z string, w string, canonical string")
    got = normalize_timestamps(df, ["k"], "v", "z", ["w"], "k", **kw)
    return {r.k: r.epoch_us for r in got.collect()}


def us(text):
    from datetime import datetime, timedelta

    return (datetime.fromisoformat(text) - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def test_times_zones_and_gaps(spark):
    got = times(spark, ["2025-03-30 02:30:00", "2025-10-26 02:30:00", "1741488979.271", "2025-02-30T10:00:00Z", "n/a", None, "", "2025-05-01T00:00:00.1234567Z", "05/04/2025 12:30:00 AM", "05.04.2025 12:30:00"], "Europe/Berlin")
    assert got == {
        0: us("2025-03-30 01:30:00"), 1: us("2025-10-26 00:30:00"), 2: 1741488979271000, 7: us("2025-05-01 00:00:00.123456"), 8: us("2025-05-03 22:30:00"), 9: us("2025-04-05 10:30:00"),
    }
    assert times(spark, []) == {}


def test_times_by_record_order(spark):
    # no convention given: only day first keeps the record order moving forward
    v = ["2025-02-01T00:00:00Z", "03/02/2025 00:00:00", "04/02/2025 00:00:00", "2025-02-05T00:00:00Z"]
    want = {0: us("2025-02-01"), 1: us("2025-02-03"), 2: us("2025-02-04"), 3: us("2025-02-05")}
    assert times(spark, v, slash_order=None) == want
    # the same across block edges: every record in a block of its own
    assert times(spark, v, slash_order=None, block_span=1) == want
    assert times(spark, v, slash_order=None, block_span=2) == want
    assert times(spark, v)[1] == us("2025-03-02")


def test_viterbi_is_optimal():
    import itertools
    import random

    rnd = random.Random(3)
    for _ in range(60):
        n = rnd.randint(1, 6)
        us_, fmt, cost = ([[rnd.randint(0, 9) for _ in range(rnd.randint(1, 3))] for _ in range(n)] for _ in range(3))
        for t in range(n):
            k = min(len(us_[t]), len(fmt[t]), len(cost[t]))
            us_[t], fmt[t], cost[t] = us_[t][:k], fmt[t][:k], cost[t][:k]

        def total(pick):
            s = sum(cost[t][i] for t, i in enumerate(pick))
            return s + sum((fmt[t][pick[t]] != fmt[t - 1][pick[t - 1]]) + 2.0 * (us_[t][pick[t]] < us_[t - 1][pick[t - 1]]) for t in range(1, n))

        assert total(viterbi(us_, fmt, cost, 1.0, 2.0)) == min(total(p) for p in itertools.product(*[range(len(x)) for x in us_]))


def test_p4_whole_table(spark, data):
    want = {(x.report_id, *b) for x in table(spark, data, "batch_reports").select("report_id", "report_json").collect() if x.report_json for b in builds(x.report_json)}
    got = {tuple(r) for r in general.p4_found(spark, data).collect()}
    assert got == want and want


def test_reports_edges(spark):
    check = {"details": json.dumps({"build": {"success": 1}}), "execution_times": [{"phase": "build", "seconds": "0.72s"}]}
    doc = {"results": [None, {"topic": "a", "stages": {"functional": {"details": None}, "retry_2": {"functional": check}, "evaluation": {"tier_results": {"final": {"passes": 1, "total": 2, "trials": [{"trial": "t0", "resolved": "true"}]}}}}, "validation_attempts": [{"attempt": 3, "details": {"build": {}}}]}]}
    df = spark.createDataFrame([(1, json.dumps(doc)), (1, json.dumps(doc)), (2, None), (3, ""), (4, "{broken"), (5, "[]"), (6, '{"results": 3}')], "id long, j string").withColumn("result_no", F.lit("clash"))
    t = unnest_reports(df, "id", "j")
    assert rows(t["builds"].distinct()) == [(1, 1, 2, "true", 720, None), (1, 1, 3, "unknown", -1, None)]
    assert t["builds"].count() == 4  # repeated reports repeat
    assert rows(t["results"].select("id", "result_no", "topic").distinct()) == [(1, 1, "a")]
    assert rows(t["trials"].select("tier", "trial_no", "resolved").distinct()) == [("final", 0, "true")]
    assert rows(t["tiers"].select("tier", "passes", "total").distinct()) == [("final", 1, 2)]
    assert all(x.count() == 0 for x in unnest_reports(df.limit(0), "id", "j").values())


def test_p6_whole_table(spark, data):
    want = changes((x.stream_id, x.file_no, x.record_json) for x in table(spark, data, "trial_files").select("stream_id", "file_no", "record_json").collect())
    got = {tuple(r) for r in general.p6_found(spark, data).collect()}
    assert got == want and want


DRIFT = [
    (1, 1, '{"is_resolved": true, "x": 1, "n": null}'), (1, 1, "{broken"), (1, 1, None),
    (1, 2, '{"solved": "true", "n": null}'), (1, 2, '{"solved": "true", "n": null}'),
    (1, 4, '{"solved": "true", "n": 3, "x": [1], "total_input_tokens": {"count": 5}}'),
    (2, 1, "not json"), (2, 2, '{"isResolved": 1, "totalInputTokens": "4,041"}'),
]


def test_drift_edges(spark):
    df = spark.createDataFrame(DRIFT, "s long, f int, j string").withColumn("kinds", F.lit("clash"))
    cat = field_catalogue(df, ["s"], "f", "j")
    assert {tuple(r) for r in schema_changes(cat, ["s"], "f").collect()} == {
        (1, 2, "x", "removed"), (1, 2, "is_resolved", "renamed"), (1, 2, "is_resolved", "retyped"),
        (1, 4, "x", "added"), (1, 4, "total_input_tokens", "added"),
        (2, 2, "is_resolved", "added"), (2, 2, "total_input_tokens", "added"),
    }
    life = {tuple(r) for r in field_lifespans(cat, ["s"], "f").where("field = 'x'").select("first_file", "last_file", "n_files").collect()}
    assert life == {(1, 1, 1), (4, 4, 1)}
    got = consistent_table(df, ["s", "f"], "j").select("s", "f", "is_resolved", "total_input_tokens", "extra").orderBy("s", "f").collect()
    assert [(r.s, r.f, r.is_resolved, r.total_input_tokens) for r in got] == [(1, 1, True, None), (1, 2, True, None), (1, 2, True, None), (1, 4, True, 5), (2, 2, True, 4041)]
    assert got[0].extra == {"x": "1"} and got[3].extra == {"n": "3", "x": "[1]"}
    assert schema_changes(field_catalogue(df.limit(0), ["s"], "f", "j"), ["s"], "f").count() == 0


def test_canonical_names(spark):
    df = spark.createDataFrame([("testResults",), ("agent_start",), ("cache_hits",), ("id",)], "n string")
    assert [r[0] for r in df.select(canonical_name(F.col("n"))).collect()] == ["parser_results", "agent_started_at", "cache_hits", "id"]


def test_footers(spark, tmp_path):
    """Footers feed the same change log as records do."""
    df = spark.range(3).select("id", F.col("id").cast("string").alias("solved"), F.array("id").alias("a"), F.struct("id").alias("o"))
    df.coalesce(1).write.parquet(str(tmp_path / "1"))
    df.select("id", (F.col("id") > 0).alias("is_resolved"), F.col("id").cast("timestamp").alias("t"), F.lit(1.5).alias("x")).coalesce(1).write.parquet(str(tmp_path / "2"))
    (tmp_path / "3.parquet").write_text("broken")
    paths = [("p", n, str(next((tmp_path / str(n)).glob("*.parquet")))) for n in (1, 2)] + [("p", 3, str(tmp_path / "3.parquet")), ("p", 4, None)]
    cat = footer_catalogue(spark.createDataFrame(paths, "s string, f int, path string"), ["s"], "f", "path")
    assert {tuple(r) for r in cat.where("f < 3").collect()} == {
        ("p", 1, "id", "id", 2, 3), ("p", 1, "solved", "is_resolved", 4, 3), ("p", 1, "a", "a", 16, 3), ("p", 1, "o", "o", 8, 3),
        ("p", 2, "id", "id", 2, 3), ("p", 2, "is_resolved", "is_resolved", 1, 3), ("p", 2, "t", "t", 4, 3), ("p", 2, "x", "x", 2, 3),
    }
    assert {tuple(r)[1:] for r in schema_changes(cat.where("f < 3"), ["s"], "f").collect()} == {
        (2, "is_resolved", "renamed"), (2, "is_resolved", "retyped"), (2, "a", "removed"), (2, "o", "removed"), (2, "t", "added"), (2, "x", "added"),
    }
    assert {tuple(r)[1:] for r in schema_changes(cat, ["s"], "f").where("f = 3").collect()} == {(3, k, "removed") for k in ("id", "is_resolved", "t", "x")}
    assert cat.columns == field_catalogue(spark.createDataFrame([("p", 1, "{}")], "s string, f int, j string"), ["s"], "f", "j").columns


def test_unread_footers_are_no_result(spark, data, tmp_path):
    """A damaged file differs from one without columns, a path that can't be opened is an error, and the query names the table."""
    import os
    import shutil

    import pyarrow as pa
    import pyarrow.parquet as pq

    from grainmill.plans.general import p6_footers

    pq.write_table(pa.table({}), tmp_path / "none.parquet")
    pq.write_table(pa.table({"a": [1, 2]}), tmp_path / "whole.parquet")
    body = (tmp_path / "whole.parquet").read_bytes()
    (tmp_path / "cut.parquet").write_bytes(body[: len(body) // 2])
    (tmp_path / "thrift.parquet").write_bytes(body[:4] + b"\xff" * (len(body) - 12) + body[-8:])
    cat = lambda *names: footer_catalogue(spark.createDataFrame([("p", i, str(tmp_path / f"{n}.parquet")) for i, n in enumerate(names)], "s string, f int, path string"), ["s"], "f", "path")
    got = {tuple(r)[1:] for r in cat("none", "whole", "cut", "thrift").collect()}
    assert got == {(0, None, None, 0, 0), (1, "a", "a", 2, 2), (2, None, None, None, None), (3, None, None, None, None)}
    with pytest.raises(Exception, match="missing.parquet"):
        cat("whole", "missing").collect()
    for n in ("tasks", "trials", "documents", "trial_files", "pipeline_results", "pack_limits"):
        shutil.copy(f"{data}/{n}.parquet", tmp_path / f"{n}.parquet")
    assert p6_footers(spark, str(tmp_path)).count() == p6_footers(spark, data).count() > 0
    os.chmod(tmp_path / "trials.parquet", 0o644)
    (tmp_path / "trials.parquet").write_text("broken")
    with pytest.raises(Exception, match="table trials"):
        p6_footers(spark, str(tmp_path)).collect()


def test_consistent_table_reads_odd_values(spark):
    forms = {
        "agent_started_at": 1741064767123, "agent_ended_at": "03/04/2025 05:06:07 PM", "trial_started_at": "Tue Mar  4 17:06:07 2025", "trial_ended_at": "20250304-170607",
        "test_started_at": "04.03.2025 17:06:07", "test_ended_at": "2025-13-04 17:06:07",
    }
    tests = [{"test": "a", "status": "passed"}, {"test": "b", "status": "passed"}, {"test": "a", "status": "failed"}, {"test": None, "status": "x"}]
    docs = [{**forms, "parser_results": tests}, {"solved": "maybe", "is_resolved": True, "isResolved": False}, {"agent_start": 1.741064767e9}, {}]
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(docs)] + [(8, "[1]"), (9, None)], "s long, j string").withColumn("extra", F.lit("clash"))
    got = consistent_table(df, ["s"], "j").withColumns({c: F.unix_micros(c) for c in TRIAL_FIELDS if c.endswith("_at")}).orderBy("s").collect()
    assert [r.s for r in got] == [0, 1, 2, 3]
    at = us("2025-03-04 17:06:07")
    assert (got[0].agent_started_at, got[0].agent_ended_at, got[0].trial_started_at, got[0].trial_ended_at, got[0].test_started_at, got[0].test_ended_at) == (1741064767123000, at, at, at, at, None)
    assert got[0].parser_results == {"a": "failed", "b": "passed"} and got[0].extra == {"test_ended_at": '"2025-13-04 17:06:07"'}
    # the first name in order gives the value, nothing of the others is lost
    assert got[1].is_resolved is False and got[1].extra == {"is_resolved": "true", "solved": '"maybe"'}
    assert got[2].agent_started_at == 1741064767000000 and got[3].extra == {}


def test_read_instant_agrees_with_the_sequences(spark, data):
    """The single reading equals the decoded one wherever the conventions decide."""
    from grainmill.operators.timestamps import read_instant

    rows_ = general._printed_times(spark, data)
    one = rows_.select("table_name", "row_id", "field_name", F.unix_micros(read_instant(F.col("value"), F.col("host_tz"))).alias("us")).where("us is not null")
    want = {tuple(r) for r in general.p3_found(spark, data).collect()}
    got = {tuple(r) for r in one.collect()}
    assert len(want - got) == 0


@pytest.mark.parametrize("name", ["p4_trials", "p6_table"])
def test_schema_is_flat(spark, data, name):
    assert all(not isinstance(f.dataType, T.StructType) for f in general.QUERIES[name](spark, data).schema)


def test_reports_keep_their_leaves(spark):
    check = {
        "attempt": 2, "passed": False, "issues": ["Tests time out", None, "no image"], "execution_times": {"build": 0.5, "test_without_solution": "2s"}, "image_size_mb": 9.5,
        "details": json.dumps({"build": {"success": False, "error": "layer 5 broke"}, "without_solution": {"exit_code": 1, "timed_out": False, "stdout_tail": "1 failed"}, "with_solution": None}),
    }
    listed = {"execution_times": [{"phase": "test_with_solution", "seconds": "250ms"}]}
    usage = {"prompt_tokens": 5, "completion_tokens": 2, "total_tokens": 7}
    stages = {
        "generate": {"status": "success", "model": "m", "usage": usage, "duration_sec": 1.5}, "retry_1": {"status": "failed", "usage": usage, "functional": listed},
        "difficulty_adj_1": {"status": "success"}, "functional": {"passed": True}, "evaluation": {"classification": "too_hard", "tier_results": {"final": {"trials": [{"failure_mode": "timeout", "output_tokens": 4}]}}},
    }
    doc = {"metrics": {"total": 16}, "results": [{"topic": "a", "stages": stages, "validation_attempts": [check]}, {"classification": "learnable", "stages": {"evaluation": {"classification": "too_easy"}}}]}
    t = unnest_reports(spark.createDataFrame([(1, json.dumps(doc)), (2, json.dumps({"report": doc})), (3, None), (4, "[]")], "id long, j string"), "id", "j")
    one = {k: sorted((tuple(r)[1:] for r in v.where("id = 1").collect()), key=str) for k, v in t.items()}
    assert one == {k: sorted((tuple(r)[1:] for r in v.where("id = 2").collect()), key=str) for k, v in t.items()}
    assert all(v.where("id > 2").count() == 0 for v in t.values())
    assert rows(t["results"].where("id = 1").select("result_no", "classification")) == [(0, "too_hard"), (1, "learnable")]
    assert one["issues"] == [(0, 2, 0, "Tests time out"), (0, 2, 2, "no image")]
    assert one["times"] == [(0, 1, "test_with_solution", "250ms", 250), (0, 2, "build", "0.5", 500), (0, 2, "test_without_solution", "2s", 2000)]
    assert one["builds"] == [(0, 2, "false", 500, "layer 5 broke")]
    assert one["runs"] == [(0, 2, "without_solution", 1, "false", "1 failed", None)]
    assert one["stages"] == [
        (0, "difficulty_adj_1", "success", None, None, None, None, None, {}), (0, "evaluation", None, None, "too_hard", None, None, None, {}),
        (0, "generate", "success", "m", None, 5, 2, 7, {"duration_sec": "1.5"}), (0, "retry_1", "failed", None, None, 5, 2, 7, {}), (1, "evaluation", None, None, "too_easy", None, None, None, {}),
    ]
    assert one["metrics"] == [("total", "16")]
    assert rows(t["checks"].where("id = 1 and attempt_no = 2").select("n_issues", "extra")) == [(3, {"image_size_mb": "9.5"})]
    assert rows(t["trials"].where("id = 1").select("failure_mode", "output_tokens")) == [("timeout", 4)]


def test_reports_keep_unknown_fields(spark):
    trial = {"trial": "t0", "seed": 7, "why": None}
    doc = [None, {"topic": "a", "owner": "x", "stages": {"evaluation": {"tier_results": {"final": {"passes": 1, "early_stopped": True, "trials": [None, trial]}}}}}, {"tags": ["b"]}]
    t = unnest_reports(spark.createDataFrame([(1, json.dumps(doc)), (2, None)], "id long, j string"), "id", "j")
    assert sorted((tuple(r) for r in t["others"].collect()), key=str) == [
        (1, 1, "final", 1, "seed", "7"), (1, 1, "final", None, "early_stopped", "true"), (1, 1, None, None, "owner", "x"), (1, 2, None, None, "tags", '["b"]'),
    ]


def test_consistent_table_keeps_every_field(spark):
    record = {
        "instruction": "do", "trialStartedAt": "2024-03-01T10:00:00Z", "trial_ended_at": 1709287260, "agent_start": "2024-03-01T10:01:00Z", "agent_end": "2024-03-01T10:02:00Z",
        "test_started_at": "2024-03-01 10:03:00", "test_ended_at": "soon", "is_resolved": "maybe", "x": 1,
    }
    got = consistent_table(spark.createDataFrame([(1, json.dumps(record))], "s long, j string"), ["s"], "j")
    r = got.withColumns({c: F.date_format(c, "HH:mm:ss") for c in got.columns if c.endswith("_at")}).first()
    assert r.instruction == "do" and r.is_resolved is None
    assert (r.trial_started_at, r.trial_ended_at, r.agent_started_at, r.agent_ended_at, r.test_started_at, r.test_ended_at) == ("10:00:00", "10:01:00", "10:01:00", "10:02:00", "10:03:00", None)
    assert r.extra == {"x": "1", "test_ended_at": '"soon"', "is_resolved": '"maybe"'}
