"""Small cases of the engine's operators, sources, sinks and streams."""

import json

import pytest
from pyspark.sql import functions as F

from grainmill.functions import scalars as S
from grainmill.operators import codefeatures, diversity, merge, metrics, quality, sampling, trials, validate
from grainmill.sources import readers, sinks
from grainmill.streaming import live


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one(spark, text, *cols):
    return tuple(spark.createDataFrame([(text,)], "x string").select(*[c(F.col("x")) for c in cols]).first())


RESULT = "batch string, topic string, status string, failed_stage string, classification string, duration_sec double, retries int, stages struct<structural: struct<passed: boolean>, functional: struct<passed: boolean>, generate: struct<usage: struct<prompt_tokens: bigint, completion_tokens: bigint, total_tokens: bigint>>, evaluation: struct<classification: string>>"


def result(batch="b", topic="t", status="completed", cls=None, stage=None, ok=True):
    return (batch, topic, status, stage, cls, 60.0, 0, ((ok,), (ok,), ((1000, 500, 1500),), None))


def test_funnel_empty_and_mixed(spark):
    empty = metrics.funnel(spark.createDataFrame([], RESULT)).first()
    assert (empty.total, empty.learnable_yield, empty.tokens) == (0, 0.0, 0)
    df = spark.createDataFrame([result(cls="learnable"), result("c", cls="learnable"), result(cls="too_easy"), result("c", cls="too_hard"), result(status="generation_failed"), result(status="error: x", ok=None)], RESULT)
    f = metrics.funnel(df).first()
    assert (f.total, f.generated, f.evaluated, f.learnable, f.too_easy, f.too_hard) == (6, 4, 4, 2, 1, 1)
    assert metrics.funnel(df, ["batch"], overall=True).count() == 3
    three = metrics.funnel(spark.createDataFrame([result(cls="learnable")] * 3, RESULT)).first()
    assert three.learnable_yield == 1.0


def test_error_categories(spark):
    df = spark.createDataFrame([result(status=s, stage=g) for s, g in (("completed", "x"), ("generation_failed", None), ("structural_failed", ""), ("infrastructure", None), ("error: y", None), ("odd", None), ("odd", "functional"))], RESULT)
    assert [r[0] for r in df.select(metrics.error_category()).collect()] == [None, "generation", "structural", "functional", "exception", "other", "functional"]


def merged(spark, report, inc):
    schema = "batch string, topic string, cls string, seq int"
    got = merge.report_merge(spark.createDataFrame(report, schema), spark.createDataFrame(inc, schema), ["batch", "topic"], ["seq"], F.col("cls").isNotNull())
    return {(r.batch, r.topic, r.cls) for r in got.collect()}


def test_report_merge(spark):
    assert merged(spark, [("b", "a", None, 0), ("b", "b", "learnable", 1)], [("b", "a", "too_easy", 0)]) == {("b", "a", "too_easy"), ("b", "b", "learnable")}
    assert merged(spark, [("b", "a", "learnable", 0)], [("b", "a", "too_hard", 0)]) == {("b", "a", "learnable")}
    assert merged(spark, [("b", "a", "learnable", 0)], [("b", "b", "too_hard", 0), ("b", "c", None, 1)]) == {("b", "a", "learnable"), ("b", "b", "too_hard")}
    assert merged(spark, [("b", "a", None, 0)], [("b", "a", "x", 1), ("b", "a", "y", 2), ("b", "a", None, 3)]) == {("b", "a", "y")}
    assert merged(spark, [("b", "a", "x", 0)], [("z", "q", None, 1), ("z", "q", None, 2)]) == {("b", "a", "x"), ("z", "q", None)}


def test_resume_and_overlay(spark):
    a = spark.createDataFrame([("t1", 1, "old"), ("t2", 1, "old"), ("t9", 1, "off plan")], "k string, seq int, v string")
    b = spark.createDataFrame([("t2", 0, "new")], "k string, seq int, v string")
    plan = spark.createDataFrame([("t2", 0), ("t1", 1), ("t3", 2)], "k string, position int")
    assert rows(merge.resume_merge(a, b, plan, "k", "seq").select("k", "v", "position")) == [("t1", "old", 1), ("t2", "new", 0)]
    assert rows(merge.remaining(plan, a, "k").select("k")) == [("t3",)]
    got = merge.overlay(a, b.select("k", "v").union(spark.createDataFrame([("zz", "unknown")], "k string, v string")), ["k"], "v", F.col("k") != "t1")
    assert rows(got.select("k", "v")) == [("t1", "old"), ("t2", "new"), ("t9", "off plan")]


def test_contains_and_basename(spark):
    left = spark.createDataFrame([(1, "abc"), (2, "abcdefgh"), (3, ""), (4, None), (5, "q")], "i int, p string")
    right = spark.createDataFrame([("x-abcdefghi",), ("a-abc",), (None,), ("qq",)], "n string")
    assert rows(merge.contains_match(left, "i", "p", right, "n")) == [(1, "a-abc"), (2, "x-abcdefghi"), (5, "qq")]
    want = spark.createDataFrame([("t", "a.py"), ("t", "no.py")], "task string, file string")
    files = spark.createDataFrame([("t", "x/a.py"), ("t", "a.py"), ("t", "tests/no.py")], "task string, path string")
    assert rows(merge.basename_match(want, ["task"], "file", files, "path")) == [("t", "a.py", "a.py"), ("t", "no.py", None)]


def test_trial_rules(spark):
    df = spark.createDataFrame([({},), (None,), ({"a": "passed"},), ({"a": "passed", "b": "failed"},), ({"a": None},)], "m map<string,string>")
    assert [r[0] for r in df.select(trials.all_passed(F.col("m"))).collect()] == [True, False, True, False, False]
    f = spark.createDataFrame([(None, None, False), ("agent_timeout", "test_timeout", False), ("unset", "test_timeout", False), ("agent_timeout", None, True)], "a string, t string, p boolean")
    assert [r[0] for r in f.select(trials.settle_failure(F.col("a"), F.col("t"), F.col("p"))).collect()] == ["unset", "agent_timeout", "test_timeout", "parse_error"]
    k = spark.createDataFrame([(5, 0, 1), (5, 5, 1), (5, 2, 1), (5, 2, 5), (10, 3, 5)], "n int, c int, k int")
    got = [round(r[0], 6) for r in k.select(trials.pass_at_k(F.col("n"), F.col("c"), F.col("k"))).collect()]
    assert got == [0.0, 1.0, 0.4, 1.0, round(11 / 12, 6)]


@pytest.mark.parametrize("outcome,want", [("TFF", (3, 1, "learnable")), ("TTTTF", (4, 4, "too_easy")), ("FFFFF", (5, 0, "too_hard")), ("TTFTF", (5, 3, "learnable")), ("TF", (None, None, None)), ("TTF", (3, 2, None))])
def test_early_stop(spark, outcome, want):
    df = spark.createDataFrame([("t", i, c == "T") for i, c in enumerate(outcome)], "task string, seq int, ok boolean")
    r = trials.early_stop(df, "task", ["seq"], F.col("ok")).first()
    assert (r.decided_at, r.passes, r.decision) == want


def test_pass_at_k_against_subsets(spark):
    """The engine's estimate is the share of all subsets of k attempts that hold a pass, and grows with k."""
    from math import comb

    cases = [(n, c, k) for n in range(1, 9) for c in range(n + 1) for k in range(1, n + 1)] + [(2_000_000, 1_999_000, 4)]
    df = spark.createDataFrame(cases, "n long, c long, k long")
    got = {(r.n, r.c, r.k): r.p for r in df.select("*", trials.pass_at_k(F.col("n"), F.col("c"), F.col("k")).alias("p")).collect()}
    for n, c, k in cases:
        assert abs(got[n, c, k] - (1 - comb(n - c, k) / comb(n, k))) < 1e-12
        assert k == 1 or n > 9 or got[n, c, k - 1] <= got[n, c, k] + 1e-12


def test_tiers_and_rounds(spark):
    tier = "map<string, struct<passes: int, total: int, should_skip: boolean>>"
    df = spark.createDataFrame([(1, {"middle": (5, 5, True), "final": (1, 5, None)}), (2, {"middle": (1, 5, False), "final": (2, 5, None)}), (3, {"middle": (1, 3, None)})], f"k int, t {tier}")
    assert rows(trials.tier_cascade(df, "k", F.col("t"), ["weak", "middle", "final"])) == [(1, "middle", 5, 5), (2, None, 2, 5), (3, None, 1, 3)]
    r = spark.createDataFrame([("a", 1, "hard"), ("a", 2, "hard"), ("a", 3, "easy")], "k string, n int, l string")
    assert [x.overshot for x in trials.overshoots(r, "k", "n", "l").orderBy("n").collect()] == [False, False, True]
    m = spark.createDataFrame([("c", 1, False, 10), ("c", 2, True, 5), ("c", 3, False, 4), ("c", 4, True, 6)], "c string, n int, a boolean, t int")
    assert rows(trials.conversation_tokens(m, "c", "n", F.col("a"), F.col("t"))) == [("c", 10 + 19, 11)] == rows(trials.conversation_tokens(m, "c", "n", F.col("a"), F.col("t"), span=2))
    assert rows(spark.createDataFrame([("TimeoutError",), ("Odd",)], "e string").select(trials.failure_of(F.col("e"), {"TimeoutError": "agent_timeout"}))) == [("agent_timeout",), ("unknown_agent_error",)]


LOG = "noise\n===== short test summary info =====\nPASSED t.py::test_a\nFAILED t.py::test_b - assert 1 - 2 - boom\nSKIPPED t.py::test_c\nXPASS t.py::test_d\nERROR t.py::test_e\nXFAIL t.py::test_f\nFAILED t.py::test_a - again\nhello\n"


def test_scalars(spark):
    assert one(spark, LOG, S.test_log_results)[0] == {"test_a": "failed", "test_b - assert 1 - 2": "failed", "test_c": "passed", "test_d": "failed", "test_e": "failed", "test_f": "passed"}
    assert one(spark, "no summary", S.test_log_results)[0] is None
    long = "Fix a very long topic " * 6
    s = one(spark, long, S.slug)[0]
    assert len(s) <= 60 and s.startswith("fix-a-very-long-topic-fix") and one(spark, " A  b! ", S.slug)[0] == "a-b"
    assert one(spark, "a\nb\r\nc\rd\n", S.line_count, S.code_lines) == (4, 4)
    assert one(spark, "", S.line_count)[0] == 0
    assert one(spark, "def test_a():\n  def test_b():\nxdef test_c", S.test_functions)[0] == 2
    assert one(spark, "FROM x\nWORKDIR /a\n workdir /srv/b \n", S.work_dir)[0] == "/srv/b" and one(spark, "FROM x", S.work_dir)[0] == "/app"
    sh = "cat > /app/a.py << 'EOF'\nEOF\ncat > $X <<E\nE\necho \"x\" > /etc/b\n"
    assert one(spark, sh, lambda x: S.written_outside(x, F.lit("/app")))[0] == ["/etc/b"]
    assert one(spark, "20250102-030405", S.batch_epoch)[0] == 1735787045 and one(spark, "x", S.batch_epoch)[0] is None
    assert one(spark, 'say ```json\n{"a": {"b": 1}}\n``` bye', lambda x: F.to_json(S.fenced_json(x)))[0] == '{"a":{"b":1}}'
    assert one(spark, "{oops", lambda x: S.fenced_json(x).isNull())[0]
    for text, want in (("abc", ("aXc", 1)), ("abb", (None, 2)), ("ac", (None, 0))):
        assert tuple(one(spark, text, lambda x: S.replace_once(x, F.lit("b"), F.lit("X")))[0]) == want
    assert [one(spark, x, S.inferred_type)[0] for x in ("1", "true", "a b", "[1]")] == ["BIGINT", "BOOLEAN", "STRING", "ARRAY<BIGINT>"]
    assert one(spark, "x", lambda _: S.percent_text(F.lit(1), F.lit(0)), lambda _: S.percent_text(F.lit(1), F.lit(4)), lambda _: S.wave_timeout(F.lit(5), F.lit(900)), lambda _: S.retry_delay(F.lit(3)), lambda _: S.duration_text(F.lit(3725))) == ("- %", "25.0%", 1800, 40.0, "1h 02m")
    assert [one(spark, x, S.signs_failure)[0] for x in ("3 failed, 2 passed", "make: *** Error", "all good")] == [True, True, False]
    assert one(spark, "x", lambda _: S.money_text(F.lit(1.5)), lambda _: S.money_text(F.lit(0.001)), lambda _: S.reported_or(F.lit(0), F.lit(7)), lambda _: S.reported_or(F.lit(5), F.lit(7))) == ("$1.50", "$0.0010", 7, 5)
    assert one(spark, "abcdef", lambda x: S.tail(x, 3), lambda x: S.sectioned([(F.lit(True), "H: ", x), (F.lit(False), "N: ", x)])) == ("def", "H: abcdef")
    assert one(spark, "x", lambda _: S.pass_rate(F.lit(1), F.lit(0)), lambda _: S.pass_rate(F.lit(1), F.lit(3))) == (None, 0.3333)
    assert one(spark, "", lambda x: S.jaccard(S.letter_words(x), S.letter_words(x), 1.0), lambda x: S.jaccard(S.blank_words(x), S.blank_words(x)))== (1.0, 0.0)


TEXTS = ["find bugs in the parser now", "find in the parser now", "other words entirely here", "find bugs in the parser now", "", None, "Now! the parser: find BUGS in"]


def test_prefix_pairs_is_exact(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i long, t string").select("i", S.letter_words(F.col("t")).alias("w"))
    got = {(r.i_a, r.i_b) for r in diversity.prefix_pairs(df, "i", "w", 0.7).collect()}
    assert got == {(0, 1), (0, 3), (0, 6), (1, 3), (1, 6), (3, 6)}
    e = diversity.entropy(spark.createDataFrame([("a",), ("b",)], "c string"), "c").first().entropy
    assert e == 1.0 and diversity.entropy(spark.createDataFrame([("a",)], "c string"), "c").first().entropy == 0.0
    stats = diversity.length_stats(spark.createDataFrame([(1,), (2,), (3,), (10,), (None,)], "x int"), "x").first()
    assert (stats.upper_median, stats.median, stats.n) == (3, 2.5, 4)
    none = diversity.length_stats(spark.createDataFrame([(None,)], "x int"), "x").first()
    assert (none.least, none.upper_median, none.median, none.n) == (None, None, None, 0)
    files = spark.createDataFrame([("a", "x", "1"), ("a", "y", "2"), ("b", "y", "2"), ("b", "x", "1"), ("c", "x", "2")], "k string, p string, c string")
    d = {r.k: r.digest for r in diversity.content_digest(files, "k", "p", "c").collect()}
    assert d["a"] == d["b"] != d["c"] and len(d["a"]) == 16
    notes = spark.createDataFrame([("a", "x", "1"), ("a", "_bugs.md", "why"), ("a", "b", None)], "k string, p string, c string")
    assert rows(diversity.ordered_text(notes, "k", "p", "c")) == [("a", "**_bugs.md**\nwhy\n**x**\n1")]


def test_word_counts_hold_no_row_per_counter(spark):
    """The sketch reaches the driver packed, also where the session has Arrow off."""
    import tracemalloc

    import numpy as np

    from grainmill.operators.setjoin import word_counts

    arrow = "spark.sql.execution.arrow.pyspark.enabled"
    words = spark.range(150_000).select((F.col("id") % 100_000).cast("string").alias("w"))
    spark.conf.set(arrow, "false")
    tracemalloc.start()
    try:
        got = word_counts(words, 1 << 17)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        spark.conf.set(arrow, "true")
    at = words.select(F.pmod(F.xxhash64("w"), F.lit(1 << 17)).alias("i")).groupBy("i").count().collect()
    want = np.zeros(1 << 17, np.int32)
    for r in at:
        want[r["i"]] = r["count"]
    assert (got == want).all() and got.sum() == 150_000 and peak < 6e6
    assert word_counts(words.limit(0), 64).tolist() == [0] * 64


def test_cells_lose_no_pair(spark):
    import random

    rnd = random.Random(8)
    sets = [(i, sorted(rnd.sample("abcdefghij", rnd.randint(1, 6)))) for i in range(90)] + [(90, [])]
    df = spark.createDataFrame(sets, "i long, w array<string>").withColumn("k", F.lit("clash"))
    like = lambda x, y: len(set(x) & set(y)) / len(set(x) | set(y))
    want = {(i, j) for i, x in sets for j, y in sets if i < j and x and y and like(x, y) >= 0.7}
    for part in (1, 2048):  # parts of one row send every word over many cells
        got = [(r.i_a, r.i_b) for r in diversity.prefix_pairs(df, "i", "w", 0.7, part=part).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    new = spark.createDataFrame([(i, " ".join(w)) for i, w in sets[:40]] + [(40, None)], "n long, x string")
    old = spark.createDataFrame([(i, " ".join(w)) for i, w in sets[40:]] + [(99, None)], "o long, x string")
    texts, best = [(i, " ".join(w)) for i, w in sets[40:]], {}
    for i, w in sets[:40]:
        same = [j for j, x in texts if x == " ".join(w)]
        near = [(-like(w, x.split()), j) for j, x in texts if w and x and like(w, x.split()) >= 0.7]
        if same or near:
            best[i] = (min(same), "exact") if same else (min(near)[1], "similar")
    for part in (1, 2048):
        got = diversity.best_match(new, "n", old, "o", "x", S.blank_words, 0.7, part=part).collect()
        assert {r.n: (r.o, r.how) for r in got} == best and len(got) == len(best)


def test_ranks_are_exact(spark):
    import random
    import statistics

    from grainmill.operators.ranks import at_ranks, middle_ranks

    rnd = random.Random(2)
    vals = {"a": [rnd.gauss(0, 1) for _ in range(3001)], "b": [7.0] * 500 + [1.0], "c": [2.0], None: [3.0, 4.0]}
    df = spark.createDataFrame([(g, x) for g, v in vals.items() for x in v] + [("a", None), ("d", None)], "g string, v double").withColumn("n", F.lit("clash"))
    lo, hi = middle_ranks(F.col("n"))
    got = {r.g: r for r in at_ranks(df, ["g"], "v", {"lo": lo, "hi": hi, "last": F.col("n") - 1, "beyond": F.col("n")}).collect()}
    assert set(got) == set(vals)
    for g, v in vals.items():
        r = got[g]
        assert ((r.lo + r.hi) / 2, r.hi, r["last"], r.beyond, r.n) == (statistics.median(v), sorted(v)[len(v) // 2], max(v), None, len(v))
    assert at_ranks(df.limit(0), ["g"], "v", {"lo": lo}).count() == 0


def test_breaker_without_groups(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "bad"), (3, "ok"), (4, None)], "n int, s string")
    bad = F.coalesce(F.col("s") == "bad", F.lit(False))
    assert [r.skipped for r in merge.tripped(df, "n", bad).orderBy("n").collect()] == [False, False, True, True]
    assert not any(r.skipped for r in merge.tripped(df.where("n = 1"), "n", bad).collect())


def test_upserts_touch_their_buckets(spark, tmp_path):
    import os

    p = str(tmp_path / "t")
    keys = [(f"k{i}", 1, "old") for i in range(300)]
    sinks.upsert_latest(spark, spark.createDataFrame(keys, "k string, seq int, v string"), p, ["k"], ["seq"])
    first = {d for d in os.listdir(f"{p}/v0") if d.startswith("_bucket")}
    for n in (2, 3, 4):
        sinks.upsert_latest(spark, spark.createDataFrame([("k5", n, f"new{n}")], "k string, seq int, v string"), p, ["k"], ["seq"])
        assert len([d for d in os.listdir(f"{p}/v{n - 1}") if d.startswith("_bucket")]) == 1
    sinks.upsert_latest(spark, spark.createDataFrame([], "k string, seq int, v string"), p, ["k"], ["seq"])
    got = {r.k: r.v for r in sinks.read_latest(spark, p).collect()}
    assert got == {k: v for k, _, v in keys} | {"k5": "new4"}
    assert len({d for d in os.listdir(f"{p}/v0") if d.startswith("_bucket")}) == len(first) - 1  # only the version before the newest stays


def test_quality(spark):
    a = spark.createDataFrame([(1, 10, 1), (2, 20, None)], "k int, x int, y int")
    b = spark.createDataFrame([(3, 26, 1), (4, 30, 2)], "k int, x int, y int")
    assert rows(quality.outliers(b, a, "k", ["x", "y"]).select("k", "metric")) == [(3, "x"), (4, "x"), (4, "y")]
    gaps = quality.position_gaps(spark.createDataFrame([(1, [5, 1, 11]), (2, [3]), (3, [])], "k int, p array<bigint>"), "k", "p", F.lit(20))
    assert rows(gaps) == [(1, 6, 5.0, 0.5), (2, 0, 0.0, 0.0), (3, 0, 0.0, 0.0)]
    files = spark.createDataFrame([("t", "Dockerfile", "FROM x\n"), ("t", "tests/a.py", "def test_a(): pass\ndef test_b(): pass\n")], "k string, p string, c string")
    q = quality.task_quality(files, "k", "p", "c").first()
    assert (q.n_files, q.dockerfile_lines, q.solution_lines, q.n_tests, q.has_compose) == (2, 1, None, 2, False)


def test_sampling(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3], float(i % 5)) for i in range(60)], "i long, g string, w double")
    s1 = [r.i for r in sampling.weighted_sample(df, 10, "w", "i", seed=1).collect()]
    assert s1 == [r.i for r in sampling.weighted_sample(df.repartition(7), 10, "w", "i", seed=1).collect()] and all(i % 5 for i in s1)
    assert sampling.weighted_sample(df, 100, "w", "i").count() == 48
    rr = sampling.stratified_round_robin(df, 7, "g", "w", "i").groupBy("g").count().collect()
    assert sorted(r["count"] for r in rr) == [2, 2, 3]
    b = spark.createDataFrame([(1, "a", 9.0, 60), (2, "a", 8.0, 30), (3, "b", 1.0, 50), (4, "b", 0.5, 5), (5, "c", 5.0, 200)], "k long, g string, s double, z long")
    assert [sorted(r.k for r in sampling.budgeted(b, 100, "g", "s", "z", "k", wave=w).collect()) for w in (1, 2, 100)] == [[1, 2, 4]] * 3
    w = sampling.topic_weights(spark.createDataFrame([result(topic="a", cls="learnable"), result(topic="a", cls="learnable"), result(topic="b"), result(topic="c", ok=False, status="functional_failed"), result(topic="c", ok=False, status="functional_failed")], RESULT), spark.createDataFrame([("a", 1.0), ("b", 0.3), ("c", 1.0), ("d", None)], "topic string, old_weight double"), "topic")
    assert dict(rows(w)) == {"a": 1.0, "b": 0.3, "c": 0.05, "d": 1.0}


def test_validation(spark):
    files = [("ok", "task.yaml", "x"), ("ok", "Dockerfile", "FROM x\nWORKDIR /app"), ("ok", "run-tests.sh", "bash bash bash"), ("ok", "tests/test_a.py", ""), ("ok", "solution.sh", "echo 'x' > /application/y"), ("bad", "Dockerfile", "none"), ("bad", "solution.sh", "echo 'x' > /etc/y")]
    got = {r.k: r.issues for r in validate.task_files(spark.createDataFrame(files, "k string, p string, c string"), "k", "p", "c").collect()}
    assert got["ok"] == [] and set(got["bad"]) == {"missing file task.yaml", "missing file run-tests.sh", "no test module", "Dockerfile has no FROM", "writes outside the work directory"}
    t = spark.createDataFrame([("a", "x" * 50, "easy", "pytest", "c"), ("b", "x" * 49, "odd", " ", "c")], "k string, instruction string, difficulty string, parser_name string, category string")
    assert {r.k: r.issues for r in validate.task_rows(t, "k").collect()} == {"a": [], "b": ["missing parser_name", "invalid difficulty", "instruction shorter than 50"]}
    runs = spark.createDataFrame([("a", True)] * 3 + [("b", True)] * 2, "k string, p boolean")
    assert dict(rows(validate.deterministic(runs, "k", "p"))) == {"a": True, "b": False}
    assert one(spark, "x", lambda _: validate.size_findings(F.lit(3000), F.lit(61))[0], lambda _: validate.size_findings(F.lit(1500), F.lit(61))[1]) == (["image above 2048 MB"], ["image above 1024 MB", "tests take over 60 s"])


@pytest.mark.parametrize("removed,added,kind", [
    ("while i < n:", "while i <= n:", "off_by_one"), ("x = a[i]", "x = a[i - 1]", "off_by_one"), ("return a + b", "return a * b", "wrong_operator"), ("total = price", "total = cost", "wrong_variable"),
    ("print('a b c')", "print('a b d')", "wrong_variable"), ("t = 30", "t = 60", "wrong_constant"), ("foo()", "if x is None: return bar(y)", "missing_edge_case"), ("alpha", "beta gamma", "logic_change"),
])
def test_line_kinds(removed, added, kind):
    assert codefeatures.line_kind(removed, added) == kind


def test_code_features(spark):
    assert [(k, r, a) for _, k, r, a in codefeatures.hunks("a\nb\nc\n", "a\nB\nc\nd\n")] == [("wrong_variable", ["b"], ["B"]), ("missing_code", [], ["d"])]
    script = "cat > /app/m.py << 'EOF'\nx = 2\nEOF\necho \"hi\" > out.txt\necho 'no' >> log\ncat > $Y <<E\nE\n"
    assert codefeatures.script_files(script) == [("m.py", "x = 2\n"), ("out.txt", "hi\n")]
    files = spark.createDataFrame([("t", "m.py", "x = 1\n"), ("t", "solution.sh", script)], "k string, p string, c string")
    assert rows(codefeatures.solution_changes(files, "k", "p", "c").select("k", "file", "kind")) == [("t", "m.py", "off_by_one")]
    code = "import subprocess\ndef test_a_b():\n    'd'\n    assert 1 == 1\n    assert isinstance(1, int)\n    self.assertTrue(x)\ndef helper(): pass\n"
    t = codefeatures.test_features(spark.createDataFrame([("t", code), ("u", "def ("), ("v", None)], "k string, c string"), ["k"], "c").orderBy("k").collect()
    assert (t[0].n_tests, t[0].n_docstrings, t[0].n_descriptive, t[0].n_assertions, t[0].uses_subprocess) == (1, 1, 1, 3, True) and t[1].n_tests == t[2].n_tests == 0
    s = codefeatures.source_structure("m.py", "import os\nclass A:\n    def f(self):\n        if x:\n            for y in z: pass\n")[0]
    assert s == ("python", 5, 1, 1, 1, 2) and codefeatures.source_structure("d/m.py", "def f(): pass")[0] == ("python", 1, 0, 0, 0, 0)
    df = codefeatures.strip_commands(spark.createDataFrame([("apt-get x \\\n y\nrun\ncurl astral.sh/uv\n",), (None,)], "c string"), "c", ["apt-get "], ["astral.sh/uv"])
    assert [r.c for r in df.collect()] == ["run\n", None]
    empty = codefeatures.diff_rows(spark.createDataFrame([("k", "a", "a"), ("k", None, "b")], "k string, a string, b string"), ["k"], "a", "b")
    assert empty.count() == 0 and codefeatures.diff_summary(empty, ["k"]).count() == 0


def test_readers(spark, tmp_path):
    b = tmp_path / "out" / "sonnet-batch-1"
    b.mkdir(parents=True)
    (b / "batch-report.json").write_text(json.dumps({"results": [{"topic": "a", "classification": "learnable"}, {"topic": "b"}]}))
    (b / "incremental.jsonl").write_text('{"topic": "a"}\n\nbroken{\n{"topic": ""}\n')
    got = readers.read_reports(spark, str(tmp_path / "out/*/*-report.json"))
    assert rows(got.select("batch", "position", "topic", "classification")) == [("sonnet-batch-1", 0, "a", "learnable"), ("sonnet-batch-1", 1, "b", None)]
    lines = readers.read_json_lines(spark, str(tmp_path / "out/*/*.jsonl"), "topic string")
    assert lines.count() == 2 and rows(readers.completed_topics(lines)) == [("a",)]
    assert readers.read_json_lines(spark, str(tmp_path / "none/*.jsonl"), "topic string").count() == 0 and readers.read_reports(spark, str(tmp_path / "none*")).count() == 0
    assert readers.latest_file(spark, str(b / "*"), by_time=True).endswith("incremental.jsonl")
    r = tmp_path / "runs" / "t1"
    (r / "x1").mkdir(parents=True)
    (r / "x2").mkdir()
    (r / "x1" / "results.json").write_text('{"is_resolved": true, "parser_results": {"a": "passed"}}')
    (r / "x2" / "results.json").write_text("{bad")
    exp = spark.createDataFrame([("t1", "x1"), ("t1", "x2"), ("t1", "x3")], "task_dir string, trial_dir string")
    assert rows(readers.read_trials(spark, str(tmp_path / "runs/*/*/results.json"), exp).select("trial_dir", "is_resolved", "read_status")) == [("x1", True, "ok"), ("x2", None, "parse_error"), ("x3", None, "no_results")]
    t = tmp_path / "tasks" / "k"
    (t / "tests").mkdir(parents=True)
    for n in ("task.yaml", "_meta.yaml", "m.py", "tests/test_a.py"):
        (t / n).write_text("a: 1")
    files = readers.read_task_files(spark, str(tmp_path / "tasks"))
    assert rows(files.select("task_dir", "path")) == [("k", "m.py"), ("k", "task.yaml"), ("k", "tests/test_a.py")]
    assert readers.cohort(files).count() == 3 and readers.cohort(files.where("path != 'task.yaml'")).count() == 0
    assert rows(readers.source_files(files, ["task.yaml"]).select("path")) == [("m.py",)]


def test_yaml_and_selection(spark):
    pytest.importorskip("yaml")
    df = spark.createDataFrame([(1, "a: 1\nb: [x]"), (2, "- x"), (3, "a: ["), (4, None)], "k int, t string")
    got = readers.parse_yaml(df, ["k"], "t", "a int, b array<string>").orderBy("k").collect()
    assert (got[0].doc.a, got[0].doc.b) == (1, ["x"]) and [g.issue for g in got] == [None, "not a mapping", "unreadable", "not a mapping"]


def test_selection(spark):
    names = spark.createDataFrame([("ab",), ("ac",), ("b.c",)], "n string")
    assert rows(readers.chosen(names, "n", ["a*", "b.?"], ["?c"])) == [("ab",), ("b.c",)]
    with pytest.raises(ValueError):
        readers.chosen(names, "n", ["zz*"])
    readers.check_selection("p", None, None)
    for bad in (("p", "n", "1"), (None, None, None), (None, "n", None)):
        with pytest.raises(ValueError):
            readers.check_selection(*bad)
    runs = spark.createDataFrame([("run-1735787045",), ("run-1",), ("old-1600000000",)], "r string")
    assert rows(readers.live_runs(runs, "r", F.lit(1700000000)).select("r")) == [("run-1735787045",)]


def test_sinks(spark, tmp_path):
    a = spark.createDataFrame([("k", 1, "old"), ("m", 1, "x")], "k string, seq int, v string")
    p = str(tmp_path / "t")
    sinks.upsert_latest(spark, a, p, ["k"], ["seq"])
    sinks.upsert_latest(spark, spark.createDataFrame([("k", 2, "new"), ("m", 0, "late")], "k string, seq int, v string"), p, ["k"], ["seq"])
    assert rows(sinks.read_latest(spark, p).select("k", "v")) == [("k", "new"), ("m", "x")]
    sinks.append_lines(a, str(tmp_path / "log"))
    sinks.append_lines(a, str(tmp_path / "log"))
    assert readers.read_json_lines(spark, str(tmp_path / "log/*.json"), "k string").count() == 4
    sinks.write_report(a.groupBy("k").agg(F.count("*").alias("n")), a, "k", str(tmp_path / "rep"))
    assert {(r.k, r.metrics.n, len(r.results)) for r in spark.read.json(str(tmp_path / "rep")).collect()} == {("k", 1, 1), ("m", 1, 1)}
    assert rows(sinks.insert_new(spark.createDataFrame([("k",), ("z",), ("z",)], "k string"), a, "k")) == [("z",)]
    sinks.promote(a, a.where("k = 'k'"), "k", str(tmp_path / "cur"))
    assert rows(spark.read.parquet(str(tmp_path / "cur")).select("k")) == [("m",)]
    sinks.write_snapshots(a, str(tmp_path / "snap"), ["k"])
    sinks.write_document(a, str(tmp_path / "doc"))
    assert spark.read.json(str(tmp_path / "snap")).count() == spark.read.json(str(tmp_path / "doc")).count() == 2
    m = spark.createDataFrame([("t", {"a.py": '["x", "y"]', "../e": "1", "/abs": "2", "b": "raw"})], "k string, f map<string,string>")
    assert rows(sinks.task_file_rows(m, "k", "f")) == [("t", "a.py", "x\ny"), ("t", "b", "raw")]


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, seq int").write.json(str(src))
    s = live.stream_json(spark, str(src), "k string, seq int")
    live.append_to(s, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    live.append_to(s, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()  # a restart adds nothing
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    live.upsert_status(s, str(tmp_path / "st"), ["k"], ["seq"], str(tmp_path / "ck2")).awaitTermination()
    assert sinks.read_latest(spark, str(tmp_path / "st")).count() == 2
    c = live.RunningClass()
    assert [c.decide(*x) for x in ((1, 2), (4, 1), (0, 0), (0, 2))] == ["learnable", "too_easy", "too_hard", None]


def test_running_class_stream(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    rows_ = [("a", i, c == "T") for i, c in enumerate("TFF")] + [("b", i, True) for i in range(5)] + [("c", 0, True)]
    spark.createDataFrame(rows_, "task string, seq int, resolved boolean").coalesce(1).write.json(str(src))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    s = live.stream_json(spark, str(src), "task string, seq int, resolved boolean")
    live.append_to(live.running_class(s), out, str(tmp_path / "ck")).awaitTermination()
    assert rows(spark.read.parquet(out)) == [("a", 3, 1, "learnable"), ("b", 4, 4, "too_easy")]


def test_windowed_stream(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([("2025-01-01 00:10:00", "x"), ("2025-01-01 00:50:00", "x"), ("2025-01-01 01:10:00", "y")], "at string, k string").selectExpr("cast(at as timestamp) as at", "k").write.json(str(src))
    s = live.stream_json(spark, str(src), "at timestamp, k string")
    q = live.windowed_counts(s, "at", "k").writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.k, r.n) for r in spark.table("counts").collect()) == [("x", 2), ("y", 1)]


TAIL_SCHEMA = "attempt_id long, details struct<without_solution: struct<stdout_tail: string, stderr_tail: string>, with_solution: struct<stdout_tail: string, stderr_tail: string>>"


def test_test_logs_read_every_tail(spark, tmp_path):
    from grainmill.plans import inventory

    log = lambda line: f"noise\n=== short test summary info ===\n{line}\n1 failed"
    data = [(1, ((log("FAILED t.py::a - x"), log("PASSED t.py::b")), (log("PASSED t.py::a"), log("ERROR t.py::c")))), (2, (None, (log("PASSED t.py::a"), None))), (3, None)]
    spark.createDataFrame(data, TAIL_SCHEMA).write.parquet(str(tmp_path / "validation_attempts.parquet"))
    got = {tuple(r) for r in inventory.test_logs(spark, str(tmp_path)).select("attempt_id", "run", "stream_name", "test", "status").collect()}
    assert got == {
        (1, "without_solution", "stdout", "a", "failed"), (1, "without_solution", "stderr", "b", "passed"),
        (1, "with_solution", "stdout", "a", "passed"), (1, "with_solution", "stderr", "c", "failed"),
        (2, "with_solution", "stdout", "a", "passed"),
    }


def test_failure_signs_read_every_tail(spark, tmp_path):
    from grainmill.plans import inventory

    bad, ok = "1 failed, 2 passed", "all good"
    data = [(1, ((ok, bad), (ok, None))), (2, ((ok, ok), (bad, ok))), (3, ((None, None), (ok, bad))), (4, ((bad, ok), None)), (5, ((ok, None), (ok, ok))), (6, None)]
    spark.createDataFrame(data, TAIL_SCHEMA).write.parquet(str(tmp_path / "validation_attempts.parquet"))
    got = inventory.failure_signs_by_run(spark, str(tmp_path)).select("attempt_id", "failed_without", "failed_with", "failed").orderBy("attempt_id").collect()
    assert [tuple(r) for r in got] == [(1, True, False, True), (2, False, True, True), (3, False, True, True), (4, True, False, True), (5, False, False, False), (6, False, False, False)]


def test_negative_example_fits_the_rest(spark):
    df = spark.createDataFrame([(1, "a", 3.0, 60), (2, "b", 2.0, 30)], "k long, g string, s double, z long")
    chosen = sampling.budgeted(df, 100, "g", "s", "z", "k")
    bad = spark.createDataFrame([(9, 5), (7, 10), (8, 1)], "k long, z long")
    got = lambda budget, negatives: rows(sampling.with_negative(df, chosen, negatives, budget, "z", "k"))
    assert got(100, bad) == [(1, False), (2, False), (7, True)]
    assert got(99, bad) == got(100, bad.limit(0)) == got(2089, spark.createDataFrame([(7, None)], "k long, z long")) == [(1, False), (2, False)]
    assert got(2090, spark.createDataFrame([(7, None)], "k long, z long"))[-1] == (7, True)


def test_findings_in_both_directions(spark):
    data = [("learnable", 5.0, ["a", "a", "b"]), ("too_easy", 3.0, ["a"]), ("too_hard", 5.5, ["b", "b", "c"]), ("empty", 4.5, [])]
    avgs, dist = quality.class_patterns(spark.createDataFrame(data, "c string, m double, kinds array<string>"), "c", ["m"], "kinds")
    below = lambda other: rows(quality.findings(avgs, "c", "learnable", other, [("avg_m", "minus", 1.0)]))
    assert below("too_easy") == [("avg_m",)] and below("empty") == [] == below("too_hard")
    shares = lambda other: {r.kind: r.more_in for r in quality.share_findings(avgs, dist, "c", "learnable", other).collect()}
    assert shares("too_hard") == {"a": "learnable", "b": "too_hard", "c": "too_hard"}
    assert shares("empty") == {"a": "learnable", "b": "learnable"} and shares("absent") == {}


def test_header_counts(spark):
    data = [("completed", "learnable", 2.0), ("completed", "too_hard", 1.0), ("failed", None, None), ("functional", None, 1.0), ("pending", None, 0.0)]
    df = spark.createDataFrame(data, "stage string, classification string, cost double")
    assert rows(metrics.header_counts(df, F.col("stage"), F.col("cost"))) == [(5, 3, 1, 1, 1, 0, 1, 4.0)]
    assert rows(metrics.header_counts(df.where("stage = 'failed'"), F.col("stage"), F.col("cost"))) == [(1, 1, 0, 1, 0, 0, 0, 0.0)]


def test_task_diffs_hold_every_task(spark):
    write = lambda name, text: f"cat > {name} << 'EOF'\n{text}EOF\n"
    long = "x = 0\n" * 201
    data = [
        ("a", "m.py", "x = 1\ny = 2\nz = 3\n"), ("a", "solution.sh", write("m.py", "x = 2\ny = 2\nz = 4\n") + write("lost.py", "a\n") + write("test_m.py", "b\n")),
        ("b", "m.py", long), ("b", "solution.sh", write("m.py", long)),
        ("c", "m.py", "x\n"), ("d", "m.py", "x\n"), ("d", "solution.sh", "true\n"),
        *[("e", f"{n}.py", "x = 1\n") for n in "pqr"], ("e", "solution.sh", "".join(write(f"{n}.py", "x = 2\n") for n in "pqr")),
    ]
    got = {r.k: tuple(r)[1:] for r in codefeatures.task_diffs(spark.createDataFrame(data, "k string, p string, c string"), "k", "p", "c").collect()}
    assert got["a"] == (1, 2, 4, 3, [("m.py", 2, 2, 2)], ["not found: lost.py"])
    assert got["b"] == (0, 0, 0, 201, [], ["no file changed", "single region", "large source"])
    assert got["c"] == (None,) * 5 + (["no solution script"],) and got["d"] == (None,) * 5 + (["no file in the solution script"],)
    assert got["e"] == (3, 3, 6, 3, [("p.py", 1, 1, 1), ("q.py", 1, 1, 1), ("r.py", 1, 1, 1)], ["many files"]) and len(got) == 5
