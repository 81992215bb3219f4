"""The llm operators against plain versions, and their edge cases."""

import re
import unicodedata

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compare import TABLES, key
from grainmill.llm import queries
from grainmill.llm.canonical import canonical_text, look_alike_groups, look_alike_pairs, mappings
from grainmill.llm.mixing import fill, largest, mix
from grainmill.llm.packing import differencing, pack, pack_items
from grainmill.llm.representative import choose_rows, fuse, topic_key
from grainmill.llm.similar import components, similar_groups, similar_pairs, word_classes, similar_classes
from grainmill.llm.tokens import token_counts
from grainmill.session import table


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def words(t):
    return frozenset(re.findall("[a-z]+", t.lower()))


def brute_pairs(items, t):
    ws = [(i, words(x)) for i, x in items if x is not None]
    ws = sorted((i, w) for i, w in ws if w)
    return {(a, b) for n, (a, x) in enumerate(ws) for b, y in ws[n + 1 :] if len(x & y) >= t * len(x | y)}


@pytest.mark.parametrize("kind", ["task", "topic"])
def test_p2_whole_tables(spark, data, kind):
    t, k, c = queries.TEXTS[kind]
    want = brute_pairs([tuple(r) for r in table(spark, data, t).select(k, c).collect()], 0.7)
    got = {(r.id_a, r.id_b) for r in queries.p2_found(spark, data).where(F.col("kind") == kind).collect()}
    assert got == want


def test_similar_edges(spark):
    import random

    rnd = random.Random(5)
    vocab = [c + d for c in "abcdefgh" for d in "xyz"]
    texts = [None, "", "123", "A-b!", "b a", "long " * 20_000 + "tail"] + [" ".join(rnd.sample(vocab, rnd.randint(1, 9))) for _ in range(120)]
    items = list(enumerate(texts))
    df = spark.createDataFrame(items, "k long, x string").withColumn("rep", F.lit("clash"))
    want = brute_pairs(items, 0.7)
    assert {(r.id_a, r.id_b) for r in similar_pairs(df, "k", "x", 0.7).collect()} == want
    # the hot path: tiny tiles send every block over size and salt tiles, with the same result
    classes, _ = word_classes(df, "k", "x")
    plain = {(r.rep_a, r.rep_b) for r in similar_classes(classes, 0.7).collect()}
    assert {(r.rep_a, r.rep_b) for r in similar_classes(classes, 0.7, tile=2).collect()} == plain
    # a sketch of three counters orders words badly and calls every block hot, with the same result
    assert {(r.rep_a, r.rep_b) for r in similar_classes(classes, 0.7, tile=4, sketch=3).collect()} == plain
    assert similar_pairs(df.limit(0), "k", "x").count() == 0
    g = {r.id: (r.group_id, r.n_links) for r in similar_groups(df, "k", "x", 0.7).collect()}
    assert set(g) == {i for i, x in items if x is not None}
    links = {i: 0 for i in g}
    for a, b in want:
        links[a] += 1
        links[b] += 1
        assert g[a][0] == g[b][0]
    assert {i: n for i, (_, n) in g.items()} == links


def test_small_blocks_together():
    """Blocks compared together give the pairs that tiles give one by one."""
    from grainmill.llm.similar import SMALL, near_pairs, tile_pairs

    rnd = np.random.default_rng(6)
    length = np.array([1, 2, SMALL, SMALL + 1, 5, 1, 30, 7])
    n = int(length.sum())
    sig, size = rnd.integers(0, 2**63, (n, 2)).astype(np.uint64) & np.uint64(0x0F0F), rnd.integers(4, 9, n)
    side = np.zeros(n, np.int32)
    side[-20:-10] = 1  # parts of the last two blocks
    want, s = set(), 0
    for k in length:
        at = s + np.argsort(size[s : s + k], kind="stable")
        both = (side[at] == 0).all()
        pairs = tile_pairs(sig, size, at, at, 0.3) if both else tile_pairs(sig, size, at[side[at] == 0], at[side[at] == 1], 0.3)
        fits = lambda i, j: min(size[i], size[j]) >= 0.3 * max(size[i], size[j]) - 1e-9
        if k <= SMALL:
            want |= {(min(i, j), max(i, j)) for x, y in pairs for i, j in zip(x.tolist(), y.tolist()) if fits(i, j)}
        s += k
    got = [(i, j) for x, y in near_pairs(sig, size, side, length, 0.3) for i, j in zip(x.tolist(), y.tolist())]
    assert len(got) == len(set(got)) and set(got) == want and want
    assert list(near_pairs(sig[:0], size[:0], side[:0], length[:0], 0.3)) == []


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(1, 12)] + [(20, 21)], "a long, b long")
    assert {r.node: r.component for r in components(e).collect()} == {**{i: 1 for i in range(1, 13)}, 20: 20, 21: 20}


def brute_choice(items):
    groups = {}
    present = lambda v: v is not None and str(v).strip() != ""
    for r in items:
        if r.topic is not None and r.batch is not None:
            groups.setdefault((r.batch, re.sub(r"[\W_]+", "", r.topic).lower()), []).append(r)
    out = set()
    for (b, _), v in groups.items():
        if len(v) > 1:
            s = max(v, key=lambda r: (sum(present(r[c]) for c in queries.VALUES), r.recorded_at, r.result_id))
            c = [r for r in v if present(r.classification)]
            out.add((b, s.result_id, max(c, key=lambda r: (r.origin == "report", r.recorded_at, r.result_id)).result_id if c else -1))
    return out


def test_p5_whole_table(spark, data):
    want = brute_choice(table(spark, data, "pipeline_results").drop("stages", "extra_stages").collect())
    assert {tuple(r) for r in queries.p5_found(spark, data).collect()} == want and want


PR = "g string, id long, at int, src string, v string, w string, many array<string>, n_rows string"


def test_representative_edges(spark):
    df = spark.createDataFrame([("a", 1, 5, "report", " ", "x", ["p"], ""), ("a", 2, 5, "log", "b", None, ["p", "q"], ""), ("a", 3, 5, "log", "c", "", None, ""), ("b", 4, 1, "log", "z", "z", [], ""), (None, 5, None, None, None, None, None, None), (None, 6, None, "log", None, None, None, None)], PR)
    got = rows(choose_rows(df.drop("n_rows"), ["g"], "id", "at", ["v", "w"], F.coalesce(F.col("src") == "report", F.lit(False)), "v"))
    assert got == [("a", 3, 3, 3), (None, 2, 6, -1)]
    assert choose_rows(df.limit(0), ["g"], "id", "at", ["v"], F.lit(True), "v").count() == 0
    assert one_key(spark, 'The "Topic", A-1') == "thetopica1"


def one_key(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(topic_key(F.col("t"))).first()[0]


def test_quality_model_finds_the_good_source(spark):
    import random

    rnd, data_, truth = random.Random(11), [], {}
    for g in range(400):
        truth[g] = "abcd"[g % 4]
        for i, (s, right) in enumerate((("good", 0.95), ("bad1", 0.3), ("bad2", 0.3))):
            v = truth[g] if rnd.random() < right else rnd.choice("wxyz")
            tags = [t for t in "mn" if rnd.random() < right] + ([f"junk{rnd.randint(0, 9)}"] if rnd.random() > right + 0.3 else [])
            data_.append((str(g), g * 3 + i, i, s, v, tags))
    df = spark.createDataFrame(data_, "g string, id long, at int, src string, v string, tags array<string>")
    got = {int(r.g): r for r in fuse(df, ["g"], "id", "at", "src", ["v"], {"tags": F.col("tags")}).collect()}
    right = sum(got[g].v == truth[g] for g in truth) / 400
    last = sum(r[4] == truth[int(r[0])] for r in data_ if r[3] == "bad2") / 400
    assert right > 0.9 > last  # far better than keeping the latest
    assert sum(set(r.tags or []) <= {"m", "n"} for r in got.values()) / 400 > 0.8
    assert fuse(df.limit(0), ["g"], "id", "at", "src", ["v"], {"tags": F.col("tags")}).count() == 0


def test_many_agreeing_sources(spark):
    # 999 sources say a, one says b, in each of 20 groups: the odds leave the range of a double
    df = spark.range(20 * 1000).select(
        (F.col("id") % 20).cast("string").alias("g"), "id", F.lit(1).alias("at"), F.concat(F.lit("s"), (F.col("id") / 20).cast("int").cast("string")).alias("src"),
        F.when(F.col("id") >= 19_980, "b").otherwise("a").alias("v"), F.when(F.col("id") < 19_980, F.array(F.lit("t"))).alias("tags"),
    )
    got = fuse(df, ["g"], "id", "at", "src", ["v"], {"tags": F.col("tags")}).collect()
    assert len(got) == 20 and all((r.v, r.tags) == ("a", ["t"]) for r in got)


def plain_model(items, single, multi, rounds=8):
    """The quality model record by record: items are (group, id, at, source, {field: [values]})."""
    import math
    from collections import defaultdict

    groups = defaultdict(list)
    for it in items:
        groups[it[0]].append(it)
    facts = []  # group, field, value, sources that state it, sources of the group
    for g, its in groups.items():
        there = {i[3] for i in its}
        for f in [*single, *multi]:
            said = defaultdict(set)
            for i in its:
                for v in i[4].get(f, []):
                    said[v].add(i[3])
            facts += [(g, f, v, c, there) for v, c in said.items()]

    def quality(p, pool=False):
        n = defaultdict(lambda: [0.0] * 4)
        for k, x in p.items():
            _, f, _, claims, there = facts[k]
            for s in there:
                a = n[s if pool else (f, s)]
                a[0] += x
                a[2] += 1 - x
                if s in claims:
                    a[1] += x
                    a[3] += 1 - x
        return {k: ((a[1] + 4) / (a[0] + 6), (a[2] - a[3] + 8) / (a[2] + 10)) for k, a in n.items()}

    def odds(k, q):
        _, f, _, claims, there = facts[k]
        return sum(math.log(q[f, s][0] / (1 - q[f, s][1])) if s in claims else math.log((1 - q[f, s][0]) / q[f, s][1]) for s in there)

    ones = [k for k, x in enumerate(facts) if x[1] in single]
    units = defaultdict(list)
    for k in ones:
        units[facts[k][:2]].append(k)
    p = {}
    for ks in units.values():
        t = sum(len(facts[k][3]) for k in ks)
        p |= {k: 0.9 * len(facts[k][3]) / t for k in ks}
    for _ in range(rounds):
        q = quality(p)
        for ks in units.values():
            o = {k: math.exp(odds(k, q)) for k in ks}
            p |= {k: x / (sum(o.values()) + 0.1) for k, x in o.items()}
    others = [k for k, x in enumerate(facts) if x[1] in multi]
    pooled = quality(p, pool=True)
    q = {(facts[k][1], s): pooled.get(s, (0.5, 0.5)) for k in others for s in facts[k][4]}
    r = {k: 1 / (1 + math.exp(-odds(k, q))) for k in others}
    for _ in range(rounds // 2):
        base = {f: (sum(r[k] for k in others if facts[k][1] == f) + 1) / (sum(facts[k][1] == f for k in others) + 2) for f in multi}
        q = quality(r)
        r = {k: 1 / (1 + math.exp(-(odds(k, q) + math.log(base[facts[k][1]] / (1 - base[facts[k][1]]))))) for k in others}
    last = {}
    for g, i, at, _, vals in items:
        for f in single:
            for v in vals.get(f, []):
                last[g, f, v] = max(last.get((g, f, v), (at, i)), (at, i))
    out = {g: {} for g in groups}
    for (g, f), ks in units.items():
        out[g][f] = max(ks, key=lambda k: (round(p[k], 9), last[facts[k][:3]], facts[k][2]))
        out[g][f] = facts[out[g][f]][2]
    for k in others:
        if r[k] >= 0.5:
            out[facts[k][0]].setdefault(facts[k][1], []).append(facts[k][2])
    return out


def test_p5_fused_whole_table(spark, data):
    single = [*queries.VALUES, "status"]
    src = queries._results(spark, data)
    text = [F.trim(F.col(c).cast("string")).alias(c) for c in single]
    items = []
    for r in src.select("batch", "topic_key", "result_id", "recorded_at", "origin", F.col("stages.functional.issues").alias("issues"), *text).collect():
        vals = {c: [r[c]] for c in single if r[c]} | {"issues": [x for x in r.issues or [] if x is not None]}
        items.append(((r.batch, r.topic_key), r.result_id, r.recorded_at, r.origin or "", vals))
    want = plain_model(items, single, ["issues"])
    got = {(r.batch, r.topic_key): r for r in queries.p5_fused(spark, data).collect()}
    assert set(got) == set(want)
    # groups of more than two rows spread over tasks: the same result
    spread = fuse(src, ["batch", "topic_key"], "result_id", "recorded_at", "origin", single, {"issues": F.col("stages.functional.issues")}, hot=2)
    assert {(r.batch, r.topic_key): r for r in spread.collect()} == got
    for g, r in got.items():
        assert {c: r[c] for c in single if r[c] is not None} == {c: v for c, v in want[g].items() if c != "issues"}
        assert sorted(r.issues or []) == sorted(want[g].get("issues", []))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 100), max_size=60), st.integers(1, 20))
def test_differencing_and_pack(sizes, k):
    x = np.array(sizes, np.int64)
    if len(x):
        w = differencing(x, k)
        assert len(w) == len(x) and w.min() >= 0 and w.max() < max(k, 1)
    at, _ = pack(x, 100)
    assert len(at) == len(x)
    if x.sum():
        used = np.bincount(at[x > 0], weights=x[x > 0])
        used = used[used > 0]
        assert used.max() <= 100 and len(used) <= 2 * -(-x.sum() // 100)


def test_exchange_moves_single_items():
    from grainmill.llm.packing import exchange

    x, window = np.array([60, 45, 50, 40, 30, 20], np.int64), np.array([0, 0, 1, 1, 2, 2])
    at = exchange(x, window, 3, 100)  # 105, 90, 50: the 45 and the 40 change places
    assert np.bincount(at, weights=x).max() <= 100 and (at != window).sum() == 2
    stuck = np.array([60, 60], np.int64)
    assert exchange(stuck, np.array([0, 0]), 2, 50).tolist() == [0, 0] and exchange(x, window, 3, 200).tolist() == window.tolist()


def test_most_items_keep_their_differencing_window():
    x = np.random.default_rng(4).integers(20, 300, 1200)
    at, moved = pack(x, 2048)
    load = np.bincount(at, weights=x)
    assert load.max() <= 2048 and len(load) == -(-x.sum() // 2048) and moved.mean() < 0.2


def test_limits_in_blocks(spark):
    items = spark.createDataFrame([(i, 10 + i) for i in range(20)], "doc long, n int")
    limits = spark.createDataFrame([(i, 30 + i) for i in range(7)], "lid int, cap int")
    key_ = lambda df: sorted(tuple(r) for r in df.collect())
    assert key_(pack_items(items, "doc", "n", limits, "lid", "cap", at_once=2)) == key_(pack_items(items, "doc", "n", limits, "lid", "cap"))


def test_near_equal_windows():
    x = np.random.default_rng(1).integers(1, 50, 400)
    w = np.bincount(differencing(x, 10), weights=x)
    assert w.max() - w.min() <= 3


def test_pack_items_edges(spark):
    items = spark.createDataFrame([(1, 250), (2, 0), (3, None), (4, 100), (5, 30), (6, 30), (6, 30)], "doc long, n int").withColumn("limit", F.lit("clash")).withColumn("grp", F.lit(1))
    limits = spark.createDataFrame([(1, 100), (2, 1000), (3, None), (4, 0)], "lid int, cap int")
    got = pack_items(items, "doc", "n", limits, "lid", "cap").collect()
    for lid, cap in ((1, 100), (2, 1000)):
        own = [r for r in got if r.lid == lid]
        load, per = {}, {}
        for r in own:
            load[r.container_id] = load.get(r.container_id, 0) + r.n_tokens
            per[r.doc] = per.get(r.doc, 0) + r.n_tokens
        assert max(load.values()) <= cap and per == {1: 250, 2: 0, 4: 100, 5: 30, 6: 60}
        assert all(len({p.piece_no for p in own if p.doc == r.doc}) == 1 for r in own if r.doc not in (1,))
    assert sorted((r.piece_no, r.start_token, r.n_tokens) for r in got if r.lid == 1 and r.doc == 1) == [(0, 0, 100), (1, 100, 100), (2, 200, 50)]
    assert pack_items(items.limit(0), "doc", "n", limits, "lid", "cap").count() == 0
    assert pack_items(items, "doc", "n", limits.limit(0), "lid", "cap").count() == 0


def test_p7_whole_table(spark, data):
    sizes = {r.doc_id: r.n_tokens for r in token_counts(table(spark, data, "documents"), ["doc_id"], "text").collect()}
    per = {}
    for r in queries.p7_packed(spark, data).collect():
        per[(r.limit_id, r.doc_id)] = per.get((r.limit_id, r.doc_id), 0) + r.n_tokens
    assert per == {(lid, k): n for lid in (1, 2, 3, 4) for k, n in sizes.items()}
    assert all(r.unused_share < 0.2 for r in queries.p7_fill(spark, data).collect() if r.limit_id < 4)


def test_fill_and_largest():
    sizes, reps = {"a": 100, "b": 10, "c": 0}, {"a": 2, "b": 3, "c": 9}
    assert largest({"a": 0.5, "b": 0.5, "c": 1.0}, sizes, reps) == 60
    assert fill({"a": 0.5, "b": 0.5, "c": 1.0}, sizes, reps, 60) == {"a": 30.0, "b": 30.0}
    assert fill({"a": 0.5, "b": 0.5}, sizes, reps, 120) == {"b": 30.0, "a": 90.0}
    assert fill({"a": 1.0}, sizes, reps, 1e9) == {"a": 200.0} and fill({}, {}, {}, 5) == {}


def test_mix_edges(spark):
    docs = spark.createDataFrame([(i, "abc"[i % 3], 10 + i % 7) for i in range(900)] + [(900, None, 5), (901, "zz", 5), (902, "a", 0)], "doc long, src string, n int").withColumn("recipe", F.lit("clash"))
    t = spark.createDataFrame([("r", "a", 2.0, 3), ("r", "b", 1.0, 2), ("r", "c", 1.0, 1), ("r", "none", 1.0, 5), ("q", "a", 1.0, 1), (None, "b", 1.0, 1)], "recipe string, source string, target_share double, max_repeats int")
    mixed, report = mix(docs, "doc", "src", "n", t)
    rep = {(r.recipe, r.source): r for r in report.collect()}
    for s, share in (("a", 0.5), ("b", 0.25), ("c", 0.25)):
        assert abs(rep[("r", s)].actual_share - share) < 0.005
    assert rep[("r", "none")].tokens == 0 and rep[("q", "a")].documents in (300, 301)
    got = mixed.where("recipe = 'r'").collect()
    counts = {}
    for r in got:
        counts[(r.source, r.doc)] = counts.get((r.source, r.doc), 0) + 1
        assert 0 <= r.position <= 1
    assert all(n <= {"a": 3, "b": 2, "c": 1}[s] for (s, _), n in counts.items())
    assert len({(r.doc, r.pass_no) for r in got}) == len(got)
    assert mix(docs.limit(0), "doc", "src", "n", t)[0].count() == 0 and mix(docs, "doc", "src", "n", t.limit(0))[1].count() == 0


def test_schedule_moves_long_texts_later(spark):
    docs = spark.createDataFrame([(i, "s" if i % 2 else "l", 5 if i % 2 else 50) for i in range(4000)], "doc long, src string, n int")
    t = spark.createDataFrame([("r", "s", 0.5, 9), ("r", "l", 0.5, 9)], "recipe string, source string, target_share double, max_repeats int")
    m = mix(docs, "doc", "src", "n", t)[0]
    early = m.where("position < 0.5").groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()
    n = {r.source: r.n for r in early}
    assert abs(n["s"] / (n["s"] + n["l"]) - 0.625) < 0.02  # integral of 0.5 (1 + 0.5 (1 - 2x)) over the first half


def test_given_schedule(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], 10) for i in range(4000)], "doc long, src string, n int")
    t = spark.createDataFrame([("r", "a", 0.5, 1), ("r", "b", 0.5, 1)], "recipe string, source string, target_share double, max_repeats int")
    # source a only in the first half, then falling; b is not named and has no tilt against a
    s = spark.createDataFrame([("r", "a", 0.25, 1.0), ("r", "a", 0.75, 0.0), ("r", "x", 0.5, 1.0), (None, "a", 0.1, 1.0)], "recipe string, source string, at double, weight double")
    mixed, report = mix(docs, "doc", "src", "n", t, tilt=0.0, schedule=s)
    assert {(r.source, r.actual_share) for r in report.collect()} == {("a", 0.5), ("b", 0.5)}
    at = [r.position for r in mixed.where("source = 'a'").orderBy("position").collect()]
    # integral: 0.25 flat, then 0.25 along the slope
    assert max(at) <= 0.75 and abs(sum(x < 0.25 for x in at) / 2000 - 0.5) < 0.01 and abs(sum(x < 0.5 for x in at) / 2000 - (0.25 + 0.1875) / 0.5) < 0.01
    b = [r.position for r in mixed.where("source = 'b'").collect()]
    assert abs(sum(x < 0.5 for x in b) / 2000 - 0.5) < 0.01


def test_many_targets(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3000}", 4) for i in range(6000)], "doc long, src string, n int")
    t = spark.createDataFrame([(f"r{i // 3000}", f"s{i % 3000}", 1.0, 1) for i in range(12_000)], "recipe string, source string, target_share double, max_repeats int")
    mixed, report = mix(docs, "doc", "src", "n", t)
    assert mixed.count() == 24_000 and report.where("tokens = 8").count() == 12_000


PAIRS = [("ｆｉｌｅ", "file"), ("ﬁle", "file"), ("éa", "éa"), ("a​b", "ab"), ("a b", "a b"), ("сасe", "cace"), ("ё", "ë"), ("ё", "ë"), ("Αβ", "Aβ"), ("ｶﾞ", "ガ"), ("", "")]
APART = [("é", "e"), ("a b", "ab"), ("a  b", "a b"), ("0", "O"), ("a!", "a"), ("к", "k"), ("ß", "ss")]


def test_canonical_forms(spark):
    flat = [x for p in PAIRS + APART for x in p]
    df = spark.createDataFrame(list(enumerate(flat)) + [(999, None)], "k long, x string").withColumn("canonical", F.lit("clash"))
    c = {r.k: r.canonical for r in canonical_text(df, "k", "x").collect()}
    for n in range(len(PAIRS)):
        assert c[2 * n] == c[2 * n + 1], PAIRS[n]
    for n in range(len(PAIRS), len(PAIRS) + len(APART)):
        assert c[2 * n] != c[2 * n + 1], flat[2 * n]
    assert c[999] is None and canonical_text(df.limit(0), "k", "x").count() == 0
    again = spark.createDataFrame([(k, v) for k, v in c.items()], "k long, x string")
    assert {r.k: r.canonical for r in canonical_text(again, "k", "x").collect()} == c  # stable
    got = look_alike_pairs(df, "k", "x").collect()
    alike = {(i, j) for i in range(len(flat)) for j in range(i + 1, len(flat)) if c[i] == c[j] and flat[i] != flat[j]}
    assert {(0, 1), (0, 3), (1, 2), (2, 3)} <= alike and sorted(tuple(r) for r in got) == sorted(alike)


def test_copies_of_one_text_do_not_meet(spark):
    n = 30_000
    df = spark.range(n).select(F.col("id").alias("k"), F.lit("").alias("x")).unionByName(spark.createDataFrame([(n, "\u200b"), (n + 1, None)], "k long, x string"))
    pairs = look_alike_pairs(df, "k", "x")
    assert {tuple(r) for r in pairs.collect()} == {(i, n) for i in range(n)}
    # no operator of the plan puts out more rows than there are pairs and rows
    todo, most = [pairs._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        if "AdaptiveSparkPlan" in p.nodeName():
            p = p.executedPlan()
        if "QueryStage" in p.nodeName():
            p = p.plan()
        m = p.metrics().get("numOutputRows")
        most = max(most, m.get().value() if m.isDefined() else 0)
        todo += [p.children().apply(i) for i in range(p.children().size())]
    assert most <= n + 2
    g = {r.id: (r.group_id, r.n_variants, r.n_links) for r in look_alike_groups(df, "k", "x").collect()}
    assert len(g) == n + 1 and g[0] == (0, 2, 1) and g[n] == (0, 2, n)
    assert look_alike_groups(df.limit(0), "k", "x").count() == look_alike_pairs(df.limit(0), "k", "x").count() == 0


def test_mapping_tables():
    one, several = mappings()
    assert all(len(k) == len(v) == 1 for k, v in one.items()) and all(len(v) > 1 for v in several.values())
    assert one["　"] == " " and several["ﬃ"] == "ffi" and "é" not in one


def test_p9_whole_table(spark, data):
    one, several = mappings()
    drop = re.compile("[­͏؜​-‏‪-‮⁠-⁯︀-️﻿]")

    def form(t):
        t = drop.sub("", t)
        t = unicodedata.normalize("NFC", "".join(several.get(ch, ch) for ch in t))
        return unicodedata.normalize("NFC", "".join(one.get(ch, ch) for ch in t))

    groups = {}
    for r in table(spark, data, "documents").where("text is not null").select("doc_id", "text").collect():
        groups.setdefault(form(r.text), []).append((r.doc_id, r.text))
    want = {(min(a, b), max(a, b)) for v in groups.values() for a, x in v for b, y in v if a < b and x != y}
    assert {tuple(r) for r in queries.p9_found(spark, data).collect()} == want and want


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_sql(spark, data, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{data}/{t}.parquet')")
    df = queries.QUERIES[name](spark, data)
    cols = sorted(df.columns)
    cur = con.execute(queries.ORACLES[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    assert key(tuple(r[names.index(c)] for c in cols) for r in cur.fetchall()) == key(tuple(r) for r in df.select(*cols).collect())


def test_p2_groups_hold_null_texts(spark, tmp_path):
    texts = [(1, "fix the flask api"), (2, "fix the flask api"), (3, None), (4, None), (5, "12 34")]
    spark.createDataFrame(texts, "task_key long, instruction string").write.parquet(str(tmp_path / "tasks.parquet"))
    spark.createDataFrame(texts[:3], "topic_id long, topic string").write.parquet(str(tmp_path / "topic_entries.parquet"))
    got = sorted(tuple(r) for r in queries.p2_groups(spark, str(tmp_path)).select("kind", "row_id", "group_id", "n_links").collect())
    assert got == [("task", 1, 1, 1), ("task", 2, 1, 1), ("task", 3, 3, 0), ("task", 4, 4, 0), ("task", 5, 5, 0), ("topic", 1, 1, 1), ("topic", 2, 1, 1), ("topic", 3, 3, 0)]
