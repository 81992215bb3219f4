"""Every registered query against its SQL on the smallest tables; those without SQL must give rows of a stable schema."""

import duckdb
import pytest

from compare import TABLES, key


def load():
    from grainmill.plans import features, files, general, inventory

    modules = [general, inventory, files, features]
    return {k: f for m in modules for k, f in m.QUERIES.items()}, {k: s for m in modules for k, s in m.ORACLES.items()}


QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{data}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, data, con, name):
    df = QUERIES[name](spark, data)
    cols = sorted(df.columns)
    assert len(cols) == len(set(cols))
    got = key(tuple(r) for r in df.select(*cols).collect())
    if name in ORACLES:
        cur = con.execute(ORACLES[name])
        names = [x[0] for x in cur.description]
        assert sorted(names) == cols
        assert got == key(tuple(r[names.index(c)] for c in cols) for r in cur.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["topic_pairs", "unique_topics", "instruction_match", "instruction_revisions"])
def test_similarity_joins_write_little(spark, name, tmp_path):
    """What a similarity join writes stays within a small multiple of its texts; cells of all words, a row for each of 32 parts, did not."""
    t, c = ("topic_entries", "topic") if "topic" in name else ("tasks", "instruction")
    sc, d = spark.sparkContext, "/root/testdata/sf0.01"
    texts = spark.read.parquet(f"{d}/{t}.parquet").selectExpr(f"sum(octet_length({c}))").first()[0]
    before = sc.getCheckpointDir()
    try:
        sc.setCheckpointDir(str(tmp_path))
        df = QUERIES[name](spark, d)
        df.count()
        written = sum(p.stat().st_size for p in tmp_path.rglob("part-*"))
    finally:
        sc.setCheckpointDir(before) if before else None
    assert 0 < written < (4 if t == "topic_entries" else 2) * texts, written / texts


def _shuffled(spark, df):
    """Bytes that writing a frame shuffles."""
    sc = spark.sparkContext
    at = sc._jsc.sc()
    stages = lambda: {s.stageId(): s.shuffleWriteBytes() for s in _each(at.statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList()))}
    before = set(stages())
    df().write.format("noop").mode("overwrite").save()
    at.listenerBus().waitUntilEmpty(30_000)
    return sum(n for k, n in stages().items() if k not in before)


def _each(seq):
    return [seq.apply(i) for i in range(seq.size())]


@pytest.mark.parametrize("name, column, most", [("instruction_revisions", "instruction", 0.8), ("topic_pairs", "topic", 1.5)])
def test_similarity_joins_shuffle_little(spark, name, column, most):
    """Texts without a partner don't travel, nor do rows of frequent words that reach none."""
    t, d = ("topic_entries" if column == "topic" else "tasks"), "/root/testdata/sf0.1"
    texts = spark.read.parquet(f"{d}/{t}.parquet").selectExpr(f"sum(octet_length({column}))").first()[0]
    moved = _shuffled(spark, lambda: QUERIES[name](spark, d))
    assert 0 < moved < most * texts, moved / texts
