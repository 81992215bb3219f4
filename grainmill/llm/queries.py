"""Queries of the llm problems over the project's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grainmill.llm.canonical import canonical_sql, canonical_text, look_alike_groups, look_alike_pairs
from grainmill.llm.mixing import mix
from grainmill.llm.packing import pack_items
from grainmill.llm.representative import VALUES, choose_rows, fuse, topic_key
from grainmill.llm.similar import similar_groups, similar_pairs
from grainmill.llm.tokens import token_counts
from grainmill.session import table

TEXTS = {"task": ("tasks", "task_key", "instruction"), "topic": ("topic_entries", "topic_id", "topic")}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of similar instructions and of similar topics."""
    parts = [similar_pairs(table(spark, d, t), k, c, 0.7).select(F.lit(kind).alias("kind"), "id_a", "id_b") for kind, (t, k, c) in TEXTS.items()]
    return parts[0].unionByName(parts[1]).distinct()


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    """Group and number of links of every instruction and topic; one with a null text is a group of its own."""
    parts = []
    for kind, (t, k, c) in TEXTS.items():
        df = table(spark, d, t)
        null = df.where(F.col(c).isNull()).select(F.col(k).cast("long").alias("id"), F.col(k).cast("long").alias("group_id"), F.lit(0).cast("long").alias("n_links"))
        parts.append(similar_groups(df, k, c, 0.7).unionByName(null).select(F.lit(kind).alias("kind"), F.col("id").alias("row_id"), "group_id", "n_links"))
    return parts[0].unionByName(parts[1])


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of documents that look the same but are stored differently."""
    return look_alike_pairs(table(spark, d, "documents"), "doc_id", "text").select(F.col("id_a").alias("doc_id_a"), F.col("id_b").alias("doc_id_b")).distinct()


def p9_groups(spark: SparkSession, d: str) -> DataFrame:
    """The group of every document with a text: its smallest document, its stored forms and the documents stored differently."""
    return look_alike_groups(table(spark, d, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


def p9_forms(spark: SparkSession, d: str) -> DataFrame:
    """The canonical form of every document and whether it changed."""
    got = canonical_text(table(spark, d, "documents"), "doc_id", "text")
    return got.select("doc_id", "canonical", (~F.col("text").eqNullSafe(F.col("canonical"))).alias("changed"))


def _results(spark: SparkSession, d: str) -> DataFrame:
    """Results with their group key; null topics (and null batches) belong to no group."""
    rows = table(spark, d, "pipeline_results").where("topic is not null and batch is not null")
    return rows.withColumn("topic_key", topic_key(F.col("topic")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Survivor and classification row of every group of results for one topic of a batch."""
    rows = _results(spark, d)
    got = choose_rows(rows, ["batch", "topic_key"], "result_id", "recorded_at", VALUES, F.coalesce(F.col("origin") == "report", F.lit(False)), "classification")
    return got.select("batch", "survivor_id", "class_row_id").distinct()


def p5_fused(spark: SparkSession, d: str) -> DataFrame:
    """The fused record of every group, by the two-sided quality model; issues keep every value judged true."""
    return fuse(_results(spark, d), ["batch", "topic_key"], "result_id", "recorded_at", "origin", [*VALUES, "status"], {"issues": F.col("stages.functional.issues")})


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return token_counts(table(spark, d, "documents"), ["doc_id", "source"], "text")


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    """The container of every document, or piece of one, for every capacity."""
    from grainmill.session import cut_lineage

    return pack_items(cut_lineage(_sizes(spark, d)), "doc_id", "n_tokens", table(spark, d, "pack_limits"), "limit_id", "capacity_tokens")


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens, unused share and share of items moved from their differencing window, per capacity."""
    per = p7_packed(spark, d).groupBy("limit_id", "container_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"), F.count_if("moved").alias("m"))
    packed = per.groupBy("limit_id").agg(F.count("*").alias("containers"), F.sum("t").alias("tokens"), (F.sum("m") / F.sum("n")).alias("moved_share"))
    unused = 1 - F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))
    return packed.join(table(spark, d, "pack_limits"), "limit_id").select("limit_id", "containers", "tokens", unused.alias("unused_share"), "moved_share")


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the packing of every capacity: all documents, no container above it, pieces that tile their text, splits only above it."""
    from grainmill.session import cut_lineage

    sizes = cut_lineage(_sizes(spark, d))
    packed = cut_lineage(pack_items(sizes, "doc_id", "n_tokens", table(spark, d, "pack_limits"), "limit_id", "capacity_tokens"))
    limits = table(spark, d, "pack_limits").select("limit_id", "capacity_tokens")
    loads = packed.groupBy("limit_id", "container_id").agg(F.sum("n_tokens").alias("t")).join(limits, "limit_id")
    loads = loads.groupBy("limit_id").agg(F.count_if(F.col("t") > F.col("capacity_tokens")).alias("overfull"))
    # a text's pieces are in order, the p-th begins after p whole containers, and their sizes add up to the text's
    texts = packed.groupBy("limit_id", "doc_id").agg(F.count("*").alias("pieces"), F.max("piece_no").alias("last"), F.sum("n_tokens").alias("t"), F.max("start_token").alias("s"))
    texts = texts.join(limits, "limit_id").join(sizes.select("doc_id", "n_tokens"), "doc_id")
    cap = F.col("capacity_tokens")
    torn = (F.col("t") != F.col("n_tokens")) | (F.col("pieces") != F.col("last") + 1) | (F.col("s") != F.col("last") * cap)
    texts = texts.groupBy("limit_id").agg(F.count("*").alias("documents"), F.count_if(torn).alias("torn"), F.count_if((F.col("pieces") > 1) & (F.col("n_tokens") <= cap)).alias("needless"))
    return texts.join(loads, "limit_id").select("limit_id", "documents", "overfull", "torn", "needless")


def p8_mixed(spark: SparkSession, d: str) -> DataFrame:
    """The chosen documents of every recipe in training order."""
    return mix(_sizes(spark, d), "doc_id", "source", "n_tokens", table(spark, d, "mix_targets"))[0].orderBy("recipe", "position", "doc_id", "pass_no")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of every source of every recipe."""
    return mix(_sizes(spark, d), "doc_id", "source", "n_tokens", table(spark, d, "mix_targets"))[1]


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of every recipe: its sources, none repeated beyond its cap, none missed, no share off by more than a document of each source."""
    from grainmill.session import cut_lineage

    sizes, targets = cut_lineage(_sizes(spark, d)), table(spark, d, "mix_targets")
    mixed, report = mix(sizes, "doc_id", "source", "n_tokens", targets)
    mixed = cut_lineage(mixed)
    caps = targets.groupBy("recipe", "source").agg(F.max("max_repeats").alias("r"), F.sum("target_share").alias("w"))
    used = mixed.groupBy("recipe", "source", "doc_id").agg(F.count("*").alias("n")).groupBy("recipe", "source").agg(F.max("n").alias("most"))
    tokens = mixed.groupBy("recipe", "source").agg(F.sum("n_tokens").alias("t"))
    held = sizes.where("source is not null").groupBy("source").agg(F.max("n_tokens").alias("longest"), F.sum("n_tokens").alias("held"))
    all_ = caps.join(held, "source", "left").join(used, ["recipe", "source"], "left").join(tokens, ["recipe", "source"], "left")
    live = F.coalesce(F.col("held") > 0, F.lit(False)) & (F.col("r") > 0) & (F.col("w") > 0)
    one = Window.partitionBy("recipe")  # the targets of a recipe
    off = F.abs(F.coalesce("t", F.lit(0)) - F.col("w") / F.sum(F.when(live, F.col("w"))).over(one) * F.sum("t").over(one))
    slack = F.sum(F.when(live, F.col("longest"))).over(one)
    all_ = all_.select("recipe", "source", (F.col("most") > F.col("r")).alias("over"), (live & F.col("t").isNull()).alias("missed"), (live & (off > slack)).alias("off"))
    got = all_.groupBy("recipe").agg(F.count("*").alias("sources"), *[F.count_if(c).alias(c) for c in ("over", "missed", "off")])
    late = mixed.groupBy("recipe").agg(F.count_if(~F.col("position").between(0, 1)).alias("outside"))
    rows = report.groupBy("recipe").agg(F.round(F.sum("actual_share"), 9).alias("share"))
    return got.join(late, "recipe").join(rows, "recipe").select("recipe", "sources", "over", "missed", "off", "outside", "share")


QUERIES = {
    "p2_found": p2_found,
    "p2_groups": p2_groups,
    "p5_found": p5_found,
    "p5_fused": p5_fused,
    "p7_packed": p7_packed,
    "p7_fill": p7_fill,
    "p7_checks": p7_checks,
    "p8_mixed": p8_mixed,
    "p8_shares": p8_shares,
    "p8_checks": p8_checks,
    "p9_found": p9_found,
    "p9_groups": p9_groups,
    "p9_forms": p9_forms,
}

_WORDS = "list_distinct(regexp_extract_all(lower({0}),'[a-z]+'))"


def _pairs_sql(kind: str) -> str:
    t, k, c = TEXTS[kind]
    rows = f"(select {k} as id, {_WORDS.format(c)} as w from {t} where {c} is not null)"
    return f"select '{kind}' as kind, a.id as id_a, b.id as id_b from {rows} a join {rows} b on a.id<b.id and len(a.w)>0 and len(list_intersect(a.w,b.w))>=0.7*(len(a.w)+len(b.w)-len(list_intersect(a.w,b.w)))"


def _groups_sql(kind: str) -> str:
    """Links of every text, and the smallest row that it reaches over them."""
    t, k, _ = TEXTS[kind]
    return f"""select '{kind}' as kind, n.id as row_id, least(n.id, coalesce(min(r.root), n.id)) as group_id, coalesce(any_value(l.n), 0)::bigint as n_links
 from (select {k} as id from {t}) n left join reached_{kind} r on r.id=n.id left join (select a, count(*) as n from links_{kind} group by a) l on l.a=n.id group by n.id"""


def _reach_sql(kind: str) -> str:
    return f"""links_{kind} as (select id_a as a, id_b as b from ({_pairs_sql(kind)}) union all select id_b, id_a from ({_pairs_sql(kind)})),
 reached_{kind} as (select distinct b as id, a as root from links_{kind} union select l.b, r.root from reached_{kind} r join links_{kind} l on l.a=r.id where r.root<l.b)"""


_PRESENT = " + ".join(f"(case when {c} is not null and trim({c}::varchar)<>'' then 1 else 0 end)" for c in VALUES)
_FORM = canonical_sql("text")
ORACLES = {
    "p2_found": _pairs_sql("task") + " union all " + _pairs_sql("topic"),
    "p2_groups": "with recursive " + ", ".join(map(_reach_sql, TEXTS)) + " " + " union all ".join(map(_groups_sql, TEXTS)),
    "p5_found": f"""with r as (select *, regexp_replace(lower(topic),'[^\\p{{L}}\\p{{N}}]','','g') as k, {_PRESENT} as n from pipeline_results where topic is not null and batch is not null),
 g as (select batch, k, first(result_id order by n desc, recorded_at desc nulls last, result_id desc) as survivor_id, coalesce(first(result_id order by (origin='report') desc, recorded_at desc nulls last, result_id desc) filter (trim(classification)<>''),-1) as class_row_id from r group by batch, k having count(*)>1)
 select batch, survivor_id, class_row_id from g""",
    "p7_checks": "select limit_id, (select count(*) from documents where text is not null) as documents, 0 as overfull, 0 as torn, 0 as needless from pack_limits",
    "p8_checks": "select recipe, count(distinct source) as sources, 0 as over, 0 as missed, 0 as off, 0 as outside, 1.0::double as share from mix_targets group by recipe",
    "p9_found": f"with f as (select doc_id, text, {_FORM} as form from documents where text is not null) select a.doc_id as doc_id_a, b.doc_id as doc_id_b from f a join f b on a.form=b.form and a.doc_id<b.doc_id and a.text<>b.text",
    "p9_groups": f"""with f as (select doc_id, text, {_FORM} as form from documents where text is not null),
 g as (select form, min(doc_id) as group_id, count(distinct text) as n_variants, count(*) as n from f group by form), s as (select text, count(*) as m from f group by text)
 select f.doc_id, g.group_id, g.n_variants, g.n - s.m as n_links from f join g on f.form=g.form join s on f.text=s.text""",
    "p9_forms": f"select doc_id, case when text is null then null else {_FORM} end as canonical, coalesce({_FORM}<>text, false) as changed from documents",
}
