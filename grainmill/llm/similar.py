"""Near-duplicate texts by word-set similarity, exactly, without comparing all pairs.

1. Texts with equal word sets collapse to one class representative.
2. Prefix filter: under any fixed order of all words, two sets with similarity >= t share one of
   their first n - ceil(t n) + 1 words, so only sets that share such a word (a block) are compared.
   The order is rare words first, by a count sketch of fixed size that a partial aggregation builds
   and every task holds: words never travel to meet their frequency. Words counted once make no block.
3. Each set is folded into a fixed-width bit vector by exclusive-or of its words' bits. For two sets
   the population count of the exclusive-or never exceeds the size of the symmetric difference, and
   similarity >= t bounds that difference by (1 - t) / (1 + t) * (|a| + |b|). Blocks are compared in
   tiles, numpy exclusive-or and bit counts at a time; tile pairs whose set sizes lie too far apart
   are skipped. What passes is verified on the words themselves, so the result is exact. Block rows
   carry the bit vectors, not the words.
4. Blocks that may exceed ``tile`` sets are cut into cells of a range of set sizes and a salt, and every
   pair of cells within reach is a block of its own; no block gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.operators.setjoin import SMALL, near_pairs, near_sets, sent, sketch_width, tile_pairs, word_counts  # noqa: F401
from grainmill.session import cut_lineage

def word_set(text: Column) -> Column:
    """Distinct runs of a-z after lower-casing, sorted; null for a null text."""
    return F.sort_array(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("([a-z]+)"), F.lit(1))))


def word_classes(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(classes: rep, words, n_members), (members: id, rep). Null texts and texts without a word are left out."""
    base = df.select(F.col(key).cast("long").alias("id"), word_set(F.col(text)).alias("words")).where(F.size("words") > 0)
    base = base.withColumn("sig", F.substring(F.unhex(F.sha2(F.array_join("words", " "), 256)), 1, 16))
    classes = base.groupBy("sig").agg(F.min("id").alias("rep"), F.first("words").alias("words"), F.count("*").alias("n_members"))
    classes = cut_lineage(classes)
    members = base.select("id", "sig").join(classes.select("sig", "rep"), "sig").select("id", "rep")
    return classes.drop("sig"), members


def similar_classes(classes: DataFrame, t: float, tile: int = 2048, sketch: int | None = None) -> DataFrame:
    """rep_a < rep_b, similarity: all pairs of classes with similarity >= t. ``sketch``: counters of the word sketch, by default by the number of classes."""
    counts = sent(classes.sparkSession, word_counts(classes.select(F.explode("words").alias("w")), sketch or sketch_width(classes.count())))
    pairs = near_sets(classes.select("rep", "words"), None, counts, t, tile)
    a = classes.select(F.col("rep").alias("rep_a"), F.col("words").alias("wa"))
    b = classes.select(F.col("rep").alias("rep_b"), F.col("words").alias("wb"))
    both = F.size(F.array_intersect("wa", "wb"))
    exact = pairs.join(a, "rep_a").join(b, "rep_b").withColumn("similarity", both / (F.size("wa") + F.size("wb") - both))
    return exact.where(F.col("similarity") >= t - 1e-12).select("rep_a", "rep_b", "similarity")


def similar_pairs(df: DataFrame, key: str, text: str, t: float = 0.7) -> DataFrame:
    """id_a < id_b for every pair of rows whose word sets have similarity >= t.

    Null texts are in no pair, nor texts without a word; repeated texts pair with each other; an
    empty table gives no row; other columns are ignored. ``key`` must be a unique integer.
    """
    classes, members = word_classes(df, key, text)
    pairs = similar_classes(classes, t).select("rep_a", "rep_b")
    members = cut_lineage(members)
    a = members.select(F.col("id").alias("a"), F.col("rep").alias("rep_a"))
    b = members.select(F.col("id").alias("b"), F.col("rep").alias("rep_b"))
    across = pairs.join(a, "rep_a").join(b, "rep_b").select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))
    several = classes.where("n_members > 1").select(F.col("rep").alias("rep_a"))
    within = a.join(several, "rep_a", "left_semi").join(b, F.col("rep_a") == F.col("rep_b")).where("a < b").select(F.col("a").alias("id_a"), F.col("b").alias("id_b"))
    return across.unionByName(within)


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of an undirected edge list (a, b): label propagation with pointer jumping."""
    both = cut_lineage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        new = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = cut_lineage(new.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")))
        if new.where("label != old").isEmpty():
            return new.select("node", F.col("label").alias("component"))
        labels = new.drop("old")


def similar_groups(df: DataFrame, key: str, text: str, t: float = 0.7) -> DataFrame:
    """id, group_id, n_links: one row per row with a non-null text; n_links counts the similar rows."""
    classes, members = word_classes(df, key, text)
    pairs = cut_lineage(similar_classes(classes, t))
    comp = components(pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")))
    ends = pairs.select(F.col("rep_a").alias("rep"), F.col("rep_b").alias("other")).unionByName(pairs.select(F.col("rep_b").alias("rep"), F.col("rep_a").alias("other")))
    degree = ends.join(classes.select(F.col("rep").alias("other"), "n_members"), "other").groupBy("rep").agg(F.sum("n_members").alias("across"))
    info = classes.select("rep", "n_members").join(degree, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    info = info.select("rep", F.coalesce("component", "rep").alias("group_id"), (F.coalesce("across", F.lit(0)) + F.col("n_members") - 1).alias("n_links"))
    got = members.join(info, "rep").select("id", "group_id", "n_links")
    wordless = df.select(F.col(key).cast("long").alias("id"), F.size(word_set(F.col(text))).alias("n")).where("n = 0")
    return got.unionByName(wordless.select("id", F.col("id").alias("group_id"), F.lit(0).cast("long").alias("n_links")))
