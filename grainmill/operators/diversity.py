"""Coverage, entropy and set similarity of text collections, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions.scalars import jaccard
from grainmill.operators.ranks import at_ranks, middle_ranks
from grainmill.operators.setjoin import PARTS, hashes, near_rows, place, sent, sketch, sketch_width, where_counted, word_and_copy_counts
from grainmill.session import cut_lineage


def group_counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(F.coalesce(F.col(by), F.lit("unknown")).alias(by)).agg(F.count("*").alias("n"))


def entropy(df: DataFrame, by: str) -> DataFrame:
    """One row: normalised Shannon entropy of the groups' shares, 0 for one group or none."""
    n = df.groupBy(by).agg(F.count("*").alias("n"))
    # sum of n log n, sum of n and the number of groups give the entropy in one more partial aggregation
    got = n.agg(F.sum(F.col("n") * F.log2("n")).alias("s"), F.sum("n").alias("t"), F.count("*").alias("g"))
    h = (F.log2("t") - F.col("s") / F.col("t")) / F.log2("g")
    return got.select(F.col("g").alias("n_groups"), F.when(F.col("g") <= 1, 0.0).otherwise(h).alias("entropy"))


def coverage(df: DataFrame, by: str, expected: Sequence[str]) -> DataFrame:
    """One row: share of expected groups that occur, and the missing ones in order."""
    want = F.array_sort(F.array(*[F.lit(x) for x in expected]))
    # only expected values are collected: the array is bounded by their number
    found = df.where(F.col(by).isin(*expected)).agg(F.collect_set(by).alias("f"))
    return found.select((F.size(F.array_intersect("f", want)) / F.lit(float(len(expected)))).alias("coverage"), F.array_join(F.array_except(want, "f"), ",").alias("missing"))


def length_stats(df: DataFrame, x: str) -> DataFrame:
    """min, max, mean, upper median and true median of a numeric column, in one row; nulls are left out."""
    rows = df.select(F.lit(0).alias("g"), F.col(x).alias("x")).where("x is not null")
    lower, upper = middle_ranks(F.col("n"))
    ranked = at_ranks(rows, ["g"], "x", {"lo": lower, "hi": upper}).select("g", "lo", "hi")
    whole = df.agg(F.min(x).alias("least"), F.max(x).alias("greatest"), F.avg(x).alias("mean"), F.count(x).alias("n")).withColumn("g", F.lit(0))
    median = ((F.col("lo") + F.col("hi")) / 2).cast("double")
    return whole.join(ranked, "g", "left").select("least", "greatest", "mean", F.col("hi").cast("long").alias("upper_median"), median.alias("median"), "n")


def _copies_apart(rows: DataFrame, n_rows: int):
    """(the words' and the copies' counters as ``sent``, number of the words' counters, rows with, rows without a copy) of rows with ``hashes`` and ``copy``.

    The first hold all rows that have a copy and few others, told by the sketch; the second have none.
    """
    width = sketch_width(n_rows)
    counts = sent(rows.sparkSession, word_and_copy_counts(rows, width))
    at = (F.pmod("copy", F.lit(width)) + width).cast("int")
    return counts, width, where_counted(rows, at, counts, 2), where_counted(rows.select("rep", "side", "hashes", "copy"), at, counts, 0, 1).drop("copy")


def listed(rows: DataFrame, key: str, pairs: DataFrame, ends: Sequence[str]) -> DataFrame:
    """Rows whose key is an end of a pair, and few others: the keys reach the tasks as a sketch of bounded size, so the rest of the texts doesn't travel."""
    width = sketch_width(pairs.count())
    keys = pairs.select(F.explode(F.array(*ends)).alias("k")).select(place("k", width).alias("i"), F.lit(1).alias("n"))
    return where_counted(rows, place(key, width), sent(rows.sparkSession, sketch(keys, width, 1)), 1)


def prefix_pairs(sets: DataFrame, key: str, words: str, t: float, part: int = 2048) -> DataFrame:
    """key_a < key_b, similarity: pairs of rows whose word arrays (distinct) have Jaccard similarity >= t. ``key`` is a unique integer.

    Equal sets collapse to the row of the smallest key first; sets meet on a rare word of their prefixes, in
    bounded cells, where a bit test drops most; what is left is verified and classes' members are joined back.
    Words travel only of rows that have a copy or are candidates. Rows without words are in no pair.
    """
    kind = dict(sets.dtypes)[key]
    base = sets.where(F.size(words) > 0).select(F.col(key).cast("long").alias("rep"), F.col(words).alias("w"))
    rows = base.select("rep", F.lit(0).alias("side"), hashes("w").alias("hashes"), F.xxhash64(F.sort_array("w")).alias("copy"), "w")
    counts, width, some, alone = _copies_apart(rows, sets.count())
    some = some.select("rep", "w", F.substring(F.unhex(F.sha2(F.array_join(F.sort_array("w"), " "), 256)), 1, 16).alias("g"))
    cls = cut_lineage(some.groupBy("g").agg(F.min("rep").alias("rep"), F.first("w").alias("w"), F.count("*").alias("m")))
    every = alone.unionByName(cls.select("rep", F.lit(0).alias("side"), hashes("w").alias("hashes")))
    near = cut_lineage(near_rows(every, counts, width, t, False, part))
    texts = listed(base, "rep", near, ["rep_a", "rep_b"])
    side = lambda x: texts.select(F.col("rep").alias(f"rep_{x}"), F.col("w").alias(f"w{x}"))
    pairs = near.join(side("a"), "rep_a").join(side("b"), "rep_b").withColumn("similarity", jaccard(F.col("wa"), F.col("wb"))).where(F.col("similarity") >= t)
    # members of the classes of several rows, written once, as words are cut anew to find them; any other class is its row
    members = cut_lineage(some.select(F.col("rep").alias("k"), "g").join(cls.where("m > 1").select("g", "rep"), "g").select("k", "rep"))
    ma, mb = (members.select(F.col("rep").alias(f"rep_{x}"), F.col("k").alias(x)) for x in ("a", "b"))
    ends = F.least("a", "b").cast(kind).alias(f"{key}_a"), F.greatest("a", "b").cast(kind).alias(f"{key}_b")
    pairs = pairs.select("rep_a", "rep_b", "similarity").join(ma, "rep_a", "left").join(mb, "rep_b", "left")
    across = pairs.select(F.coalesce("a", "rep_a").alias("a"), F.coalesce("b", "rep_b").alias("b"), "similarity").select(*ends, "similarity")
    within = ma.join(mb, F.col("rep_a") == F.col("rep_b")).where("a < b").select(*ends, F.lit(1.0).alias("similarity"))
    return across.unionByName(within)


def best_match(new: DataFrame, new_key: str, corpus: DataFrame, corpus_key: str, text: str, words, t: float, part: int = 2048) -> DataFrame:
    """new_key, corpus_key, similarity, how: an exact copy (by digest) first, else the most similar corpus row >= t (ties: smallest key). Keys are integers, unique in their table.

    Copies on either side stand for one text until the end. Texts meet on rare words of their prefixes, in
    bounded cells; they travel only if they have a copy or are candidates, and word lists are made where they are read.
    """
    kinds = dict(new.dtypes)[new_key], dict(corpus.dtypes)[corpus_key]
    one = lambda d, key, side: d.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias("rep"), F.lit(side).alias("side"), F.col(text).alias("x"))
    n, c = one(new, new_key, 0), one(corpus, corpus_key, 1)
    word_hashes = hashes(words(F.col("x"))).alias("hashes")
    rows = n.unionByName(c).select("rep", "side", word_hashes, F.xxhash64("x").alias("copy"), "x")
    counts, width, some, alone = _copies_apart(rows, new.count() + corpus.count())
    some = some.select("rep", "side", "x", F.unhex(F.sha2("x", 256)).alias("h"))
    of = lambda side: F.min(F.when(F.col("side") == side, F.col("rep")))
    texts = cut_lineage(some.groupBy("h").agg(of(1).alias("ck"), of(0).alias("nk"), F.first("x").alias("x")))
    # a text of both sides is answered, and known to the others
    every = alone.unionByName(texts.select(F.coalesce("ck", "nk").alias("rep"), F.col("ck").isNotNull().cast("int").alias("side"), word_hashes))
    near = cut_lineage(near_rows(every, counts, width, t, True, part))
    hits = near.join(listed(n, "rep", near, ["rep_a"]).select(F.col("rep").alias("rep_a"), F.col("x").alias("xa")), "rep_a")
    hits = hits.join(listed(c, "rep", near, ["rep_b"]).select(F.col("rep").alias("rep_b"), F.col("x").alias("xb")), "rep_b")
    hits = hits.withColumn("similarity", jaccard(words(F.col("xa")), words(F.col("xb")))).where(F.col("similarity") >= t)
    best = hits.groupBy("rep_a").agg(F.max(F.struct("similarity", (-F.col("rep_b")).alias("neg"))).alias("m"))
    close = cut_lineage(best.select(F.col("rep_a").alias("nk"), (-F.col("m.neg")).alias("ck"), F.col("m.similarity").alias("similarity"), F.lit("similar").alias("how")))
    exact = texts.where("ck is not null and nk is not null").select("h", "ck", F.lit(1.0).alias("similarity"), F.lit("exact").alias("how"))
    shared = texts.where("ck is null").select("h", "nk").join(close, "nk").select("h", "ck", "similarity", "how", "nk")
    # copies of one new text are spread over parts when they take its match; its first row has it already
    spread = exact.withColumn("nk", F.lit(None).cast("long")).unionByName(shared).withColumnRenamed("nk", "has").withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    copies = some.where("side = 0").select(F.col("rep").alias("nk"), "h", F.pmod(F.xxhash64("rep"), F.lit(PARTS)).cast("int").alias("p"))
    copies = copies.join(spread, ["h", "p"]).where("has is null or has != nk")
    got = close.unionByName(copies.select(*close.columns))
    return got.select(F.col("nk").cast(kinds[0]).alias(new_key), F.col("ck").cast(kinds[1]).alias(corpus_key), "similarity", "how")


def content_digest(files: DataFrame, key: str, path: str, content: str) -> DataFrame:
    """16 hex digits over a directory's files in path order; a directory's files are bounded by nature."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col(path).alias("p"), F.sha2(F.col(content), 256).alias("h")))), lambda x: F.concat(x["p"], F.lit("\0"), x["h"]))
    return files.groupBy(key).agg(F.substring(F.sha2(F.array_join(ordered, "\n"), 256), 1, 16).alias("digest"))


def ordered_text(files: DataFrame, key: str, path: str, content: str, first: str = "_bugs.md") -> DataFrame:
    """key, text: a directory's files in path order under their names, the annotations file first; null contents are left out."""
    part = F.struct((F.col(path) != first).alias("later"), F.col(path).alias("p"), F.concat(F.lit("**"), F.col(path), F.lit("**\n"), F.col(content)).alias("t"))
    listed = F.transform(F.array_sort(F.collect_list(F.when(F.col(content).isNotNull(), part))), lambda x: x["t"])
    return files.groupBy(key).agg(F.array_join(listed, "\n").alias("text"))
