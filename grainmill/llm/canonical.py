"""Visually identical text with different characters -> one consistent form.

DuckDB runs inside the Arrow partitions: one embedded SQL statement strips invisible characters,
maps width forms, kinds of blank and look-alike letters one to one (``translate``), opens joined
letters (``replace``) and composes accents (``nfc_normalize``). The tables are derived from the
Unicode database by rule; only the look-alike letters are a fixed list.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.session import cut_lineage

#: Letters of other scripts with the shape of a Latin letter.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V",
    "ο": "o", "α": "a", "ν": "v", "ρ": "p", "υ": "u", "ι": "i", "κ": "k", "χ": "x", "γ": "y",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ѐ": "è",
}
#: Invisible characters: soft hyphen, joiners, marks of direction, fillers, variation selectors, tags.
INVISIBLE = r"[\x{00AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{3164}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFA0}\x{E0000}-\x{E01EF}]"


def mappings() -> tuple[dict[str, str], dict[str, str]]:
    """(one to one, one to several) by rule: width forms, blanks, look-alikes with accents, joined letters."""
    one, several = {}, {}
    for code in range(0x80, 0x20000):
        ch = chr(code)
        kind = unicodedata.decomposition(ch).split(" ")[0]
        if unicodedata.category(ch) == "Zs":
            one[ch] = " "
        elif kind in ("<wide>", "<narrow>"):
            got = unicodedata.normalize("NFKC", ch)
            if len(got) == 1 and code != 0xFFA0:
                one[ch] = got
        elif kind == "<compat>" and unicodedata.category(ch)[0] == "L":
            got = unicodedata.normalize("NFKC", ch)
            if 1 < len(got) <= 3 and all(unicodedata.category(x)[0] == "L" for x in got):
                several[ch] = got
        elif ch in LOOK_ALIKES:
            one[ch] = LOOK_ALIKES[ch]
        elif not kind.startswith("<"):
            parts = unicodedata.normalize("NFD", ch)
            if parts[0] in LOOK_ALIKES and len(parts) > 1:  # an accented look-alike is the accented Latin letter, if there is one
                got = unicodedata.normalize("NFC", LOOK_ALIKES[parts[0]] + parts[1:])
                if len(got) == 1:
                    one[ch] = got
    return one, several


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def canonical_sql(column: str = "text") -> str:
    """The DuckDB expression of a column's canonical form."""
    one, several = mappings()
    e = f"regexp_replace({column}, '{INVISIBLE}', '', 'g')"
    for ch, got in several.items():
        e = f"replace({e}, {_quote(ch)}, {_quote(got)})"
    # composing first lets a decomposed look-alike meet its accented entry, composing last joins the rest
    return f"nfc_normalize(translate(nfc_normalize({e}), {_quote(''.join(one))}, {_quote(''.join(one.values()))}))"


def canonical_text(df: DataFrame, key: str, text: str, out: str = "canonical") -> DataFrame:
    """key, text, canonical form. Null stays null, empty stays empty; texts of any length are mapped whole."""
    rows = df.select(F.col(key).alias("_k"), F.col(text).alias("_t"))
    plain = canonical_sql("_t")
    # a text of printable ASCII is its own form; the other branch alone pays for the mapping
    statement = f"select _k, _t, case when regexp_full_match(_t, '[\\x00-\\x7F]*') then _t else {plain} end as _c from batch"
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "512MB"})
        con.execute("set preserve_insertion_order = true")
        for b in batches:
            con.register("batch", pa.Table.from_batches([b]))
            got = con.sql(statement).to_arrow_table()
            con.unregister("batch")
            yield from got.cast(pa.schema([("_k", b.schema.field("_k").type), ("_t", pa.string()), ("_c", pa.string())])).to_batches()

    got = rows.mapInArrow(run, f"_k {kinds['_k']}, _t string, _c string")
    return got.select(F.col("_k").alias(key), F.col("_t").alias(text), F.col("_c").alias(out))


#: Parts into which the copies of one stored text are spread when they meet their class again.
SALTS = 64


def _classes(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(members: id, stored, salt), (classes: form, stored, rep, n, salts): texts by digest, equal stored texts as one class.

    ``salts`` lists the parts that hold members of the class, so a class of one text meets one part
    and a class that holds a third of all rows meets every part.
    """
    got = canonical_text(df.where(F.col(text).isNotNull()), key, text)
    digest = lambda c: F.unhex(F.sha2(c, 256))
    salt = F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")
    rows = cut_lineage(got.select(F.col(key).alias("id"), digest(text).alias("stored"), digest("canonical").alias("form"), salt.alias("salt")))
    classes = rows.groupBy("form", "stored").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.collect_set("salt").alias("salts"))
    return rows.select("id", "stored", "salt"), classes


def look_alike_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """id_a < id_b: rows whose stored texts differ but share a canonical form. Only digests are shuffled.

    Distinct stored texts of one form pair first; their copies are attached to each side afterwards,
    so copies of one text never meet each other. Null texts are in no pair, nor rows with equal
    stored texts; empty tables give no row.
    """
    members, classes = _classes(df, key, text)
    several = classes.groupBy("form").agg(F.count("*").alias("_k")).where("_k > 1").select("form")
    classes = cut_lineage(classes.join(several, "form", "left_semi"))
    side = lambda s: classes.select("form", F.col("stored").alias(f"s{s}"), F.col("salts").alias(f"salts_{s}"))
    pairs = side("a").join(side("b"), "form").where("sa < sb").drop("form")
    for s in "ab":
        own = members.select(F.col("id").alias(f"id_{s}"), F.col("stored").alias(f"s{s}"), F.col("salt").alias(f"salt_{s}"))
        pairs = pairs.withColumn(f"salt_{s}", F.explode(f"salts_{s}")).join(own, [f"s{s}", f"salt_{s}"]).drop(f"s{s}", f"salt_{s}", f"salts_{s}")
    return pairs.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))


def look_alike_groups(df: DataFrame, key: str, text: str) -> DataFrame:
    """id, group_id, n_variants, n_links: one row per row with a text. The group's id is its smallest row, n_variants its
    distinct stored texts, n_links the rows stored differently. Null texts give no row."""
    members, classes = _classes(df, key, text)
    forms = classes.groupBy("form").agg(F.min("rep").alias("group_id"), F.count("*").alias("n_variants"), F.sum("n").alias("_n"))
    each = classes.join(forms, "form").select("stored", F.explode("salts").alias("salt"), "group_id", "n_variants", (F.col("_n") - F.col("n")).alias("n_links"))
    return members.join(each, ["stored", "salt"]).select("id", "group_id", "n_variants", "n_links")
