"""Schemas that drift between files: a column lifespan catalogue, the change log and one table.

The catalogue has a row per producer, file and field with the JSON types met; it is built by a
partial aggregation, so records never gather by producer. ``lag`` over a producer's files finds
where a field-type starts or ends; runs of unchanged field-types form islands (lifespans). An alias
table names the same field under other names and gives the casts of the one consistent table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainmill.functions.scalars import last_by_key
from grainmill.operators.timestamps import read_instants

#: The names under which producers print a field of the trial record.
ALIASES = {
    "is_resolved": ["resolved", "solved"],
    "agent_started_at": ["agent_start"],
    "agent_ended_at": ["agent_end"],
    "recording_path": ["cast_file"],
    "total_input_tokens": ["input_tokens", "prompt_tokens"],
    "total_output_tokens": ["output_tokens", "completion_tokens"],
    "parser_results": ["test_results", "unit_tests"],
}
TRIAL_FIELDS = ["id", "trial_name", "task_id", "instruction", "is_resolved", "failure_mode", "parser_results", "recording_path", "total_input_tokens",
                "total_output_tokens", "trial_started_at", "trial_ended_at", "agent_started_at", "agent_ended_at", "test_started_at", "test_ended_at"]
TYPES = ["boolean", "number", "string", "object", "array"]
#: Type of each field of the consistent table; fields not named here are text.
FIELD_TYPES = {"is_resolved": "flag", "parser_results": "statuses", "total_input_tokens": "count", "total_output_tokens": "count"} | {
    f: "instant" for f in TRIAL_FIELDS if f.endswith("_at")
}


def canonical_name(name: Column, fields: Sequence[str] = TRIAL_FIELDS, aliases: dict[str, list[str]] = ALIASES) -> Column:
    """The record's own name for a printed field name (by alias, or by camel case), else the printed name."""
    known = {a: f for f, names in aliases.items() for a in names}
    table = F.create_map(*[F.lit(x) for k, v in known.items() for x in (k, v)])
    snake = F.lower(F.regexp_replace(name, "([a-z0-9])([A-Z])", "$1_$2"))
    return F.when(name.isin(*fields), name).otherwise(
        F.coalesce(F.try_element_at(table, name), F.when(snake.isin(*fields), snake), F.try_element_at(table, snake), name)
    )


def field_catalogue(df: DataFrame, producer: Sequence[str], file: str, record: str) -> DataFrame:
    """producer, file, printed, field, kinds (bit set over TYPES; 0 when only nulls were met), n_records.

    A file without any valid record keeps one row with a null field, so that it counts as a file.
    Null, blank and broken lines don't count; rows with a null producer or file are in no stream;
    repeated lines change nothing but the count; an empty table gives an empty catalogue.
    """
    v = F.try_parse_json(F.col(record))
    rows = df.select(*producer, F.col(file).alias("_file"), v.alias("_v"))
    obj = F.when(F.schema_of_variant("_v").startswith("OBJECT"), F.col("_v"))
    rows = rows.select(*producer, "_file", obj.alias("_o"))
    rows = rows.select(*producer, "_file", F.explode_outer(F.map_entries(F.expr("cast(_o as map<string, variant>)"))).alias("_e"))
    shape = F.schema_of_variant(F.col("_e.value"))
    bit = (
        F.when(shape == "BOOLEAN", 1).when(shape == "STRING", 4).when(shape.startswith("OBJECT"), 8).when(shape.startswith("ARRAY"), 16)
        .when(F.col("_e.value").isNull() | (shape == "VOID"), 0).otherwise(2)
    )
    rows = rows.select(*producer, "_file", F.col("_e.key").alias("printed"), bit.alias("_bit"))
    got = rows.groupBy(*producer, "_file", "printed").agg(F.bit_or("_bit").alias("kinds"), F.count("printed").alias("n_records"))
    return got.select(*producer, F.col("_file").alias(file), "printed", canonical_name(F.col("printed")).alias("field"), "kinds", "n_records")


def footer_catalogue(files: DataFrame, producer: Sequence[str], file: str, path: str) -> DataFrame:
    """The same catalogue from parquet footers alone; no data page is read. ``files``: producer, file number or name, path.

    n_records are the rows of the file. Kinds of columns: text, times and bytes are strings, structs
    and maps are objects. A file that isn't parquet or is damaged keeps one row with a null field and, unlike
    a file without columns, null kinds and n_records: nothing is known of it. A path that can't be opened
    (missing, forbidden, of another file system) is an error and no result.
    """
    kinds = dict(files.dtypes)
    held = [*producer, file]

    def kind(t: pa.DataType) -> int:
        is_ = pa.types
        if is_.is_boolean(t):
            return 1
        if is_.is_struct(t) or is_.is_map(t):
            return 8
        if is_.is_list(t) or is_.is_large_list(t):
            return 16
        return 2 if is_.is_integer(t) or is_.is_floating(t) or is_.is_decimal(t) else 0 if is_.is_null(t) else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for b in batches:
            at, out = [], []
            for i, p in enumerate(b.column("_path").to_pylist()):
                try:
                    footer = pq.read_metadata(p.removeprefix("file://").removeprefix("file:"))
                    rows = [(f.name, kind(f.type), footer.num_rows) for f in footer.schema.to_arrow_schema()] or [(None, 0, footer.num_rows)]
                except (OSError, pa.ArrowInvalid) as e:
                    if getattr(e, "errno", None) is not None:  # the file system's answer; damaged content has no number
                        raise
                    rows = [(None, None, None)]
                at += [i] * len(rows)
                out += rows
            cols = list(zip(*out)) if out else [(), (), ()]
            made = [pa.array(list(c), t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*b.select(held).take(pa.array(at, pa.int64())).columns, *made], names=[*held, "printed", "kinds", "n_records"])

    rows = files.select(*held, F.col(path).alias("_path")).where(F.col("_path").isNotNull())
    got = rows.mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in held) + ", printed string, kinds int, n_records long")
    return got.select(*held, "printed", canonical_name(F.col("printed")).alias("field"), "kinds", "n_records")


def schema_changes(catalogue: DataFrame, producer: Sequence[str], file: str) -> DataFrame:
    """producer, file, field_name, change_kind: each change against the file before it.

    The catalogue is one row per file and field, far smaller than the data; a producer's files are
    windowed per field, so the largest group is one field's files.
    """
    files = catalogue.select(*producer, file).distinct()
    w = Window.partitionBy(*producer).orderBy(file)
    files = files.withColumns({"_no": F.row_number().over(w), "_prev": F.lag(file).over(w), "_next": F.lead(file).over(w)})
    fields = catalogue.where("field is not null").groupBy(*producer, file, "field").agg(
        F.sort_array(F.collect_set("printed")).alias("names"), F.bit_or("kinds").alias("kinds")
    )
    seen = fields.join(files, [*producer, file])
    f = Window.partitionBy(*producer, "field").orderBy("_no")
    seen = seen.withColumns({"_last": F.lag("_no").over(f), "_names": F.lag("names").over(f), "_kinds": F.lag("kinds").over(f), "_following": F.lead("_no").over(f)})
    goes_on = F.col("_last") == F.col("_no") - 1
    at = lambda kind, when, where: F.when(when, F.struct(where.alias("_at"), F.lit(kind).alias("change_kind")))
    here = F.col(file)
    changes = F.array_compact(
        F.array(
            at("added", F.col("_prev").isNotNull() & ~F.coalesce(goes_on, F.lit(False)), here),
            at("renamed", goes_on & (F.size(F.array_intersect("names", "_names")) == 0), here),
            at("retyped", goes_on & (F.col("kinds") > 0) & (F.col("_kinds") > 0) & (F.col("kinds") != F.col("_kinds")), here),
            at("removed", F.col("_next").isNotNull() & (F.col("_following").isNull() | (F.col("_following") != F.col("_no") + 1)), F.col("_next")),
        )
    )
    return seen.select(*producer, F.col("field").alias("field_name"), F.inline(changes)).select(*producer, F.col("_at").alias(file), "field_name", "change_kind")


def field_lifespans(catalogue: DataFrame, producer: Sequence[str], file: str) -> DataFrame:
    """Islands: producer, field, printed names, kinds, first_file, last_file, n_files of every unchanged stretch."""
    files = catalogue.select(*producer, file).distinct().withColumn("_no", F.row_number().over(Window.partitionBy(*producer).orderBy(file)))
    seen = catalogue.where("field is not null").groupBy(*producer, file, "field").agg(F.array_join(F.sort_array(F.collect_set("printed")), ",").alias("printed"), F.bit_or("kinds").alias("kinds"))
    seen = seen.join(files, [*producer, file])
    f = Window.partitionBy(*producer, "field").orderBy("_no")
    same = (F.lag("_no").over(f) == F.col("_no") - 1) & (F.lag("printed").over(f) == F.col("printed")) & (F.lag("kinds").over(f) == F.col("kinds"))
    seen = seen.withColumn("_new", F.when(same, 0).otherwise(1)).withColumn("_island", F.sum("_new").over(f))
    return seen.groupBy(*producer, "field", "_island", "printed", "kinds").agg(F.min(file).alias("first_file"), F.max(file).alias("last_file"), F.count("*").alias("n_files")).drop("_island")


def _statuses(text: Column) -> Column:
    """Test -> status, from an object or from a list of (test, status); the last of several entries for a test counts."""
    listed = F.from_json(text, "array<struct<test string, status string>>")
    named = F.filter(listed, lambda x: x["test"].isNotNull())
    return F.when(F.ltrim(text).startswith("["), last_by_key(named, "test", "status")).otherwise(F.from_json(text, "map<string,string>"))


def _flag(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.isin("true", "1", "1.0"), True).when(low.isin("false", "0", "0.0"), False)


def _count(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(F.get_json_object(text, "$.count"), text), ",", "").try_cast("long")


def _printed_number(text: Column) -> Column:
    """Numbers of a time may be printed with an exponent."""
    plain = text.try_cast("double").try_cast("decimal(38,6)").cast("string")
    return F.when(text.rlike(r"^[0-9.]+[eE]\+?[0-9]+$"), plain).otherwise(text)


CASTS = {"flag": _flag, "count": _count, "statuses": _statuses, "text": lambda text: text}


def consistent_table(df: DataFrame, keep: Sequence[str], record: str) -> DataFrame:
    """Every valid record under one schema: a column per field of the trial record, cast as the alias and type tables say.

    ``extra`` keeps, under their printed names and as JSON text, the other fields, values that their
    field's cast refuses, and further values of a field that a record holds under several names.
    Invalid lines give no row; a null under one name yields to a value under another.
    """
    v = F.try_parse_json(F.col(record))
    rows = df.select(*keep, v.alias("_v"))
    rows = rows.where(F.schema_of_variant("_v").startswith("OBJECT")).select(*keep, F.expr("cast(_v as map<string, variant>)").alias("_m"))
    entries = F.filter(F.map_entries("_m"), lambda e: e["value"].isNotNull() & (F.schema_of_variant(e["value"]) != "VOID"))
    named = F.transform(entries, lambda e: F.struct(canonical_name(e["key"]).alias("k"), e["key"].alias("p"), F.to_json(e["value"]).alias("j")))
    rows = rows.select(*keep, named.alias("_n"))
    first = lambda f: F.get(F.filter("_n", lambda e: e["k"] == f), F.lit(0))
    rows = rows.select(*keep, "_n", *[first(f).alias(f"_{f}") for f in TRIAL_FIELDS])
    # the value as text: strings lose their quotes, the rest stays JSON
    text = lambda f: F.get_json_object(F.concat(F.lit('{"v":'), F.col(f"_{f}.j"), F.lit("}")), "$.v")
    times = [f for f in TRIAL_FIELDS if FIELD_TYPES.get(f) == "instant"]
    rows = rows.withColumn("_times", read_instants([_printed_number(text(f)) for f in times]))
    typed = {f: F.get("_times", F.lit(times.index(f))) if f in times else CASTS[FIELD_TYPES.get(f, "text")](text(f)) for f in TRIAL_FIELDS}
    rows = rows.select(*keep, "_n", *[f"_{f}" for f in TRIAL_FIELDS], *[c.alias(f) for f, c in typed.items()])
    taken = F.array(*[F.when(F.col(f).isNotNull(), F.col(f"_{f}.p")) for f in TRIAL_FIELDS])
    others = F.filter("_n", lambda e: ~F.array_contains(F.array_compact(taken), e["p"]))
    return rows.select(*keep, *TRIAL_FIELDS, F.map_from_entries(F.transform(others, lambda e: F.struct(e["p"], e["j"]))).alias("extra"))
