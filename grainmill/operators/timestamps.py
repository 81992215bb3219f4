"""Mixed timestamp formats and zones -> one instant per value.

Every printed value is expanded, JVM-side, into an array of *all valid interpretations*
(day/month order, first or second occurrence of a repeated local hour, local or UTC reading,
ambiguous zone abbreviations). A Viterbi pass over each source's record order then picks one
interpretation per value, penalising format switches and backward time jumps.

Known conventions enter as prior costs. A prior larger than twice the largest transition cost can
never be outweighed by the two transitions a record takes part in, so such interpretations are
pruned exactly before the dynamic programme runs, and records with one interpretation left
split a source into independent runs.

Scale: a source's records are processed in blocks of a fixed span of the order key, so a source
that holds a third of all rows is spread over many tasks. Runs that touch a block's edge without
an unambiguous record are left open and settled in a second, much smaller pass per source.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.session import cut_lineage

#: Zone abbreviations and their offsets; several offsets make a value ambiguous.
ZONE_OFFSETS = {
    "UTC": ["+00:00"],
    "GMT": ["+00:00"],
    "UT": ["+00:00"],
    "EST": ["-05:00"],
    "EDT": ["-04:00"],
    "CST": ["-06:00", "+08:00"],
    "CDT": ["-05:00"],
    "MST": ["-07:00"],
    "MDT": ["-06:00"],
    "PST": ["-08:00"],
    "PDT": ["-07:00"],
    "WET": ["+00:00"],
    "WEST": ["+01:00"],
    "CET": ["+01:00"],
    "CEST": ["+02:00"],
    "EET": ["+02:00"],
    "EEST": ["+03:00"],
    "BST": ["+01:00"],
    "MSK": ["+03:00"],
    "IST": ["+05:30", "+02:00", "+01:00"],
    "JST": ["+09:00"],
    "KST": ["+09:00"],
    "AWST": ["+08:00"],
    "ACST": ["+09:30"],
    "AEST": ["+10:00"],
    "AEDT": ["+11:00"],
    "NZST": ["+12:00"],
    "NZDT": ["+13:00"],
}
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
SEP = "\u0001"
ZONE = r"(Z|z|[+-]\d{2}(?::?\d{2})?|[A-Za-z]{2,5}|\[[A-Za-z0-9_+/-]+\])?"
CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
#: kind -> (pattern, replacement listing year, first, second, hour, minute, second, fraction, am/pm, zone)
FORMATS = {
    "iso": (rf"^(\d{{4}})-(\d{{2}})-(\d{{2}})[Tt ]{CLOCK} ?{ZONE}$", ["$1", "$2", "$3", "$4", "$5", "$6", "$7", "", "$8"]),
    "slash": (rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}),? {CLOCK}(?: ?([AaPp][Mm]))? ?{ZONE}$", ["$3", "$1", "$2", "$4", "$5", "$6", "$7", "$8", "$9"]),
    "dot": (rf"^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}),? {CLOCK} ?{ZONE}$", ["$3", "$1", "$2", "$4", "$5", "$6", "$7", "", "$8"]),
    "compact": (r"^(\d{4})(\d{2})(\d{2})[-_Tt](\d{2})(\d{2})(\d{2})(?:\.(\d{1,9}))?(Z|z|[+-]\d{2}:?\d{2})?$", ["$1", "$2", "$3", "$4", "$5", "$6", "$7", "", "$8"]),
    "dmy_text": (rf"^(?:[A-Za-z]{{3}}, ?)?(\d{{1,2}})[ -]([A-Za-z]{{3,9}})[ -](\d{{4}}) {CLOCK} ?{ZONE}$", ["$3", "$2", "$1", "$4", "$5", "$6", "$7", "", "$8"]),
    "ctime": (rf"^[A-Za-z]{{3}} ([A-Za-z]{{3}}) +(\d{{1,2}}) {CLOCK}(?: ([A-Z]{{2,5}}))? (\d{{4}})$", ["$8", "$1", "$2", "$3", "$4", "$5", "$6", "", "$7"]),
}
CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}\+00:00$"
KINDS = ["epoch", *FORMATS]
AGAINST = 1000.0  # prior of an interpretation that a stated convention rules out


def _parts(v: Column, kind: str) -> Column:
    pattern, groups = FORMATS[kind]
    return F.split(F.regexp_replace(v, pattern, SEP.join(groups)), SEP, -1)


def _kind(v: Column) -> Column:
    """A cheap guess from a few characters, so that each value meets one regular expression."""
    return (
        F.when(F.substring(v, 5, 1) == "-", "iso")
        .when(v.rlike(r"^[0-9]{9,19}([.,][0-9]+)?$"), "epoch")
        .when(F.substring(v, 2, 2).contains("/"), "slash")
        .when(F.substring(v, 2, 2).contains("."), "dot")
        .when(F.substring(v, 1, 8).rlike(r"^\d{8}$"), "compact")
        .when(v.rlike(r"^[A-Za-z]{3} [A-Za-z]{3} "), "ctime")
        .otherwise("dmy_text")
    )


def _epoch_us(v: Column) -> Column:
    """Seconds, milliseconds, microseconds or nanoseconds, by the number of whole digits."""
    whole = F.regexp_extract(v, r"^(\d+)", 1)
    n = F.length(whole)
    unit = F.when(n <= 11, F.lit(1_000_000)).when(n <= 14, F.lit(1_000)).when(n <= 17, F.lit(1))
    frac = F.rpad(F.substring(F.regexp_extract(v, r"[.,](\d+)$", 1), 1, 6), 6, "0").try_cast("long")
    scaled = whole.try_cast("long") * unit
    return F.when(n >= 18, F.floor(whole.try_cast("decimal(20,0)") / 1000).cast("long")).when(
        n <= 11, scaled + F.coalesce(frac, F.lit(0))
    ).otherwise(scaled)


def _month(name: Column) -> Column:
    """The number of a printed month, by number or by the first letters of its English name."""
    low = F.lower(name)
    at = F.call_function("locate", F.substring(low, 1, 3), F.lit(MONTHS))
    return F.when(low.rlike("^[a-z]"), F.when((at > 0) & (at % 3 == 1), ((at + 2) / 3).cast("int"))).otherwise(name.try_cast("int"))


def read_instants(values: Sequence[Column], zone: Column | None = None) -> Column:
    """An array with the one reading of each printed time under fixed conventions: slashes month first (year first if it has four
    digits), dots day first, no zone means ``zone`` or UTC. Null where a value denotes no instant. One expression for all values."""
    zone = F.coalesce(zone if zone is not None else F.lit(None).cast("string"), F.lit("UTC"))
    names = F.create_map(*[F.lit(x) for k, z in ZONE_OFFSETS.items() for x in (k, z[0])])

    def pieces(x: Column) -> Column:
        out = None
        for kind in FORMATS:
            hit = x["k"] == kind
            out = F.when(hit, _parts(x["v"], kind)) if out is None else out.when(hit, _parts(x["v"], kind))
        return F.when(x.isNotNull(), F.struct(x["v"].alias("v"), x["k"].alias("k"), out.alias("p")))

    def build(x: Column) -> Column:
        part = lambda i: F.get(x["p"], F.lit(i))
        first, second = _month(part(1)), part(2).try_cast("int")
        dotted = x["k"] == "dot"
        month, day = F.when(dotted, second).otherwise(first), F.when(dotted, first).otherwise(second)
        hour, half = part(3).try_cast("int"), F.lower(part(7))
        hour = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "pm", 12).otherwise(0))
        sec = F.concat(F.coalesce(F.nullif(part(5), F.lit("")), F.lit("0")), F.lit("."), F.rpad(F.substring(part(6), 1, 6), 6, "0")).try_cast("decimal(16,6)")
        z, digits = part(8), F.regexp_replace(part(8), "[^0-9]", "")
        offset = F.concat(F.substring(z, 1, 1), F.substring(digits, 1, 2), F.lit(":"), F.rpad(F.substring(digits, 3, 2), 2, "0"))
        tz = F.when(z == "", zone).when(F.upper(z) == "Z", "+00:00").when(z.startswith("["), F.regexp_extract(z, r"^\[(.+)\]$", 1)).when(z.rlike("^[+-]"), offset)
        made = F.try_make_timestamp(part(0).try_cast("int"), month, day, hour, part(4).try_cast("int"), sec, F.coalesce(tz, F.try_element_at(names, F.upper(z))))
        return F.when(x.isNull(), None).when(x["k"] == "epoch", F.timestamp_micros(_epoch_us(x["v"]))).when(F.size(x["p"]) == 9, made)

    plain = F.transform(F.array(*values), lambda v: F.regexp_replace(F.trim(v), r"^(\d{4})/(\d{2})/(\d{2})", "$1-$2-$3"))
    kinded = F.transform(plain, lambda v: F.when(v.isNotNull(), F.struct(v.alias("v"), _kind(v).alias("k"))))
    return F.transform(F.transform(kinded, pieces), build)


def read_instant(value: Column, zone: Column | None = None) -> Column:
    """The reading of one value; see ``read_instants``."""
    return F.get(read_instants([value], zone), F.lit(0))


def interpretations(
    df: DataFrame,
    value: str,
    zone: str | None,
    slash_order: str | None = "mdy",
    dot_order: str | None = "dmy",
    local_zone: str | None = "host",
    repeated_hour: str | None = "first",
) -> DataFrame:
    """Adds ``cands``: array of (us, fmt, cost), every valid reading of ``value``.

    Conventions set to None are unknown: then both readings cost nothing and the sequence decides.
    Placeholders, impossible dates and nulls get an empty array.
    """
    df = df.withColumn("_v", F.trim(F.regexp_replace(F.col(value), r"^\s+|\s+$", "")))
    df = df.withColumn("_k", F.when(F.col("_v").isNotNull(), _kind(F.col("_v"))))
    pick = None
    for kind in FORMATS:
        hit = F.col("_k") == kind
        pick = F.when(hit, _parts(F.col("_v"), kind)) if pick is None else pick.when(hit, _parts(F.col("_v"), kind))
    df = df.withColumn("_p", pick)
    ok = F.size("_p") == 9
    p = lambda i: F.when(ok, F.get("_p", F.lit(i)))

    hour = p(3).try_cast("int")
    ampm = F.lower(p(7))
    hour = (
        F.when(ampm == "", hour)
        .when(hour.between(1, 12), hour % 12 + F.when(ampm == "pm", 12).otherwise(0))
    )
    df = df.select(
        "*",
        p(0).try_cast("int").alias("_y"),
        _month(p(1)).alias("_a"),
        _month(p(2)).alias("_b"),
        hour.alias("_h"),
        p(4).try_cast("int").alias("_mi"),
        (F.coalesce(F.nullif(p(5), F.lit("")), F.lit("0")).try_cast("int") * F.lit(1_000_000)
         + F.rpad(F.substring(p(6), 1, 6), 6, "0").cast("int")).alias("_us"),
        p(8).alias("_z"),
    ).drop("_p")

    z = F.col("_z")
    region = F.regexp_extract(z, r"^\[(.+)\]$", 1)
    digits = F.regexp_replace(z, "[^0-9]", "")
    offset = F.concat(F.substring(z, 1, 1), F.substring(digits, 1, 2), F.lit(":"), F.rpad(F.substring(digits, 3, 2), 2, "0"))
    names = F.create_map(*[F.lit(x) for k, v in ZONE_OFFSETS.items() for x in (k, ",".join(v))])
    host = F.col(zone) if zone else F.lit(None).cast("string")
    host = F.coalesce(F.nullif(F.trim(host), F.lit("")), F.lit("UTC"))
    zones = (
        F.when(z == "", F.array(host))
        .when(F.upper(z) == "Z", F.array(F.lit("+00:00")))
        .when(region != "", F.array(region))
        .when(z.rlike(r"^[+-]"), F.array(offset))
        .otherwise(F.split(F.try_element_at(names, F.upper(z)), ","))
    )
    df = df.withColumns({"_zs": zones, "_host": host})
    k, local = F.col("_k"), F.col("_z") == ""

    def instant(month: Column, day: Column, tz: Column) -> Column:
        # regions, unlike offsets, may skip or repeat a local hour; make_timestamp moves a skipped one forward
        return F.unix_micros(
            F.try_make_timestamp(F.col("_y"), month, day, F.col("_h"), F.col("_mi"), (F.col("_us") / F.lit(1e6)).cast("decimal(16,6)"), tz)
        )

    month = F.when(k == "dot", F.col("_b")).otherwise(F.col("_a"))
    day = F.when(k == "dot", F.col("_a")).otherwise(F.col("_b"))
    numeric = k.isin("slash", "dot")
    known = F.when(k == "slash", F.lit(slash_order is not None)).otherwise(F.lit(dot_order is not None))
    flip_base = {"slash": slash_order == "dmy", "dot": dot_order == "mdy"}
    flipped = F.when(k == "slash", F.lit(flip_base["slash"])).when(k == "dot", F.lit(flip_base["dot"])).otherwise(F.lit(False))
    m0, d0 = F.when(flipped, day).otherwise(month), F.when(flipped, month).otherwise(day)
    df = df.withColumns({"_m": m0, "_d": d0})
    m0, d0 = F.col("_m"), F.col("_d")
    first_zone = F.get("_zs", F.lit(0))
    df = df.withColumn("_c", F.when(k == "epoch", _epoch_us(F.col("_v"))).otherwise(instant(m0, d0, first_zone)))
    c = F.col("_c")
    fmt = F.concat(k, F.lit(":"), F.when(k == "epoch", F.length("_v").cast("string")).when(local, "local").when(z.rlike(r"^[+-]"), "offset").otherwise(F.upper(z)))
    df = df.withColumn("_f", F.xxhash64(fmt))
    f = F.col("_f")

    def cand(us: Column, shift: int, cost: Column | float) -> Column:
        cost = cost if isinstance(cost, Column) else F.lit(cost)
        return F.when(us.isNotNull(), F.struct(us.alias("us"), (f + F.lit(shift)).alias("fmt"), cost.cast("float").alias("cost")))

    # a repeated local hour: the instant one hour later prints the same local time
    later = F.expr("timestamp_micros(_c + 3600000000)")
    same_clock = F.from_utc_timestamp(later, F.col("_host")) == F.from_utc_timestamp(F.expr("timestamp_micros(_c)"), F.col("_host"))
    region_host = local & F.col("_host").contains("/")
    others = F.transform(
        F.slice("_zs", 2, 8),
        lambda x: F.struct(instant(m0, d0, x).alias("us"), (f + F.lit(7)).alias("fmt"), F.lit(1.0).cast("float").alias("cost")),
    )
    # an abbreviation with several offsets leans to the one the host keeps at that time
    cands = F.array_compact(
        F.array(
            cand(c, 0, 0.0),
            F.when(numeric & (m0 != d0), cand(instant(d0, m0, first_zone), 1, F.when(known, AGAINST).otherwise(0.0))),
            F.when(region_host & same_clock, cand(c + F.lit(3_600_000_000), 0, 0.5 if repeated_hour is None else AGAINST)),
            F.when(local & (F.col("_host") != "UTC"), cand(instant(m0, d0, F.lit("UTC")), 3, 0.5 if local_zone is None else AGAINST)),
        )
    )
    cands = F.when(F.size("_zs") > 1, F.concat(cands, F.filter(others, lambda x: x["us"].isNotNull()))).otherwise(cands)
    df = df.withColumn("cands", F.coalesce(cands, F.array()))
    return df.drop("_v", "_k", "_y", "_a", "_b", "_h", "_mi", "_us", "_z", "_zs", "_host", "_c", "_f", "_m", "_d")


def viterbi(us: Sequence[Sequence[int]], fmt: Sequence[Sequence[int]], cost: Sequence[Sequence[float]], switch: float, backward: float) -> list[int]:
    """The cheapest choice of one interpretation per record. Ties go to the earlier interpretation."""
    best = list(cost[0])
    back: list[list[int]] = []
    for t in range(1, len(us)):
        pu, pf, row, arrow = us[t - 1], fmt[t - 1], [], []
        for u, f, c in zip(us[t], fmt[t], cost[t]):
            x, at = min((best[i] + (switch if pf[i] != f else 0.0) + (backward if u < pu[i] else 0.0), i) for i in range(len(pu)))
            row.append(x + c)
            arrow.append(at)
        best, _ = row, back.append(arrow)
    at = min(range(len(best)), key=lambda i: (best[i], i))
    out = [at]
    for arrow in reversed(back):
        out.append(at := arrow[at])
    return out[::-1]


def _settle(seq: np.ndarray, us: list, fmt: list, cost: list, switch: float, backward: float) -> tuple[list[int], np.ndarray]:
    """Choice per record, and which records a neighbouring block may still decide.

    A run of ambiguous records ends at records with one interpretation; a run that reaches the first
    or last record of its sequence here stays open.
    """
    n, choice, is_open, i = len(us), [0] * len(us), np.zeros(len(us), bool), 0
    while i < n:
        if len(us[i]) == 1:
            i += 1
            continue
        j = i
        while j + 1 < n and seq[j + 1] == seq[i] and len(us[j + 1]) > 1:
            j += 1
        a = i - 1 if i > 0 and seq[i - 1] == seq[i] else i
        b = j + 1 if j + 1 < n and seq[j + 1] == seq[i] else j
        choice[a : b + 1] = viterbi(us[a : b + 1], fmt[a : b + 1], cost[a : b + 1], switch, backward)
        is_open[a : b + 1] = a == i or b == j
        i = j + 1
    return choice, is_open


def _decode(switch: float, backward: float):
    """Arrow batches sorted by sequence and order -> chosen readings; sequences may span batches."""
    limit = 2 * (switch + backward)

    def emit(t: pa.Table) -> Iterator[pa.RecordBatch]:
        t = t.filter(pa.compute.greater(pa.compute.list_value_length(t.column("cands")), 0))
        if not t.num_rows:
            return
        c = t.column("cands").combine_chunks()
        flat, offsets = c.values, c.offsets.to_numpy()
        us, fmt, cost = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("us", "fmt", "cost"))
        start, count = offsets[:-1], np.diff(offsets)
        us, fmt, cost = (x[offsets[0] : offsets[-1]] for x in (us, fmt, cost))
        start = start - offsets[0]
        row = np.repeat(np.arange(len(start)), count)
        live = np.flatnonzero(cost <= np.minimum.reduceat(cost, start)[row] + limit)
        head = np.searchsorted(row[live], np.arange(len(start) + 1))
        pick, is_open = live[head[:-1]].copy(), np.zeros(len(start), bool)
        many = np.diff(head) > 1
        seq = t.column("_seq").to_numpy()
        if many.any():  # only records at or beside an ambiguous one take part; the others are settled
            at = np.flatnonzero(many | np.append(many[1:], False) | np.insert(many[:-1], 0, False))
            parts = [live[head[x] : head[x + 1]] for x in at]
            gap = np.insert(np.cumsum(np.diff(at) > 1), 0, 0)
            key = np.unique(np.stack([seq[at], gap]), axis=1, return_inverse=True)[1].ravel()
            choice, opened = _settle(key, *[[x[p].tolist() for p in parts] for x in (us, fmt, cost)], switch, backward)
            # a gap between records of one sequence lies between two settled ones, so only true ends stay open
            pick[at], is_open[at] = [p[k] for p, k in zip(parts, choice)], opened
            is_open &= many
        edge = np.append(seq[1:] != seq[:-1], True) | np.insert(seq[1:] != seq[:-1], 0, True)
        beside = np.append(is_open[1:], False) | np.insert(is_open[:-1], 0, False)
        kept = pa.array(np.where(is_open, "o", np.where(edge | beside, "e", "s")))
        cands = t.column("cands").combine_chunks()
        cands = pa.compute.if_else(pa.array(is_open), cands, pa.scalar(None, cands.type))
        yield from pa.table(
            {**{k: t.column(k) for k in t.column_names if k not in ("cands", "_seq")}, "epoch_us": us[pick], "fmt": fmt[pick], "state": kept, "cands": cands}
        ).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]) if held is not None else t
            differs = np.flatnonzero(t.column("_seq").to_numpy() != t.column("_seq")[-1].as_py())
            cut = int(differs[-1]) + 1 if len(differs) else 0
            yield from emit(t.slice(0, cut))
            held = t.slice(cut)
        if held is not None:
            yield from emit(held)

    return run


def normalize_timestamps(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    zone: str | None,
    source: Sequence[str],
    order: str,
    switch_cost: float = 1.0,
    backward_cost: float = 2.0,
    block_span: int = 65_536,
    **conventions,
) -> DataFrame:
    """One row per value that denotes an instant: ``keys``, epoch_us, canonical (already in the canonical form).

    ``keys`` identify the value; ``source`` columns name the writer, ``order`` is an integral
    column giving its record order. Blocks of ``block_span`` of the order key bound a task's input.
    Null values, placeholders and impossible dates give no row; an empty table gives none; repeated
    rows give repeated rows; columns not named are ignored, whatever their names.
    """
    base = df.select(*keys, F.col(value).alias("_value"), (F.col(zone) if zone else F.lit(None).cast("string")).alias("_zone"),
                     F.xxhash64(*[F.coalesce(F.col(s).cast("string"), F.lit("\u0000")) for s in source]).alias("_src"), F.col(order).cast("long").alias("_ord"))
    base = base.where(F.col("_value").isNotNull())
    base = interpretations(base, "_value", "_zone", **conventions)
    base = base.withColumn("canonical", F.col("_value").rlike(CANONICAL)).drop("_value", "_zone")
    # no filter on cands here: pushed through the projections, it would unfold them exponentially
    return decode_sequences(base, keys, switch_cost, backward_cost, block_span)


def decode_sequences(base: DataFrame, keys: Sequence[str], switch_cost: float, backward_cost: float, block_span: int) -> DataFrame:
    """Viterbi over (_src, _ord) of a frame with ``cands``; see ``normalize_timestamps``.

    States of the first pass: s settled, e settled but the edge of a block or beside an open run,
    o open. The second pass reads the open runs, with the settled records around them as anchors.
    """
    blocked = base.withColumn("_seq", F.xxhash64("_src", F.floor(F.col("_ord") / block_span)))
    blocked = blocked.repartition("_seq").sortWithinPartitions("_seq", "_ord", *keys)
    kinds = {f.name: f.dataType.simpleString() for f in blocked.schema.fields}
    plain = [k for k in blocked.columns if k not in ("cands", "_seq")]
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in plain) + f", epoch_us long, fmt long, state string, cands {kinds['cands']}"
    run = _decode(switch_cost, backward_cost)
    first = cut_lineage(blocked.mapInArrow(run, schema))
    wanted = [*keys, "epoch_us", "canonical"]
    opened = first.where("state = 'o'")
    anchors = first.where("state = 'e'").join(opened.select("_src").distinct(), "_src", "left_semi")
    one = F.array(F.struct(F.col("epoch_us").alias("us"), F.col("fmt"), F.lit(0.0).cast("float").alias("cost")))
    rest = opened.withColumn("_anchor", F.lit(False)).unionByName(anchors.withColumns({"cands": one, "_anchor": F.lit(True)}))
    rest = rest.select(*plain, "_anchor", "cands", F.col("_src").alias("_seq"))
    rest = rest.repartition("_seq").sortWithinPartitions("_seq", "_ord", *keys)
    second = rest.mapInArrow(run, schema.replace(", epoch_us", ", _anchor boolean, epoch_us")).where("not _anchor")
    return first.where("state != 'o'").select(*wanted).unionByName(second.select(*wanted))
