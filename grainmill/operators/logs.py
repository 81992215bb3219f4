"""Semi-structured log text -> entries with time, level, component and message.

One Aho-Corasick automaton holds the level words and the literal anchors of all layouts. One pass
over a text retrieves, per line, the layouts whose anchor it holds beside a level word; only their
anchored expressions are then tried, and the first that verifies extracts the fields. After the known
layouts two open ones take any line that begins with a time and a level, in either order. Lines
without a header join the entry before them up to the next blank line. Runs inside Arrow batches, so
no shuffle is needed and text streams through.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.operators.timestamps import read_instants

#: Level words and letters of logging programs.
LEVELS = {
    "trace": "DEBUG", "trc": "DEBUG", "debug": "DEBUG", "dbg": "DEBUG",
    "info": "INFO", "inf": "INFO", "information": "INFO", "notice": "INFO",
    "warn": "WARNING", "warning": "WARNING", "wrn": "WARNING",
    "error": "ERROR", "err": "ERROR", "severe": "ERROR",
    "critical": "CRITICAL", "crit": "CRITICAL", "fatal": "CRITICAL", "ftl": "CRITICAL",
    "emerg": "CRITICAL", "alert": "CRITICAL", "panic": "CRITICAL",
}
LETTERS = {"D": "DEBUG", "I": "INFO", "W": "WARNING", "E": "ERROR", "C": "CRITICAL", "F": "CRITICAL"}

_A = r"(?:\x1b\[[0-9;]*m)*"  # colour codes
_L = rf"{_A}(?P<level>{'|'.join(sorted(LEVELS, key=len, reverse=True))})(?: |\x1b\[[0-9;]*m)*"
_D, _T = r"\d{4}-\d\d-\d\d", r"\d\d:\d\d:\d\d"
_Z = r"(?:Z|[+-]\d\d:?\d\d)?"
_C = r"(?P<component>[^\s\[\]():|]+)"
_M = r"(?P<message>.*)"
# parts of the open layouts: any printed time, what may stand between fields, a named logger
_ANY = rf"(?:\d{{4}}[-/]\d\d[-/]\d\d[T ]|\d\d/[A-Z][a-z]{{2}}/\d{{4}}[: ]|(?:[A-Z][a-z]{{2}} )?[A-Z][a-z]{{2}} [ \d]\d )?{_T}(?:[.,]\d+)? ?{_Z}|\d{{10}}(?:\.\d+)?|\d{{13}}|\d{{16}}"
_SEP = r"(?:[ \t]+(?:[|\-:][ \t]+)?|[|:][ \t]*)"
_NAMED = r"(?P<component>[A-Za-z_][\w.\-/]*)(?:\[\d+\]|:\d+)?"
#: layout -> (literal that every line of the layout holds, expression anchored at the line's start)
LAYOUTS: dict[str, tuple[str, str]] = {
    "iso_bracket": ("] ", rf"{_A}(?P<time>{_D}T{_T}(?:[.,]\d+)?{_Z}){_A} \[{_L}\] {_C}: {_M}"),
    "comma_dashes": (" - ", rf"{_A}(?P<time>{_D} {_T},\d+){_A} - (?P<component>\S+) - {_L} - {_M}"),
    "epoch_angle": ("] <", rf"{_A}\[(?P<time>\d{{9,19}}(?:\.\d+)?)\] <{_L}> (?P<component>\S+) :: {_M}"),
    "dotted_channel": ("] ", rf"{_A}\[(?P<time>{_D}[ T]{_T}(?:\.\d+)?{_Z})\] (?P<component>[^\s:]+)\.{_L}: {_M}"),
    "pipes": (" | ", rf"{_A}(?P<time>{_D} {_T}(?:[.,]\d+)?){_A} \| {_L}\| {_A}(?P<component>[^\s:|]+):[^\s:]+:\d+{_A} - {_M}"),
    "letter_file": ("] ", rf"(?P<letter>[DIWECF])(?P<time>\d{{4}} {_T}\.\d+) +\d+ (?P<component>[^\s:\]]+):\d+\] {_M}"),
    "syslog": ("]: ", rf"(?P<time>[A-Z][a-z]{{2}} [ \d]\d {_T}) \S+ (?P<component>[^\s\[\]]+)\[\d+\]: {_L}: {_M}"),
    "server": ("#", rf"(?P<time>\d{{4}}/\d\d/\d\d {_T}) \[{_L}\] \d+#\d+: {_M}"),
    "thread": (" [", rf"(?P<time>{_T}[.,]\d+) \[[^\]]+\] {_L}(?<= )(?P<component>\S+) - {_M}"),
    "level_first": (" (", rf"{_L}(?<= )(?P<time>{_D}T{_T}(?:[.,]\d+)?{_Z}) \((?P<component>[^\s()]+)\) {_M}"),
    "time_first": ("", rf"{_A}[\[(]?(?P<time>{_ANY}){_A}[\])]?{_SEP}(?:\[\d+\] )?[\[(<]?{_L}[\])>]?{_SEP}(?:{_NAMED}(?:: | - ))?{_M}"),
    "level_time": ("", rf"[\[(<]?{_L}[\])>]?{_SEP}[\[(]?(?P<time>{_ANY}){_A}[\])]?{_SEP}(?:{_NAMED}(?:: | - ))?{_M}"),
    "key_value": ("level=", r"(?P<pairs>(?:[A-Za-z_.@]+=(?:\"(?:[^\"\\]|\\.)*\"|\S*)(?:\s+|$))+)$"),
    "json": ("{", r"(?P<object>\{.*\})\s*$"),
}
_PAIR = re.compile(r'([A-Za-z_.@]+)=("(?:[^"\\]|\\.)*"|\S*)')
#: The keys that structured lines use for each field.
KEYS = {
    "time": ("ts", "time", "@timestamp", "timestamp", "datetime", "t"),
    "level": ("lvl", "level", "severity", "levelname", "log.level"),
    "component": ("logger", "component", "name", "module", "service", "logger_name", "source"),
    "message": ("msg", "message", "event", "text"),
}
_CLOCK = re.compile(r"\d\d:\d\d(:\d\d)?|^\d{9,19}(\.\d+)?$")
ENTRY = "first_line int, last_line int, layout string, log_time string, log_level string, component string, message string"


#: Layouts whose level isn't a word of the line.
_WORDLESS = ("letter_file",)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")  # keeps positions, unlike str.lower


def _automaton():
    """The literals with the layouts they route to; a level word sets the bit after the last layout."""
    import ahocorasick

    # a level word within another stands for both
    least = [w for w in LEVELS if not any(v != w and v in w for v in LEVELS)]
    a, masks = ahocorasick.Automaton(), {w: 1 << len(LAYOUTS) for w in least}
    for i, (anchor, _) in enumerate(LAYOUTS.values()):
        if anchor:
            masks[anchor] = masks.get(anchor, 0) | 1 << i
    for word, mask in masks.items():
        a.add_word(word, mask)
    a.make_automaton()
    return a


def _structured(pairs: dict) -> tuple[str, str, str, str] | None:
    got = {}
    for field, names in KEYS.items():
        got[field] = next((str(pairs[n]) for n in names if pairs.get(n) is not None), None)
    level = LEVELS.get((got["level"] or "").lower())
    if level is None or not got["time"] or not _CLOCK.search(got["time"]):
        return None
    return got["time"], level, got["component"] or "", got["message"] or ""


def _verify(name: str, expr: re.Pattern, line: str) -> tuple[str, str, str, str] | None:
    m = expr.match(line)
    if m is None:
        return None
    g = m.groupdict()
    if name == "json":
        try:
            pairs = json.loads(g["object"])
        except ValueError:
            return None
        return _structured(pairs) if isinstance(pairs, dict) else None
    if name == "key_value":
        return _structured({k: v[1:-1] if v[:1] == '"' else v for k, v in _PAIR.findall(g["pairs"])})
    level = LETTERS[g["letter"]] if g.get("letter") else LEVELS[g["level"].lower()]
    return g["time"], level, g.get("component") or "", g["message"]


class LogParser:
    """Routes lines to layouts through the automaton; ``entries`` parses one text."""

    def __init__(self) -> None:
        self.automaton = _automaton()
        self.word = 1 << len(LAYOUTS)
        bits = {name: 1 << i for i, name in enumerate(LAYOUTS)}
        self.open = sum(bits[name] for name, (anchor, _) in LAYOUTS.items() if not anchor)
        self.wordless = sum(bits[name] for name in _WORDLESS)
        self.layouts = [(name, re.compile(expr, re.IGNORECASE if name not in ("letter_file", "syslog") else 0)) for name, (_, expr) in LAYOUTS.items()]

    def entries(self, text: str) -> list[tuple]:
        lines = text.split("\n")
        starts, at = [], 0
        for line in lines:
            starts.append(at)
            at += len(line) + 1
        starts.append(at)
        routed: dict[int, int] = {}
        n = 0
        for end, mask in self.automaton.iter(text.translate(_LOWER)):  # in the order of their ends
            while starts[n + 1] <= end:
                n += 1
            routed[n] = routed.get(n, 0) | mask
        out: list[list] = []
        open_entry = False
        for n, line in enumerate(lines):
            mask, got = routed.get(n, 0), None
            mask = (mask | self.open) & ~self.word if mask & self.word else mask & self.wordless
            bare = line.rstrip("\r")
            while mask and got is None:
                low = mask & -mask
                mask ^= low
                name, expr = self.layouts[low.bit_length() - 1]
                if (got := _verify(name, expr, bare)) is not None:
                    out.append([n + 1, n + 1, name, *got])
                    open_entry = True
            if got is None:
                if not line.strip():
                    open_entry = False
                elif open_entry:
                    out[-1][1] = n + 1
                    out[-1][6] += "\n" + bare
        return [tuple(x) for x in out]


def entry_instant(time: Column, recorded: Column) -> Column:
    """The instant of a printed log time; no zone means UTC.

    A time without a year or a date is the latest such time that isn't after ``recorded`` (by more
    than a day, where only the year is missing); null where ``recorded`` is.
    """
    t = F.trim(time)
    day, clock = F.date_format(recorded, "yyyy-MM-dd"), r"\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?"
    short, yearless = t.rlike(rf"^{clock}$"), t.rlike(rf"^(\d{{4}}|([A-Z][a-z]{{2}} )?[A-Z][a-z]{{2}} [ \d]\d) {clock}$")
    with_year = F.regexp_replace(t, rf"^(\d\d)(\d\d) ({clock})$", "$1/$2/Y $3")
    with_year = F.regexp_replace(with_year, rf"^(?:[A-Z][a-z]{{2}} )?([A-Z][a-z]{{2}}) +(\d{{1,2}}) ({clock})$", "$2 $1 Y $3")
    dated = lambda back: F.regexp_replace(with_year, "Y", (F.year(recorded) - back).cast("string"))
    full = F.regexp_replace(t, r"^(\d\d)/([A-Z][a-z]{2})/(\d{4})[: ]", "$1 $2 $3 ")
    # the readings that may hold, one of which is chosen
    first = F.when(short, F.concat(day, F.lit(" "), t)).when(yearless, dated(0)).otherwise(full)
    read = read_instants([first, F.when(yearless, dated(1))])

    def choose(x: Column) -> Column:
        now, before = F.get(x, F.lit(0)), F.get(x, F.lit(1))
        ahead = F.when(short, now > recorded).otherwise(now > recorded + F.expr("interval 1 day"))
        return F.when(short & ahead, now - F.expr("interval 1 day")).when(yearless & (ahead | now.isNull()), before).otherwise(now)

    return F.get(F.transform(F.array(read), choose), F.lit(0))


def parse_log_entries(df: DataFrame, keys: Sequence[str], texts: dict[str, Column], recorded: str | None = None) -> DataFrame:
    """One row per log entry: ``keys``, stream_name, first_line, last_line, layout, log_time, log_level, component, message; with
    ``recorded``, the name of the time at which a text was written, also ``at``, the entry's instant (see ``entry_instant``).

    ``texts`` names the text columns to read. Lines count from 1, split at a line feed. A first line
    whose front was cut off matches no anchored expression and so starts no entry. Null and empty
    texts give no row; repeated rows give repeated entries; other columns are ignored. A text of any
    length is read whole.
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("stream_name"), c.alias("_text")) for k, c in texts.items()])
    when = [F.col(recorded).cast("timestamp").alias("_recorded")] if recorded else []
    rows = df.select(*[F.col(k) for k in keys], *when, F.inline(pairs)).where(F.col("_text").isNotNull() & (F.col("_text") != ""))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    held = [*keys, *(["_recorded"] if recorded else []), "stream_name"]
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in held) + ", " + ENTRY
    names = [x.split()[0] for x in ENTRY.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = LogParser()
        for b in batches:
            take, rows_out = [], []
            for i, text in enumerate(b.column("_text").to_pylist()):
                got = parser.entries(text)
                take += [i] * len(got)
                rows_out += got
            kept = b.select(held).take(pa.array(take, pa.int64()))
            cols = list(zip(*rows_out)) if rows_out else [()] * len(names)
            kinds_out = [pa.int32(), pa.int32()] + [pa.string()] * 5
            yield pa.RecordBatch.from_arrays([*kept.columns, *[pa.array(list(c), t) for c, t in zip(cols, kinds_out)]], names=[*held, *names])

    got = rows.mapInArrow(run, schema)
    return got.withColumn("at", entry_instant(F.col("log_time"), F.col("_recorded"))).drop("_recorded") if recorded else got
