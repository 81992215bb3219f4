"""Scalar functions as column expressions; all stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from grainmill.functions import fixed


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0 or null."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def percent_text(a: Column, b: Column) -> Column:
    """A percentage with one decimal, '- %' on a zero denominator."""
    return F.when(F.coalesce(b, F.lit(0)) == 0, "- %").otherwise(F.format_string("%.1f%%", 100.0 * a / b))


def slug(x: Column, most: int = 60, keep: int = 53, least: int = 26) -> Column:
    """Lower case, blanks to hyphens, other signs dropped; long slugs end in six digits of the text's SHA-256."""
    s = F.regexp_replace(F.lower(x), " ", "-")
    s = F.regexp_replace(F.regexp_replace(s, "[^a-z0-9-]", ""), "-+", "-")
    s = F.regexp_replace(s, "^-+|-+$", "")
    head = F.substring(s, 1, keep)
    cut = F.length(head) - F.instr(F.reverse(head), "-")
    head = F.when((F.instr(head, "-") > 0) & (cut >= least), F.substring(head, F.lit(1), cut)).otherwise(head)
    return F.when(F.length(s) > most, F.concat(head, F.lit("-"), F.substring(F.sha2(s, 256), 1, 6))).otherwise(s)


def short_slug(x: Column, n: int = 30) -> Column:
    """Slug of the first n characters, hyphens not collapsed."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.substring(x, 1, n)), " ", "-"), "[^a-z0-9-]", "")


def letter_words(x: Column) -> Column:
    """Distinct runs of a-z of the lower-cased text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit("([a-z]+)"), F.lit(1)))


def blank_words(x: Column) -> Column:
    """Distinct tokens between white space."""
    return F.array_distinct(F.filter(F.split(x, r"\s+"), lambda t: t != ""))


def jaccard(a: Column, b: Column, both_empty: float = 0.0) -> Column:
    """Shared over joint elements of two distinct arrays; ``both_empty`` where neither has any."""
    both = F.size(F.array_intersect(a, b))
    joint = F.size(a) + F.size(b) - both
    return F.when(joint == 0, F.lit(both_empty)).otherwise(both / joint)


LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"


def line_count(x: Column) -> Column:
    """Lines as a text editor counts them: an end of line closes a line, a rest without one counts."""
    parts = F.split(x, LINE_ENDS, -1)
    return F.size(parts) - F.when(F.element_at(parts, -1) == "", 1).otherwise(0)


def code_lines(x: Column) -> Column:
    """Lines that hold more than white space."""
    return F.size(F.filter(F.split(x, LINE_ENDS, -1), lambda t: t.rlike(r"\S")))


def test_functions(x: Column) -> Column:
    """Definitions of test functions at the start of a line."""
    return F.regexp_count(x, F.lit(r"(?m)^\s*def\s+test_"))


def file_language(path: Column) -> Column:
    """Language by file extension, 'unknown' otherwise."""
    table = F.create_map(*[F.lit(v) for pair in fixed.EXTENSIONS.items() for v in pair])
    return F.coalesce(F.try_element_at(table, F.lower(F.regexp_extract(path, r"(\.[A-Za-z0-9]+)$", 1))), F.lit("unknown"))


def first_match(x: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """The label of the first rule whose keyword occurs in the lower-cased text; the order of rules matters."""
    low, out = F.lower(x), None
    for word, label in rules:
        hit = low.contains(word)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def topic_language(x: Column) -> Column:
    return first_match(F.coalesce(x, F.lit("")), fixed.LANGUAGE_RULES, "unknown")


def known_or_topic_language(known: Column, x: Column) -> Column:
    """A language looked up beforehand, else by keyword without the rule for typescript; 'other' where none holds."""
    return F.coalesce(known, first_match(F.coalesce(x, F.lit("")), [r for r in fixed.LANGUAGE_RULES if r[0] != "typescript"], "other"))


def older_than(created: Column, now: Column, seconds: int = 1200) -> Column:
    """Whether something is past an age; null times are not."""
    return F.coalesce(F.unix_seconds(now) - F.unix_seconds(created) > seconds, F.lit(False))


def any_keyword(values: Column, words: list[str]) -> Column:
    """Whether any element of an array of texts holds any of the words, ignoring case."""
    return F.exists(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.coalesce(F.lower(v).rlike("|".join(words)), F.lit(False)))


def signs_failure(x: Column) -> Column:
    """Whether a terminal's output tells of failed tests; false for a null output."""
    return F.coalesce(x.rlike("(?i)" + "|".join(f"(?:{p})" for p in fixed.FAILURE_SIGNS)), F.lit(False))


def fenced_json(x: Column) -> Column:
    """The outermost braces of a reply, code fences stripped, as a variant; null where it is no JSON."""
    bare = F.regexp_replace(x, r"(?m)^```[A-Za-z]*\s*$", "")
    return F.try_parse_json(F.nullif(F.regexp_extract(bare, r"(?s)(\{.*\})", 1), F.lit("")))


def replace_once(x: Column, old: Column, new: Column) -> Column:
    """struct(text, n_matches): replaced only where ``old`` occurs exactly once."""
    n = F.when(F.length(old) > 0, (F.length(x) - F.length(F.replace(x, old, F.lit("")))) / F.length(old)).otherwise(0).cast("int")
    return F.struct(F.when(n == 1, F.replace(x, old, new)).alias("text"), n.alias("n_matches"))


def work_dir(x: Column) -> Column:
    """The last WORKDIR of a container file, /app by default."""
    return F.coalesce(F.trim(F.try_element_at(F.regexp_extract_all(x, F.lit(r"(?im)^[ \t]*WORKDIR[ \t]+(.+?)[ \t\r]*$"), F.lit(1)), F.lit(-1))), F.lit("/app"))


def written_paths(script: Column) -> Column:
    """Paths that a shell script writes by here-document or echo; those in shell variables are left out."""
    found = F.concat(*[F.regexp_extract_all(script, F.lit(p), F.lit(1)) for p in fixed.WRITES])
    return F.filter(F.transform(found, lambda p: F.regexp_replace(p, "^[\"']+|[\"']+$", "")), lambda p: ~p.startswith("$"))


def written_outside(script: Column, root: Column) -> Column:
    """Absolute written paths that don't begin with ``root``, as a plain prefix of the text."""
    return F.filter(written_paths(script), lambda p: p.startswith("/") & ~p.startswith(root))


def seconds_between(a: Column, b: Column) -> Column:
    """Seconds from one printed ISO time to another, fractions and zone dropped as printed."""
    t = lambda c: F.unix_seconds(F.try_to_timestamp(F.substring(c, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")))
    return t(b) - t(a)


def batch_epoch(x: Column) -> Column:
    """Epoch seconds of a batch id of the form yyyyMMdd-HHmmss; null for other ids."""
    return F.unix_seconds(F.try_to_timestamp(x, F.lit("yyyyMMdd-HHmmss")))


def duration_text(seconds: Column) -> Column:
    s = F.coalesce(seconds, F.lit(0)).cast("long")
    return F.when(s < 60, F.format_string("%ds", s)).when(s < 3600, F.format_string("%dm %02ds", F.floor(s / 60), s % 60)).otherwise(
        F.format_string("%dh %02dm", F.floor(s / 3600), F.floor(s % 3600 / 60))
    )


def money_text(x: Column) -> Column:
    """Dollars with two decimals, with four below one cent; a dash for null."""
    return F.when(x.isNull(), "-").when(F.abs(x) < 0.01, F.format_string("$%.4f", x.cast("double"))).otherwise(F.format_string("$%.2f", x.cast("double")))


def reported_or(reported: Column, derived: Column) -> Column:
    """The provider's own count where it gave one above 0, else the derived one."""
    return F.when(reported > 0, reported).otherwise(derived)


def wave_timeout(n: Column, limit: Column, parallel: int = 4) -> Column:
    """Time for n jobs in waves of ``parallel``."""
    return F.ceil(n / F.greatest(F.least(n, F.lit(parallel)), F.lit(1))) * limit


def retry_delay(attempt: Column, first: float = 5.0) -> Column:
    return F.lit(first) * F.pow(F.lit(2.0), attempt)


def pass_rate(passes: Column, total: Column) -> Column:
    """Four decimals; null where there is no total."""
    return F.bround(F.try_divide(passes, F.nullif(total, F.lit(0))), 4)


def inferred_type(x: Column) -> Column:
    """The JSON type that a printed value denotes; what parses as nothing else is a string."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(x)), F.lit("STRING"))


def instruction_features(x: Column) -> list[Column]:
    """words, chars, four booleans and the specificity of an instruction (0 or 1 sign: low, 2: medium, more: high)."""
    words = F.size(F.filter(F.split(x, r"\s+"), lambda t: t != ""))
    files, funcs, errors, expects = (x.rlike(p) for p in fixed.INSTRUCTION_SIGNS)
    signs = files.cast("int") + funcs.cast("int") + expects.cast("int") + (words > 50).cast("int")
    level = F.when(signs <= 1, "low").when(signs == 2, "medium").otherwise("high")
    return [words.alias("words"), F.length(x).alias("chars"), files.alias("names_files"), funcs.alias("names_functions"), expects.alias("states_behaviour"), errors.alias("names_errors"), level.alias("specificity")]


def sectioned(parts: list[tuple[Column, str, Column]], sep: str = "\n\n") -> Column:
    """Sections whose condition holds, each under its heading, joined."""
    return F.concat_ws(sep, *[F.when(when, F.concat(F.lit(head), body)) for when, head, body in parts])


def tail(x: Column, n: int) -> Column:
    return F.right(x, F.lit(n))


def test_log_results(log: Column) -> Column:
    """map test -> passed or failed, from the short summary of a test log; null without that section.

    The last of several lines for one test wins. Expected failures and skips pass; unexpected passes
    and errors fail; a FAILED line loses what follows its last ' - '.
    """
    parts = F.split(log, r"(?i)=+\s*short test summary info\s*=+", 2)
    lines = F.when(F.size(parts) == 2, F.split(F.element_at(parts, 2), LINE_ENDS))

    def one(x: Column) -> Column:
        cut = F.when(x.startswith("FAILED"), F.regexp_replace(x, r" - (?!.* - ).*$", "")).otherwise(x)
        status = F.regexp_extract(cut, r"^\s*([A-Z]+):*\s+\S", 1)
        name = F.trim(F.regexp_extract(cut, r"^\s*\S+\s+(.*?)\s*$", 1))
        name = F.when(F.instr(name, "::") > 0, F.regexp_replace(name, r"^.*?::", "")).otherwise(name)
        return F.struct(name.alias("name"), F.when(status.isin(*fixed.PASSING), "passed").when(status.isin(*fixed.FAILING), "failed").alias("status"))

    return last_by_key(F.filter(F.transform(lines, one), lambda p: p["status"].isNotNull() & (p["name"] != "")), "name", "status")


def last_by_key(entries: Column, key: str, value: str) -> Column:
    """A map from an array of structs; of several entries with one key the last counts. One sort, whatever the repeats."""
    placed = F.array_sort(F.transform(entries, lambda e, i: F.struct(e[key].alias("k"), i.alias("i"), e[value].alias("v"))))
    ends = lambda s: F.filter(s, lambda e, i: F.coalesce(F.get(s, i + 1)["k"] != e["k"], F.lit(True)))
    kept = F.get(F.transform(F.array(placed), ends), F.lit(0))
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["k"], e["v"])))
