"""Features of source code: files written by scripts, diffs, hunk kinds, test and source structure.

Only these need Python: they run in Arrow batches over rows that hold a whole text each.
"""

from __future__ import annotations

import ast
import difflib
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.functions import fixed

HEREDOC, ECHO = re.compile(fixed.HEREDOC), re.compile(fixed.ECHO)
HUNK = re.compile(r"^@@ -(\d+)")


def exploding(df: DataFrame, keys: Sequence[str], args: Sequence[str], fn: Callable[..., list[tuple]], schema: str) -> DataFrame:
    """A table function: rows of ``keys`` with every tuple that ``fn(*args)`` returns; whole texts, one Arrow batch at a time."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = df.select(*keys, *[F.col(a).alias(f"_a{i}") for i, a in enumerate(args)])
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    own = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, out = [], []
            for i, values in enumerate(zip(*[b.column(f"_a{k}").to_pylist() for k in range(len(args))])):
                got = fn(*values)
                at += [i] * len(got)
                out += got
            kept = b.select(list(keys)).take(pa.array(at, pa.int64()))
            cols = list(zip(*out)) if out else [()] * len(own)
            yield pa.RecordBatch.from_arrays([*kept.columns, *[pa.array(list(c), f.type) for c, f in zip(cols, own)]], names=[*keys, *own.names])

    return rows.mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", " + schema)


def script_files(script: str | None) -> list[tuple[str, str]]:
    """(file name, content) of every file that a shell script writes by here-document or a plain echo; the last write wins."""
    found: dict[str, str] = {}
    lines = iter((script or "").splitlines(keepends=True))
    for line in lines:
        if m := HEREDOC.search(line):
            body = []
            for inner in lines:
                if inner.rstrip("\n") == m[2]:
                    break
                body.append(inner)
            path, text = m[1].strip("\"'"), "".join(body)
        elif (m := ECHO.search(line)) and ">>" not in line:
            path, text = m[2], m[1] + "\n"
        else:
            continue
        if not path.startswith("$"):
            found[path.rsplit("/", 1)[-1]] = text
    return list(found.items())


def alike(a: str, b: str, threshold: float) -> bool:
    """Whether the sets of blank-separated tokens reach a similarity; false if either is empty."""
    x, y = set(a.split()), set(b.split())
    return bool(x and y) and len(x & y) / len(x | y) >= threshold


def _off_by_one(r: str, a: str) -> bool:
    bounds = [set(re.findall(fixed.BOUNDS, s)) for s in (r, a)]
    if all(bounds) and bounds[0] != bounds[1]:
        return True
    nums = [re.findall(fixed.NUMBERS, s) for s in (r, a)]
    if nums[0] and len(nums[0]) == len(nums[1]):
        steps = [abs(int(y) - int(x)) for x, y in zip(*nums) if x != y]
        if steps and max(steps) <= 1:
            return True
    shifted = [re.search(fixed.SHIFTS, s) is not None for s in (r, a)]
    return shifted[0] != shifted[1]


def _tokens_differ(pattern: str) -> Callable[[str, str], bool]:
    return lambda r, a: re.findall(pattern, r) != re.findall(pattern, a)


def _names_changed(r: str, a: str) -> int:
    x, y = (re.findall(fixed.NAMES, s) for s in (r, a))
    return sum(p != q for p, q in zip(x, y)) if len(x) == len(y) else -1


_OPS = _tokens_differ(fixed.OPERATORS)
_STRINGS = _tokens_differ(fixed.STRINGS)
_NUMBERS = _tokens_differ(fixed.NUMBERS)
#: Kinds of a one-line change; the first rule that holds names it, so their order matters.
RULES: list[tuple[str, Callable[[str, str], bool]]] = [
    ("off_by_one", _off_by_one),
    ("wrong_operator", lambda r, a: _OPS(r, a) and alike(r, a, 0.5)),
    ("wrong_variable", lambda r, a: _names_changed(r, a) == 1),
    ("swapped_arguments", lambda r, a: _names_changed(r, a) == 2 and alike(r, a, 0.85)),
    ("wrong_constant", lambda r, a: (_STRINGS(r, a) or _NUMBERS(r, a)) and alike(r, a, 0.4)),
    ("missing_edge_case", lambda r, a: any(k in a and k not in r for k in fixed.GUARDS)),
]


def line_kind(removed: str, added: str) -> str:
    return next((name for name, rule in RULES if rule(removed, added)), "logic_change")


def hunk_kind(removed: list[str], added: list[str]) -> str:
    """Kind of a hunk: code missing or extra, a line change, or the most common kind of its line pairs (ties by name)."""
    r, a = "".join(removed).strip(), "".join(added).strip()
    if not r or not a:
        return "missing_code" if a else "extra_code" if r else "logic_change"
    if abs(len(removed) - len(added)) > 1:
        return "logic_change"
    kinds = Counter(line_kind(x.strip(), y.strip()) for x, y in zip(removed, added))
    if len(removed) == len(added) == 1:
        return next(iter(kinds))
    kinds.pop("logic_change", None)
    return min(kinds, key=lambda k: (-kinds[k], k)) if kinds else "logic_change"


def hunks(before: str | None, after: str | None) -> list[tuple[int, str, list[str], list[str]]]:
    """(line in the text before, kind, removed lines, added lines) of every change region."""
    if before is None or after is None or before == after:
        return []
    out: list[tuple[int, list[str], list[str]]] = []
    for line in list(difflib.unified_diff(before.splitlines(), after.splitlines(), n=0, lineterm=""))[2:]:
        if m := HUNK.match(line):
            out.append((int(m[1]), [], []))
        else:
            out[-1][1 if line[0] == "-" else 2].append(line[1:])
    return [(at, hunk_kind(r, a), r, a) for at, r, a in out]


def diff_rows(df: DataFrame, keys: Sequence[str], before: str, after: str) -> DataFrame:
    """keys, position, kind, removed, added: a row per change region between two text columns."""
    return exploding(df, keys, [before, after], hunks, "position int, kind string, removed array<string>, added array<string>")


def diff_summary(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Regions, changed lines and kinds per key, with warnings on sizes outside the usual range."""
    got = rows.groupBy(*keys).agg(F.count("*").alias("n_hunks"), F.sum(F.size("removed") + F.size("added")).alias("lines_changed"), F.array_sort(F.collect_set("kind")).alias("kinds"))
    n, c = F.col("n_hunks"), F.col("lines_changed")
    return got.withColumn("warnings", F.array_compact(F.array(F.when(n < 2, "single region"), F.when(n > 8, "many regions"), F.when(c > 80, "large change"))))


def _assertion(node: ast.Assert) -> str:
    match node.test:
        case ast.Compare(ops=ops) if any(isinstance(o, ast.Eq | ast.NotEq) for o in ops):
            return "equality"
        case ast.Compare(ops=ops) if any(isinstance(o, ast.In | ast.NotIn) for o in ops):
            return "membership"
        case ast.Compare():
            return "comparison"
        case ast.Call(func=ast.Name(id="isinstance")):
            return "type_check"
        case ast.Call():
            return "function_call"
        case ast.BoolOp():
            return "compound"
    return "boolean"


def test_structure(code: str | None) -> list[tuple]:
    """[(tests, docstrings, descriptive names, assertions, assertion kinds, uses subprocess)]; counts are 0 for code that doesn't parse."""
    spawns = "subprocess" in (code or "")
    try:
        tree = ast.parse(code or "")
    except (SyntaxError, ValueError, RecursionError):
        return [(0, 0, 0, 0, [], spawns)]
    tests = [n for n in ast.walk(tree) if isinstance(n, ast.FunctionDef) and n.name.startswith("test_")]
    kinds: Counter = Counter()
    for child in (c for t in tests for c in ast.walk(t)):
        if isinstance(child, ast.Assert):
            kinds[_assertion(child)] += 1
        elif isinstance(child, ast.Call) and isinstance(child.func, ast.Attribute) and child.func.attr.startswith("assert"):
            kinds[child.func.attr] += 1
    return [(len(tests), sum(ast.get_docstring(t) is not None for t in tests), sum("_" in t.name.replace("test_", "") for t in tests), sum(kinds.values()), list(kinds.items()), spawns)]


def _depth(node: ast.AST, d: int = 0) -> int:
    inner = d + isinstance(node, ast.If | ast.For | ast.While | ast.With | ast.Try)
    return max([inner, *(_depth(c, inner) for c in ast.iter_child_nodes(node))])


def source_structure(path: str | None, code: str | None) -> list[tuple]:
    """[(language, code lines, plain functions, classes, imports, nesting depth)]; only root-level Python files are parsed."""
    name = path or ""
    language = fixed.EXTENSIONS.get("." + name.rsplit(".", 1)[-1] if "." in name else "", "unknown")
    loc = sum(bool(x.strip()) for x in (code or "").splitlines())
    if language != "python" or "/" in name:
        return [(language, loc, 0, 0, 0, 0)]
    try:
        tree = ast.parse(code or "")
    except (SyntaxError, ValueError, RecursionError):
        return [(language, loc, 0, 0, 0, 0)]
    count = lambda *t: sum(isinstance(n, t) for n in ast.walk(tree))
    return [(language, loc, count(ast.FunctionDef), count(ast.ClassDef), count(ast.Import, ast.ImportFrom), _depth(tree))]


def test_features(files: DataFrame, keys: Sequence[str], content: str) -> DataFrame:
    return exploding(files, keys, [content], test_structure, "n_tests int, n_docstrings int, n_descriptive int, n_assertions int, kinds array<struct<kind: string, n: int>>, uses_subprocess boolean")


def source_features(files: DataFrame, keys: Sequence[str], path: str, content: str) -> DataFrame:
    return exploding(files, keys, [path, content], source_structure, "language string, loc int, n_functions int, n_classes int, n_imports int, depth int")


def without_commands(text: str | None, starts: Sequence[str], holds: Sequence[str] = ()) -> str | None:
    """A script without the commands that begin or hold as given, with their continuation lines."""
    if text is None:
        return None
    out, dropping = [], False
    for line in text.splitlines():
        bare = line.strip()
        if dropping or bare.startswith(tuple(starts)) or any(h in bare for h in holds):
            dropping = bare.endswith("\\")
            continue
        out.append(line)
    return "\n".join(out) + "\n"


def strip_commands(df: DataFrame, column: str, starts: Sequence[str], holds: Sequence[str] = ()) -> DataFrame:
    """``column`` without the given commands; rows are unchanged otherwise."""

    @F.pandas_udf("string")
    def strip(s: pd.Series) -> pd.Series:
        return s.map(lambda x: without_commands(x, starts, holds))

    return df.withColumn(column, strip(F.col(column)))


def solution_changes(files: DataFrame, key: str, path: str, content: str) -> DataFrame:
    """Per file that a task's solution script writes: the task's own file of that name and the change regions between both."""
    from grainmill.operators.merge import basename_match

    scripts = files.where(F.col(path) == "solution.sh")
    written = exploding(scripts, [key], [content], script_files, "file string, fixed string")
    written = written.where(~F.col("file").isin(*fixed.INFRA_FILES) & ~F.col("file").startswith("test_"))
    matched = basename_match(written, [key], "file", files, path)
    both = matched.join(files.select(key, path, F.col(content).alias("_own")), [key, path])
    return diff_rows(both, [key, "file"], "_own", "fixed")


def file_change(before: str | None, after: str | None) -> list[tuple]:
    """[(lines before, regions, added, removed lines, changed)] of one file; ends of lines count."""
    a, b = (before or "").splitlines(keepends=True), (after or "").splitlines(keepends=True)
    diff = list(difflib.unified_diff(a, b, n=0))
    count = lambda sign, header="\0": sum(x.startswith(sign) and not x.startswith(header) for x in diff)
    return [(len(a), count("@@"), count("+", "+++"), count("-", "---"), (before or "") != (after or ""))]


def task_diffs(files: DataFrame, key: str, path: str, content: str) -> DataFrame:
    """key, files_changed, n_hunks, lines_changed, source_loc, file_details, warnings: what each task's solution script changes; a row for every task.

    Without a script, or one that writes no file, the counts are null and a warning says so.
    """
    from grainmill.operators.merge import basename_match

    scripts = files.where(F.col(path) == "solution.sh")
    found = exploding(scripts, [key], [content], script_files, "file string, fixed string")
    written = found.where(~F.col("file").isin(*fixed.INFRA_FILES) & ~F.col("file").startswith("test_"))
    matched = basename_match(written, [key], "file", files, path)
    both = matched.join(files.select(key, path, F.col(content).alias("_own")), [key, path])
    each = exploding(both, [key, "file"], ["_own", "fixed"], file_change, "loc int, n_hunks int, n_added int, n_removed int, changed boolean")
    detail = F.struct("file", "n_hunks", "n_added", "n_removed")
    sums = each.groupBy(key).agg(
        F.count_if("changed").alias("files_changed"), F.sum("n_hunks").alias("n_hunks"), F.sum(F.col("n_added") + F.col("n_removed")).alias("lines_changed"),
        F.sum("loc").alias("source_loc"), F.array_sort(F.collect_list(F.when(F.col("changed"), detail))).alias("file_details"),
    )
    lost = written.join(each.select(key, "file"), [key, "file"], "left_anti").groupBy(key).agg(F.array_sort(F.collect_set(F.concat(F.lit("not found: "), "file"))).alias("_lost"))
    got = files.groupBy(key).agg(F.coalesce(F.max(F.col(path) == "solution.sh"), F.lit(False)).alias("_script"))
    got = got.join(found.select(key, F.lit(True).alias("_written")).distinct(), key, "left").join(sums, key, "left").join(lost, key, "left")
    known = lambda c: F.when(F.col("_written"), F.coalesce(c, F.lit(0)))
    got = got.withColumns({c: known(c) for c in ("files_changed", "n_hunks", "lines_changed", "source_loc")} | {"file_details": F.when(F.col("_written"), F.coalesce("file_details", F.array().cast(sums.schema["file_details"].dataType)))})
    f, n, c, loc = (F.col(x) for x in ("files_changed", "n_hunks", "lines_changed", "source_loc"))
    sizes = F.array(F.when(~F.col("_script"), "no solution script"), F.when(F.col("_script") & F.col("_written").isNull(), "no file in the solution script"), F.when(f == 0, "no file changed"), F.when(f > 2, "many files"),
                    F.when(n < 2, "single region"), F.when(n > 8, "many regions"), F.when(c > 80, "large change"), F.when(loc > 200, "large source"))
    return got.withColumn("warnings", F.concat(F.coalesce("_lost", F.array().cast("array<string>")), F.array_compact(sizes))).drop("_script", "_written", "_lost")


def full_features(tasks: DataFrame, files: DataFrame, key: str, path: str, content: str, instruction: str) -> DataFrame:
    """One row per task: what its solution changes, the kinds of change and their places, its tests, its source and its instruction.

    ``tasks`` (key, instruction) decides the rows; a part that a task lacks has zero counts. Diff,
    tests and source are worked out from file rows, each part aggregated per task before it joins.
    """
    from grainmill.functions.scalars import instruction_features
    from grainmill.operators.quality import position_gaps

    changes = solution_changes(files, key, path, content)
    kinds = changes.groupBy(key, "kind").agg(F.count("*").alias("n")).groupBy(key).agg(
        F.sum("n").alias("n_changes"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "n")))).alias("change_kinds")
    )
    diffs = task_diffs(files, key, path, content)
    places = changes.groupBy(key).agg(F.collect_list("position").alias("p")).join(diffs.select(key, "source_loc"), key)
    places = position_gaps(places, key, "p", F.col("source_loc"))
    tests = files.where(F.col(path).startswith("tests/") & F.col(path).endswith(".py"))
    tests = test_features(tests, [key], content).groupBy(key).agg(*[F.sum(c).alias(c) for c in ("n_tests", "n_docstrings", "n_descriptive", "n_assertions")], F.max("uses_subprocess").alias("uses_subprocess"))
    name = F.element_at(F.split(path, "/"), -1)
    own = files.where(~name.isin(*fixed.INFRA_FILES, "solution.sh") & ~F.col(path).startswith("tests/"))
    source = source_features(own, [key], path, content).groupBy(key).agg(
        F.count("*").alias("n_files"), *[F.sum(c).alias(c) for c in ("loc", "n_functions", "n_classes", "n_imports")], F.max("depth").alias("depth")
    )
    rows = tasks.select(key, *instruction_features(F.col(instruction)))
    for part in (diffs, kinds, places, tests, source):
        rows = rows.join(part, key, "left")
    counts = ["n_changes", "max_gap", "avg_gap", "spread", "n_tests", "n_docstrings", "n_descriptive", "n_assertions", "n_files", "loc", "n_functions", "n_classes", "n_imports", "depth"]
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})
