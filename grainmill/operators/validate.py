"""Rule-based validation of rows and task directories: each rule yields an issue or nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainmill.functions import fixed
from grainmill.functions.scalars import work_dir, written_outside


def issues(*rules: tuple[Column, str]) -> Column:
    """Array of the texts whose condition holds; a null condition doesn't."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(t)) for c, t in rules]))


def blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c)) == "")


def task_rows(df: DataFrame, key: str) -> DataFrame:
    """key, issues, passed: required fields, the difficulty's domain and the length of the instruction."""
    missing = [(blank(f), f"missing {f}") for f in fixed.REQUIRED_FIELDS]
    bad = (~F.col("difficulty").isin(*fixed.DIFFICULTIES), "invalid difficulty")
    short = (F.length(F.trim("instruction")) < 50, "instruction shorter than 50")
    return df.select(key, issues(*missing, bad, short).alias("issues")).withColumn("passed", F.size("issues") == 0)


def task_files(files: DataFrame, key: str, path: str, content: str) -> DataFrame:
    """key, issues, passed of task directories from their file rows: required files, a test module, FROM, short scripts, writes outside the work directory."""
    text = lambda f: F.max(F.when(F.col(path) == f, F.col(content)))
    got = files.groupBy(key).agg(
        *[F.coalesce(F.max(F.col(path) == f), F.lit(False)).alias(f"has_{i}") for i, f in enumerate(fixed.REQUIRED_FILES)],
        F.coalesce(F.max(F.col(path).startswith("tests/") & F.col(path).endswith(".py")), F.lit(False)).alias("tests"),
        text("Dockerfile").alias("docker"), text("solution.sh").alias("solution"), text("run-tests.sh").alias("run"),
    )
    rules = [(~F.col(f"has_{i}"), f"missing file {f}") for i, f in enumerate(fixed.REQUIRED_FILES)]
    rules += [(~F.col("tests"), "no test module"), (~F.col("docker").contains("FROM"), "Dockerfile has no FROM"),
              (F.octet_length("solution") < 10, "solution.sh too short"), (F.octet_length("run") < 10, "run-tests.sh too short"),
              (F.size(written_outside(F.col("solution"), work_dir(F.col("docker")))) > 0, "writes outside the work directory")]
    return got.select(key, issues(*rules).alias("issues")).withColumn("passed", F.size("issues") == 0)


def attempt_passed(extended: bool = True) -> Column:
    """Builds, fails without and passes with the solution; with ``extended`` a false idempotence also fails. Only true counts."""
    ok = F.col("image_builds").eqNullSafe(True) & F.col("tests_fail_without_solution").eqNullSafe(True) & F.col("tests_pass_with_solution").eqNullSafe(True)
    return ok & ~F.col("solution_idempotent").eqNullSafe(False) if extended else ok


def functional_passed(builds: Column, fails_without: Column, passes_with: Column, timed_out: Column, idempotent: Column | None = None, same_each_time: Column | None = None) -> Column:
    """Builds, fails without the solution (running out of time there counts as failing) and passes with it; where the extended checks
    are given they must be true too. Null is not true."""
    true = lambda c: c.eqNullSafe(F.lit(True))
    ok = true(builds) & (true(fails_without) | true(timed_out)) & true(passes_with)
    for extended in (idempotent, same_each_time):
        ok = ok if extended is None else ok & true(extended)
    return ok


def size_findings(mb: Column, slowest: Column) -> tuple[Column, Column]:
    """(issues, warnings) of an image's size and the slowest test phase."""
    return issues((mb > 2048, "image above 2048 MB")), issues(((mb > 1024) & (mb <= 2048), "image above 1024 MB"), (slowest > 60, "tests take over 60 s"))


def deterministic(df: DataFrame, key: str, passed: str, runs: int = 3) -> DataFrame:
    """Whether a task passed all of its ``runs`` runs."""
    return df.groupBy(key).agg((F.count_if(F.col(passed)) == runs).alias("deterministic"))
