"""Contracts and data tests.

Each check returns its failing rows as a lazy DataFrame; ``run_checks``
turns a list of checks into one result-log DataFrame. All checks of one table,
row-wise (``rows`` and ``broken``) and key-wise (``rows`` and ``key``), share one
scan: the key sets are grouping sets of one aggregate, and the empty set counts
the rows that row-wise checks find broken. Nothing is collected.

``checked_write`` tests a table while it is written: row-wise checks are metrics
observed on the frame on its way to the files, so they cost no pass of their
own; keys are checked on what was written, and failing rows are stored from it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's.
QUALITY_DIMENSIONS = ("completeness", "uniqueness", "validity", "accuracy", "consistency")
PROGRAM_CODE_PATTERN = r"([A-Z]{4}-[A-Z]{4}-\d{3})"
TEST_PREFIXES = {"general": "tst", "compliance": "cpl"}


class ContractError(ValueError):
    pass


class CheckFailed(RuntimeError):
    """Checks of severity 'error' that failed on a written table; the log has their rows."""


def test_name(kind: str, subject: str, column: str | None = None) -> str:
    """``tst_<subject>`` or ``cpl_<subject>`` for a model-level test, with ``__<column>`` for a column-level one.

    ``subject`` is a model, a folder of singular tests, or ``generic``.
    """
    if kind not in TEST_PREFIXES:
        raise ValueError(f"kind must be one of {tuple(TEST_PREFIXES)}")
    return f"{TEST_PREFIXES[kind]}_{subject}" + (f"__{column}" if column else "")


def parse_test_name(name: str) -> dict[str, str | None]:
    """Kind, level ('model' or 'column'), subject and column of a test's name; an error if it does not follow the rule."""
    found = re.fullmatch(r"(tst|cpl)_(\w+?)(?:__(\w+))?", name)
    if not found:
        raise ValueError(f"not a test name: {name!r}")
    kind = next(k for k, v in TEST_PREFIXES.items() if v == found[1])
    return {"kind": kind, "level": "column" if found[3] else "model", "subject": found[2], "column": found[3]}


def conform(df: DataFrame, schema: T.StructType, cast: bool = False) -> DataFrame:
    """Enforce a column contract: every declared column present, in order, with its type.

    Missing columns raise ``ContractError``, and so does a type mismatch; with
    ``cast`` it is cast instead (ANSI cast: bad values raise at run time).
    Extra columns are dropped.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ContractError(f"missing contract columns: {missing}")
    wrong = [f.name for f in schema.fields if have[f.name] != f.dataType]
    if wrong and not cast:
        raise ContractError(f"columns with contract type mismatch: {wrong}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if have[f.name] != f.dataType
                       else F.col(f.name) for f in schema.fields])


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def not_null(df: DataFrame, col: str, context: Sequence[str] = ()) -> DataFrame:
    return df.filter(F.col(col).isNull()).select(*context, col) if context else \
        df.filter(F.col(col).isNull())


#: Why a code fails the format, in order of precedence (unanchored patterns).
_CODE_FAULTS = (
    (None, "NULL value"),
    (r"-.*-", "Missing hyphens"),
    (r"([A-Z]{4}-)", "First segment not 4 uppercase letters"),
    (r"(-[A-Z]{4}-)", "Second segment not 4 uppercase letters"),
    (r"(-\d{3})", "Third segment not 3 digits"),
)


def program_code_reason(code: Column) -> Column:
    """Why a code fails the ``XXXX-XXXX-000`` format; the first fault of the list that it has.

    Only for codes that fail; a code with none of the faults has them in the wrong places.
    """
    faults = [F.when(code.isNull() if pattern is None else ~code.rlike(f"(?s){pattern}"), F.lit(label))
              for pattern, label in _CODE_FAULTS]
    return F.coalesce(*faults, F.lit("Unknown format issue"))


def format_check(df: DataFrame, col: str, context: Sequence[str] = (),
                 alias: str = "program_code") -> DataFrame:
    """Rows whose code is NULL or does not contain the format, with ``failure_reason``."""
    code = F.col(col)
    bad = code.isNull() | ~code.rlike(PROGRAM_CODE_PATTERN)
    return df.filter(bad).select(*context, code.alias(alias),
                                 program_code_reason(code).alias("failure_reason"))


def _threshold(expr: str | None, n: Column, total: Column, unit: str) -> Column:
    if not expr:
        return F.lit(False)
    op = next(o for o in (">=", "<=", "!=", ">", "<", "=") if expr.strip().startswith(o))
    value = float(expr.strip()[len(op):])
    x = n.cast("double") if unit == "rows" else F.try_divide(n * 100.0, total)
    return {">=": x >= value, "<=": x <= value, ">": x > value, "<": x < value,
            "=": x == value, "!=": x != value}[op]


@dataclass
class Check:
    """One data test.

    Either ``failures`` gives the failing rows, or ``rows`` and ``broken`` say
    which rows of a table fail, or ``rows`` and ``key`` name columns whose values
    must not occur twice (a null counts as a value). ``where`` restricts ``rows``
    first; ``context`` names the columns that failing rows are shown with
    (default: all). For ``checked_write`` ``rows`` may be left out.
    """
    name: str
    failures: Callable[[], DataFrame] | None = None
    column: str | None = None
    severity: str = "warn"
    warn_if: str | None = "!=0"
    error_if: str | None = "!=0"
    unit: str = "rows"
    total: Callable[[], DataFrame] | None = None
    quality_dimension: str = "validity"
    tags: Sequence[str] = field(default_factory=tuple)
    rows: DataFrame | None = None
    broken: Column | None = None
    key: Sequence[str] | None = None
    where: str | None = None
    context: Sequence[str] = field(default_factory=tuple)

    def __post_init__(self):
        if self.quality_dimension not in QUALITY_DIMENSIONS:
            raise ValueError(f"quality_dimension must be one of {QUALITY_DIMENSIONS}")
        if self.severity not in ("warn", "error"):
            raise ValueError("severity must be 'warn' or 'error'")
        if [self.failures is not None, self.broken is not None, self.key is not None].count(True) != 1:
            raise ValueError("give one of failures, broken and key")
        if self.failures is None:
            self.failures = lambda: self.failing(self.rows)

    def failing(self, rows: DataFrame) -> DataFrame:
        """The failing rows (or keys, with their number of rows) among ``rows``."""
        rows = rows.filter(self.where) if self.where else rows
        if self.key is not None:
            return unique(rows, self.key)
        return rows.filter(self.broken).select(*(list(self.context) or ["*"]))

    def scope(self) -> DataFrame:
        """The rows that a row-wise check looks at."""
        return self.rows.filter(self.where) if self.where else self.rows


def status_of(n: Column, total: Column, check: Check) -> Column:
    """pass / warn / fail. With severity 'error' the error threshold can fail the
    test; with 'warn' the worst outcome is a warning (dbt's rules)."""
    err = _threshold(check.error_if, n, total, check.unit)
    warn = _threshold(check.warn_if, n, total, check.unit)
    if check.severity == "error":
        return F.when(err, F.lit("fail")).when(warn, F.lit("warn")).otherwise(F.lit("pass"))
    return F.when(err | warn, F.lit("warn")).otherwise(F.lit("pass"))


def _log_row(check: Check, failures: Column, total: Column) -> list[Column]:
    return [F.lit(check.name).alias("test_name"), F.lit(check.column).cast("string").alias("column_name"),
            failures.alias("failures"), status_of(failures, total, check).alias("status"),
            F.lit(check.quality_dimension).alias("quality_dimension"), F.lit(",".join(check.tags)).alias("tags")]


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """One result-log row per check: name, column, failures, status, dimension, tags."""
    parts = []
    tables: dict[tuple[int, str | None], list[Check]] = {}
    for c in checks:
        if c.rows is not None:
            tables.setdefault((id(c.rows), c.where), []).append(c)
            continue
        marks = c.failures().select(F.lit(1).alias("__f"), F.lit(0).alias("__t"))
        if c.total is not None:
            marks = marks.unionByName(c.total().select(F.lit(0).alias("__f"), F.lit(1).alias("__t")))
        fail = marks.agg(F.count(F.when(F.col("__f") == 1, 1)).alias("failures"),
                         (F.count(F.when(F.col("__t") == 1, 1)) if c.total is not None
                          else F.lit(None).cast("long")).alias("total_rows"))
        parts.append(fail.select(*_log_row(c, F.col("failures"), F.col("total_rows"))))
    for group in tables.values():
        counts = _table_counts(group[0].scope(), group)
        each = F.array(*[F.struct(*_log_row(c, F.col(f"__f{i}"), F.col("__t"))) for i, c in enumerate(group)])
        parts.append(counts.select(F.explode(each).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


def _table_counts(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row: the failures of each check (``__f0``, ``__f1``, ...) and the table's rows (``__t``), from one scan."""
    broken = {f"__b{i}": F.count_if(c.broken) for i, c in enumerate(checks) if c.broken is not None}
    sets = list(dict.fromkeys(tuple(c.key) for c in checks if c.key is not None))
    if not sets:
        return rows.agg(*[n.alias(name.replace("b", "f")) for name, n in broken.items()], F.count(F.lit(1)).alias("__t"))
    columns = list(dict.fromkeys(c for s in sets for c in s))
    # a set's grouping id has a bit for each column that it leaves out, the first column's the highest
    place = {s: sum(1 << len(columns) - 1 - i for i, c in enumerate(columns) if c not in s) for s in [*sets, ()]}
    groups = rows.groupingSets([[F.col(c) for c in s] for s in [*sets, ()]], *[F.col(c) for c in columns]) \
        .agg(F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("__n"), *[n.alias(name) for name, n in broken.items()])
    of = lambda s, value: F.when(F.col("__set") == place[s], value)
    failures = [F.count_if((F.col("__set") == place[tuple(c.key)]) & (F.col("__n") > 1)) if c.key is not None
                else F.coalesce(F.max(of((), F.col(f"__b{i}"))), F.lit(0)) for i, c in enumerate(checks)]
    return groups.agg(*[f.alias(f"__f{i}") for i, f in enumerate(failures)], F.coalesce(F.max(of((), F.col("__n"))), F.lit(0)).alias("__t"))


def checked_write(df: DataFrame, write: Callable[[DataFrame], None], read: Callable[[], DataFrame],
                  checks: Sequence[Check], log_path: str, run_id: str, run_at: Column,
                  failures_path: str | None = None, limit: int | None = None, raise_failed: bool = True) -> DataFrame:
    """Write ``df`` with ``write`` and test it on the way; returns the run's log rows.

    Row-wise checks are observed on ``df`` as ``write`` consumes it: it must
    run ``df`` once and not lay it out anew (lay out first, then hand it over).
    Key checks share one scan of what ``read`` gives. The log is appended at
    ``log_path`` after the write; checks that found failing rows store them,
    up to ``limit``, at ``failures_path/<name>``. Then a failed check of
    severity 'error' raises ``CheckFailed``, unless ``raise_failed`` is false.
    """
    spark = df.sparkSession
    row_wise, key_wise = [c for c in checks if c.broken is not None], [c for c in checks if c.key is not None]
    if len(row_wise) + len(key_wise) < len(checks):
        raise ValueError("checked_write takes checks with broken or key")
    inside = lambda c: F.expr(c.where) if c.where else F.lit(True)
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n"),
                     *[F.count_if(inside(c) & c.broken).alias(f"f{i}") for i, c in enumerate(row_wise)],
                     *[F.count_if(inside(c)).alias(f"t{i}") for i, c in enumerate(row_wise)]))
    got, parts = seen.get, []
    for i, c in enumerate(row_wise):
        parts.append(spark.range(1).select(*_log_row(c, F.lit(got[f"f{i}"]).cast("long"), F.lit(got[f"t{i}"]).cast("long"))))
    written = read()
    for where in dict.fromkeys(c.where for c in key_wise):
        some = [c for c in key_wise if c.where == where]
        counts = _table_counts(written.filter(where) if where else written, some)
        each = F.array(*[F.struct(*_log_row(c, F.col(f"__f{i}"), F.col("__t"))) for i, c in enumerate(some)])
        parts.append(counts.select(F.explode(each).alias("r")).select("r.*"))
    # a row per check: the log goes to its table, and back to tell which checks failed
    rows = reduce(DataFrame.unionByName, parts).collect()
    log = spark.createDataFrame(rows, parts[0].schema)
    append_log(log, log_path, run_id, run_at)
    if failures_path:
        for c in checks:
            if next(r["failures"] for r in rows if r["test_name"] == c.name):
                store_failures(c.failing(written), f"{failures_path}/{c.name}", limit)
    failed = [r["test_name"] for r in rows if r["status"] == "fail"]
    if failed and raise_failed:
        raise CheckFailed(f"failed checks: {failed}")
    return log


def append_log(results: DataFrame, path: str, run_id: str, run_at: Column) -> None:
    """Append a run's result rows, with its id and time, to the log table at ``path``."""
    results.withColumn("run_id", F.lit(run_id)).withColumn("run_at", run_at.cast("timestamp")) \
        .write.mode("append").parquet(path)


def store_failures(failures: DataFrame, path: str, limit: int | None = None) -> None:
    """Persist failing rows (``store_failures: true`` with ``limit``), replacing the last run.

    The limit keeps an arbitrary subset of failing rows for inspection, as
    the stored-failures table does; counts come from ``run_checks``.
    """
    out = failures.limit(limit) if limit else failures
    out.write.mode("overwrite").parquet(path)
