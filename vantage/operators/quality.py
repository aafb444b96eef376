"""Data-quality checks, suites, report and gate.

A check returns its failing rows (zero rows = pass).  ``run_checks`` turns a
suite into a lazy report with one row per check; row-level checks on the same table
are folded into one ``agg`` of ``count_if`` columns so a table is scanned once
for all of them; uniqueness checks cost one aggregate each and referential
checks one anti join each.

``write_checked`` and ``evaluate`` run a suite and time each check:

- row-level checks and the row count of a table that is written ride on that write
  (``DataFrame.observe``) and scan nothing; tables that are not written are scanned once;
- all uniqueness checks of a table share one aggregate over its grouping sets;
- all references to a parent key share one scan of the parent, and child keys are
  counted before they are joined, so a hot key is one row.

These jobs do not depend on each other and run a few at a time.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vantage.operators.relational import dup_keys

WARN, ERROR = "warn", "error"


# ------------------------------------------------------------ failing rows

def not_null_fail(col: str) -> Column:
    return F.col(col).isNull()


def accepted_values_fail(col: str, values: Sequence) -> Column:
    """NULL passes (``NOT IN`` on NULL is not true)."""
    return F.col(col).isNotNull() & ~F.col(col).isin(list(values))


def expression_fail(col: str, expression: str) -> Column:
    """Rows where ``NOT (col expression)`` is true; NULL results pass."""
    return F.coalesce(~F.expr(f"`{col}` {expression}"), F.lit(False))


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(not_null_fail(col))


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.where(accepted_values_fail(col, values))


def expression_is_true(df: DataFrame, col: str, expression: str) -> DataFrame:
    return df.where(expression_fail(col, expression))


def unique(df: DataFrame, col: str) -> DataFrame:
    """Duplicated non-NULL values with their count."""
    return dup_keys(df.where(F.col(col).isNotNull()).select(col), [col])


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Duplicated key combinations (NULLs are ordinary group values)."""
    return dup_keys(df.select(*cols), list(cols))


def relationships(df: DataFrame, col: str, parent: DataFrame, field_: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (left anti join)."""
    p = parent.select(F.col(field_).alias("_parent_key")).distinct()
    return (df.where(F.col(col).isNotNull())
              .join(p, F.col(col) == F.col("_parent_key"), "left_anti"))


# ------------------------------------------------------------------ suites

@dataclass(frozen=True)
class Check:
    """One declared test.  ``kind``: not_null | unique | accepted_values |
    relationships | expression_is_true | unique_combination."""

    table: str
    kind: str
    column: str | None = None
    columns: tuple[str, ...] = ()
    values: tuple = ()
    expression: str | None = None
    parent: str | None = None
    parent_field: str | None = None
    severity: str = WARN
    name: str = field(default="")

    @property
    def check_name(self) -> str:
        if self.name:
            return self.name
        target = self.column or "_".join(self.columns)
        return f"{self.kind}_{self.table}_{target}"


ROW_KINDS = ("not_null", "accepted_values", "expression_is_true")


def failing_rows(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    df = tables[check.table]
    if check.kind == "not_null":
        return not_null(df, check.column)
    if check.kind == "accepted_values":
        return accepted_values(df, check.column, check.values)
    if check.kind == "expression_is_true":
        return expression_is_true(df, check.column, check.expression)
    if check.kind == "unique":
        return unique(df, check.column)
    if check.kind == "unique_combination":
        return unique_combination(df, check.columns)
    if check.kind == "relationships":
        return relationships(df, check.column, tables[check.parent], check.parent_field)
    raise ValueError(f"unknown check kind {check.kind!r}")


def _row_fail(check: Check) -> Column:
    if check.kind == "not_null":
        return not_null_fail(check.column)
    if check.kind == "accepted_values":
        return accepted_values_fail(check.column, check.values)
    return expression_fail(check.column, check.expression)


def run_checks(suite: Sequence[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """Report ``(check_name, table_name, kind, severity, failures, status, message)``.

    Row-level checks of one table share a single scan; the report has one row
    per check (bounded by the suite, not by the data).
    """
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for c in suite:
        if c.kind in ROW_KINDS:
            by_table.setdefault(c.table, []).append(c)
    for table, checks in by_table.items():
        counts = tables[table].agg(*[F.count_if(_row_fail(c)).alias(f"c{i}") for i, c in enumerate(checks)])
        stack = ", ".join(f"'{c.check_name}', '{c.kind}', '{c.severity}', c{i}" for i, c in enumerate(checks))
        parts.append(counts.selectExpr(
            f"stack({len(checks)}, {stack}) AS (check_name, kind, severity, failures)")
            .withColumn("table_name", F.lit(table)))
    for c in suite:
        if c.kind in ROW_KINDS:
            continue
        n = failing_rows(c, tables).agg(F.count(F.lit(1)).alias("failures"))
        parts.append(n.select(F.lit(c.check_name).alias("check_name"), F.lit(c.kind).alias("kind"),
                              F.lit(c.severity).alias("severity"), "failures",
                              F.lit(c.table).alias("table_name")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = (F.when(F.col("failures") == 0, "pass")
               .when(F.col("severity") == ERROR, "error").otherwise("warn"))
    return out.select("check_name", "table_name", "kind", "severity",
                      F.col("failures").cast("long").alias("failures"), status.alias("status"),
                      F.when(F.col("failures") > 0, F.concat(F.lit("got "), F.col("failures").cast("string"),
                                                             F.lit(" failing rows"))).alias("message"))


# --------------------------------------------------- checks that were run

@dataclass(frozen=True)
class Result:
    """Outcome of a check.  ``seconds``: the wall time of the job that found it, shared out
    evenly over what the job found."""

    check: Check
    failures: int
    seconds: float


#: partitions of a partitioned write for each share that a value's rows are split to
_SHARES = 8


def _dealt(df: DataFrame, by: str, parts: int, near: str | None = None) -> DataFrame:
    """``df`` in ``parts`` partitions: the rows of a value of ``by`` (or of ``near``, an expression that
    neighbouring values share) are split by the first other column to shares, several of
    which meet in a partition."""
    other = next(c for c in df.columns if c != by)
    return df.repartition(parts, F.expr(near or f"`{by}`"), F.pmod(F.xxhash64(other), F.lit(max(1, parts // _SHARES))))


def write_checked(df: DataFrame, path: str, checks: Sequence[Check] = (), by: str | None = None,
                  parts: int | None = None, near: str | None = None) -> tuple[DataFrame, int, list[Result]]:
    """Write ``df`` to ``path`` (Parquet, must be new) and read it back; also its number of
    rows and the results of the row-level checks among ``checks``, observed on the write.
    ``by``: a column to partition by; its rows are clustered, and a large value is split.
    ``parts``: into so many tasks, where the number of rows is known beforehand: each sorts its
    rows by ``by``, and AQE would size them by what is shuffled, several times smaller.  ``near``: an
    expression on ``by``; rows that share it stay together on their way, so where they are
    alike (an entity's at neighbouring times) less is shuffled."""
    rows = [c for c in checks if c.kind in ROW_KINDS]
    seen = Observation()
    began = time.perf_counter()
    dealt = df if not by else df.hint("rebalance", by) if parts is None else _dealt(df, by, parts, near)
    writer = dealt.observe(seen, F.count(F.lit(1)).alias("rows"),
                           *(F.count_if(_row_fail(c)).alias(f"c{i}") for i, c in enumerate(rows))).write
    (writer.partitionBy(by) if by else writer).parquet(path)
    share = (time.perf_counter() - began) / (len(rows) + 1)
    got = seen.get
    return (df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns), got["rows"],
            [Result(c, got[f"c{i}"], share) for i, c in enumerate(rows)])


def row_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Failing rows of row-level checks on one table: one row, one column a check."""
    return df.agg(*(F.count_if(_row_fail(c)).alias(f"c{i}") for i, c in enumerate(checks)))


def key_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Duplicated keys of the uniqueness checks on one table: one row, one column a check."""
    sets = [list(c.columns) if c.kind == "unique_combination" else [c.column] for c in checks]
    columns = list(dict.fromkeys(x for s in sets for x in s))
    apart = {tuple(sorted(s)): s for s in sets}.values()  # a set named twice would count twice
    groups = df.groupingSets([[F.col(x) for x in s] for s in apart], *map(F.col, columns)).agg(
        F.count(F.lit(1)).alias("_rows"), F.grouping_id().alias("_set"))

    def twice(check: Check, keys: list[str]) -> Column:
        number = int("".join("0" if x in keys else "1" for x in columns), 2)  # a bit for each column left out
        found = (F.col("_set") == number) & (F.col("_rows") > 1)
        return found if check.kind == "unique_combination" else found & F.col(check.column).isNotNull()

    return groups.agg(*(F.count_if(twice(c, s)).alias(f"c{i}") for i, (c, s) in enumerate(zip(checks, sets))))


def orphan_counts(parent: DataFrame, field_: str, children: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Rows of each child (its number in ``children``: ``child``) whose key has no parent row."""
    keys = None
    for i, (df, col) in enumerate(children):
        some = df.where(F.col(col).isNotNull()).select(F.lit(i).alias("child"), F.col(col).alias("key"))
        keys = some if keys is None else keys.unionByName(some)
    counted = keys.groupBy("child", "key").agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(field_).alias("key")).distinct()
    return counted.join(known, "key", "left_anti").groupBy("child").agg(F.sum("n").alias("failures"))


def _jobs(suite: Sequence[Check], tables: dict[str, DataFrame]) -> list[tuple[list[Check], Callable[[], list[int]]]]:
    """(checks, what counts their failures), one for each job."""
    rows: dict[str, list[Check]] = {}
    keys: dict[str, list[Check]] = {}
    links: dict[tuple[str, str], list[Check]] = {}
    for c in suite:
        if c.kind in ROW_KINDS:
            rows.setdefault(c.table, []).append(c)
        elif c.kind == "relationships":
            links.setdefault((c.parent, c.parent_field), []).append(c)
        else:
            keys.setdefault(c.table, []).append(c)
    jobs: list[tuple[list[Check], Callable[[], list[int]]]] = []
    for counts, by_table in ((row_counts, rows), (key_counts, keys)):
        for table, checks in by_table.items():
            jobs.append((checks, lambda counts=counts, table=table, checks=checks: list(counts(tables[table], checks).first())))

    def orphans(parent: str, field_: str, checks: list[Check]) -> list[int]:
        found = orphan_counts(tables[parent], field_, [(tables[c.table], c.column) for c in checks]).collect()
        by_child = {r.child: r.failures for r in found}  # a row a check at most
        return [by_child.get(i, 0) for i in range(len(checks))]

    for (parent, field_), checks in links.items():
        jobs.append((checks, lambda parent=parent, field_=field_, checks=checks: orphans(parent, field_, checks)))
    return jobs


def evaluate(suite: Sequence[Check], tables: dict[str, DataFrame], done: Sequence[Result] = (),
             threads: int = 4) -> list[Result]:
    """Results of the suite in its order; those in ``done`` (of checks on a write) are taken as
    they are, the others are run, ``threads`` jobs at a time."""
    known = {r.check: r for r in done}

    def run(job: tuple[list[Check], Callable[[], list[int]]]) -> list[Result]:
        checks, counts = job
        began = time.perf_counter()
        got = counts()
        share = (time.perf_counter() - began) / len(checks)
        return [Result(c, n, share) for c, n in zip(checks, got)]

    with ThreadPoolExecutor(max_workers=threads) as pool:
        for results in pool.map(run, _jobs([c for c in suite if c not in known], tables)):
            known.update((r.check, r) for r in results)
    return [known[c] for c in suite]


def report(spark: SparkSession, results: Sequence[Result]) -> DataFrame:
    """The report of ``run_checks`` with ``execution_time``, seconds of each check."""
    rows = []
    for r in results:
        c = r.check
        status = "pass" if not r.failures else "error" if c.severity == ERROR else "warn"
        rows.append((c.check_name, c.table, c.kind, c.severity, r.failures, status,
                     f"got {r.failures} failing rows" if r.failures else None, r.seconds))
    return spark.createDataFrame(rows, "check_name string, table_name string, kind string, severity string, "
                                       "failures long, status string, message string, execution_time double")


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame, fail_on: Sequence[str] = ("error",)) -> DataFrame:
    """Raise when a check failed with a status in ``fail_on`` ("error", "warn");
    return the report otherwise.

    Collects the report only: one row per check, bounded by the suite size.
    """
    failed = [r["check_name"] for r in report.where(F.col("status").isin(*fail_on)).select("check_name").collect()]
    if failed:
        raise QualityGateError(f"quality gate failed: {', '.join(sorted(failed))}")
    return report


def store_failures(check: Check, tables: dict[str, DataFrame], root: str, mode: str = "overwrite") -> str:
    """Write a check's failing rows to ``root/check=<name>`` (Parquet)."""
    path = f"{root.rstrip('/')}/check={check.check_name}"
    failing_rows(check, tables).write.mode(mode).parquet(path)
    return path
