"""Declarative data-quality checks evaluated as DataFrame jobs.

Row-level checks on one table (not null, accepted values, accepted range) are
folded into a single aggregate of ``count_if`` expressions: one pass over the
table however many checks there are.  Key checks (unique, unique combination)
are one grouped count each; relationship checks are one anti join each.

Every check yields a report row ``(table_name, check_name, column_name,
severity, failures, status)``; ``status`` is ``pass`` when nothing failed,
otherwise ``warn`` or ``fail`` by the check's severity.  Nulls pass value and
range checks, as in the usual declarative-test semantics.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import constants as C
from stationlake.functions.columns import ts_lit
from stationlake.schemas import DQ_REPORT_DDL

REPORT_COLUMNS = ["table_name", "check_name", "column_name", "severity", "failures", "status"]


@dataclass(frozen=True)
class Check:
    kind: str  # not_null | unique | unique_combination | accepted_values | accepted_range | relationships
    columns: tuple[str, ...]
    severity: str = "error"
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    parent: DataFrame | None = field(default=None, compare=False, hash=False)
    parent_column: str | None = None

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)


def not_null(col: str, severity: str = "error") -> Check:
    return Check("not_null", (col,), severity)


def unique(col: str, severity: str = "error") -> Check:
    return Check("unique", (col,), severity)


def unique_combination(cols: Sequence[str], severity: str = "error") -> Check:
    return Check("unique_combination", tuple(cols), severity)


def accepted_values(col: str, values: Sequence, severity: str = "error") -> Check:
    return Check("accepted_values", (col,), severity, values=tuple(values))


def accepted_range(col: str, min_value=None, max_value=None, severity: str = "error") -> Check:
    return Check("accepted_range", (col,), severity, min_value=min_value, max_value=max_value)


def relationships(col: str, parent: DataFrame, parent_column: str, severity: str = "error") -> Check:
    return Check("relationships", (col,), severity, parent=parent, parent_column=parent_column)


ROW_LEVEL = ("not_null", "accepted_values", "accepted_range")


def violation(check: Check) -> Column:
    """Boolean column: true on a failing row (row-level checks only)."""
    c = F.col(check.columns[0])
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(*check.values)
    if check.kind == "accepted_range":
        bad = F.lit(False)
        if check.min_value is not None:
            bad = bad | (c < F.lit(check.min_value))
        if check.max_value is not None:
            bad = bad | (c > F.lit(check.max_value))
        return c.isNotNull() & bad
    raise ValueError(f"not a row-level check: {check.kind}")


def _status(failures: Column, severity: Column) -> Column:
    return F.when(failures == 0, F.lit("pass")).when(severity == "warn", F.lit("warn")).otherwise(
        F.lit("fail")
    )


def _report_row(table_name: str, check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(table_name).alias("table_name"),
        F.lit(check.kind).alias("check_name"),
        F.lit(check.column_name).alias("column_name"),
        F.lit(check.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
    )


def row_checks(checks: Sequence[Check]) -> list[Check]:
    """Those that look at one row at a time."""
    return [c for c in checks if c.kind in ROW_LEVEL]


def failing(check: Check) -> Column:
    """Aggregate: rows that a row-level check finds wrong."""
    return F.count_if(violation(check))


def result_row(table_name: str, check: Check, failures: int) -> tuple:
    """The report row of a check whose failures were counted elsewhere."""
    status = "pass" if failures == 0 else "warn" if check.severity == "warn" else "fail"
    return (table_name, check.kind, check.column_name, check.severity, int(failures), status)


def run_checks(table_name: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate ``checks`` on ``df``; returns one report row per check."""
    parts: list[DataFrame] = []
    row_level = row_checks(checks)
    if row_level:
        counts = df.agg(*[failing(c).alias(f"c{i}") for i, c in enumerate(row_level)])
        rows = F.array(
            *[_report_row(table_name, c, F.col(f"c{i}")) for i, c in enumerate(row_level)]
        )
        parts.append(counts.select(F.explode(rows).alias("r")).select("r.*"))
    for c in checks:
        if c.kind in ("unique", "unique_combination"):
            # a single-column unique check ignores nulls; a combination keeps them
            keyed = df.where(F.col(c.columns[0]).isNotNull()) if c.kind == "unique" else df
            dupes = (
                keyed.groupBy(*c.columns)
                .agg(F.count(F.lit(1)).alias("n"))
                .agg(F.count_if(F.col("n") > 1).alias("failures"))
            )
            parts.append(dupes.select(_report_row(table_name, c, F.col("failures")).alias("r")).select("r.*"))
        elif c.kind == "relationships":
            # Child rows are counted per key before the anti join, so a key
            # holding a large share of the table is one row per partition.
            child = (
                df.select(F.col(c.columns[0]).alias("__k"))
                .where(F.col("__k").isNotNull())
                .groupBy("__k")
                .agg(F.count(F.lit(1)).alias("__n"))
            )
            parent = c.parent.select(F.col(c.parent_column).alias("__k")).distinct()
            orphans = child.join(parent, "__k", "left_anti").agg(
                F.coalesce(F.sum("__n"), F.lit(0)).alias("failures")
            )
            parts.append(orphans.select(_report_row(table_name, c, F.col("failures")).alias("r")).select("r.*"))
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report.withColumn("status", _status(F.col("failures"), F.col("severity")))


def gate(report: DataFrame) -> DataFrame:
    """Fail the job that reads the report if an error-severity check failed (warnings pass)."""
    msg = F.format_string("data-quality check failed: %s.%s(%s) = %s rows",
                          "table_name", "check_name", "column_name", "failures")
    passed = F.coalesce(F.col("status") != "fail", F.lit(False))
    # The guard is a filter: a projected guard nobody reads would be pruned.
    return report.where(F.when(passed, F.lit(True)).otherwise(F.raise_error(msg).cast("boolean")))


def freshness(
    df: DataFrame,
    loaded_at: str,
    reference_time: dt.datetime | Column,
    keys: Sequence[str] = (),
    warn_hours: float = C.FRESHNESS_WARN_HOURS,
    error_hours: float = C.FRESHNESS_ERROR_HOURS,
) -> DataFrame:
    """Age of the newest load per key against a reference time: pass / warn / error."""
    agg = (df.groupBy(*keys) if keys else df.groupBy()).agg(F.max(loaded_at).alias("latest_loaded_at"))
    return _aged(agg, reference_time, warn_hours, error_hours)


def _aged(newest: DataFrame, reference_time: dt.datetime | Column, warn_hours: float, error_hours: float) -> DataFrame:
    ref = ts_lit(reference_time)
    age = (F.unix_micros(ref) - F.unix_micros(F.col("latest_loaded_at"))) / F.lit(3_600_000_000)
    status = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), F.lit("error"))
        .when(F.col("age_hours") > warn_hours, F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    return newest.withColumn("age_hours", age).withColumn("freshness", status)


def partition_freshness(
    table: DataFrame,
    loaded_at: str,
    day: str,
    reference_time: dt.datetime | str | Column,
    keys: Sequence[str],
    expected: DataFrame,
    warn_hours: float = C.FRESHNESS_WARN_HOURS,
    error_hours: float = C.FRESHNESS_ERROR_HOURS,
) -> DataFrame:
    """:func:`freshness` of a table partitioned by ``day``, the day of ``loaded_at``, for every key of ``expected``.

    Only partitions that can still be fresh are read.  Keys without a load in
    them are an error whatever came before; for these alone, and only if there
    are any, the older partitions are read for the time of their last load.  A
    key that was never loaded has none.
    """
    since = F.date_sub(F.to_date(ts_lit(reference_time)), math.ceil(error_hours / 24))
    newest = lambda rows: rows.groupBy(*keys).agg(F.max(loaded_at).alias("latest_loaded_at"))
    wanted = expected.select(*keys).distinct()
    found = newest(table.where(F.col(day) >= since)).join(wanted, list(keys), "left_semi")
    missing = wanted.join(found, list(keys), "left_anti")
    if not missing.isEmpty():
        older = newest(table.where(F.col(day) < since).join(missing, list(keys), "left_semi"))
        found = found.unionByName(missing.join(older, list(keys), "left"))
    return _aged(found, reference_time, warn_hours, error_hours)


def nonempty_guard(expected_keys: DataFrame, items: DataFrame, key: str, name: str = "items") -> DataFrame:
    """Per expected key, how many items it has; zero is a violation."""
    counts = items.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    out = expected_keys.select(key).distinct().join(counts, key, "left")
    n = F.coalesce(F.col(name), F.lit(0)).cast("bigint")
    return out.select(key, n.alias(name), F.when(n == 0, F.lit("fail")).otherwise(F.lit("pass")).alias("status"))


def with_run_id(report: DataFrame, run_id: str) -> DataFrame:
    return report.select(F.lit(run_id).alias("run_id"), *REPORT_COLUMNS)


def append_results(report: DataFrame, path: str) -> None:
    """Keep check results as a history table (one row per check per run)."""
    report.select([F.col(f.split(" ")[0]) for f in DQ_REPORT_DDL.split(", ")]).write.mode(
        "append"
    ).parquet(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DQ_REPORT_DDL).parquet(path)
