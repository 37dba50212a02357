"""Declarative data-quality scorecard.

A check counts rows that break a rule and compares the count with what is
expected. All checks of all tables run in one pass over each table and share one
shuffle of counted keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.operators import one_scan


@dataclass(frozen=True)
class Check:
    """One scorecard line. ``kind`` selects which of the other fields apply.

    rows        count of all rows
    where       count of rows meeting the SQL condition
    format      count of rows whose ``columns[0]`` misses the pattern
    window      count of rows whose ``columns[0]`` lies outside [lo, hi)
    duplicates  rows minus distinct non-NULL keys over ``columns``
    orphans     rows meeting the condition without a partner in ``other``;
                ``columns`` and ``other_columns`` are SQL expressions
    groups      groups over ``columns`` meeting the ``having`` condition on n
    """

    name: str
    table: str
    kind: str = "where"
    condition: str | None = None
    columns: tuple[str, ...] = ()
    pattern: str = ""
    lo: str = ""
    hi: str = ""
    other: str = ""
    other_columns: tuple[str, ...] = ()
    having: str = ""
    expected: int = 0
    group: str = "CLEAN"
    family: str = ""
    notes: str = ""
    # Further (table, condition) pairs whose counts are added to this one.
    more: tuple[tuple[str, str], ...] = field(default=())


def _condition(check: Check) -> str:
    """Which rows a row-level check counts."""
    if check.kind == "rows":
        return "true"
    if check.kind == "format":
        return f"NOT {check.columns[0]} RLIKE r'{check.pattern}'"
    if check.kind == "window":
        ts = check.columns[0]
        return f"{ts} < TIMESTAMP_NTZ '{check.lo}' OR {ts} >= TIMESTAMP_NTZ '{check.hi}'"
    return check.condition


def _questions(check: Check) -> Iterable[one_scan.Question]:
    if check.kind == "duplicates":
        yield one_scan.spare_rows(check.name, check.table, check.columns)
    elif check.kind == "orphans":
        yield one_scan.orphans(
            check.name, check.table, check.columns, check.other, check.other_columns, check.condition
        )
    elif check.kind == "groups":
        yield one_scan.groups(check.name, check.table, check.columns, check.having, check.condition)
    else:
        yield one_scan.holds(check.name, check.table, _condition(check))
        for table, condition in check.more:
            yield one_scan.holds(check.name, table, condition)


def observed_counts(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """(check_name, observed_count) of every check, from one scan per table and one shuffle."""
    questions = [q for check in checks for q in _questions(check)]
    return one_scan.answers(tables, questions).select(
        F.col("name").alias("check_name"), F.col("observed").alias("observed_count")
    )


def scorecard(
    tables: Mapping[str, DataFrame],
    checks: Iterable[Check],
    expected_counts: DataFrame | None = None,
) -> DataFrame:
    """(check_group, check_name, observed_count, expected_count, result, notes).

    ``expected_counts`` (check_name, expected_count) replaces the declared
    expectation where it has a row.
    """
    checks = list(checks)
    observed = observed_counts(tables, checks)
    spark = observed.sparkSession
    # One row per declared check: bounded by the catalogue, not by the data.
    catalogue = spark.createDataFrame(
        [(c.group, c.name, c.expected, c.notes) for c in checks],
        "check_group string, check_name string, declared bigint, notes string",
    )
    lines = observed.join(F.broadcast(catalogue), "check_name")
    if expected_counts is None:
        lines = lines.withColumn("expected_count", F.col("declared"))
    else:
        lines = lines.join(expected_counts, "check_name", "left").withColumn(
            "expected_count", F.coalesce("expected_count", "declared")
        )
    passed = F.col("observed_count") == F.col("expected_count")
    return lines.select(
        "check_group",
        "check_name",
        "observed_count",
        "expected_count",
        F.when(passed, "PASS").otherwise("FAIL").alias("result"),
        "notes",
    )
