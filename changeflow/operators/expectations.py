"""Value checks over a table, reported as rows.

A report is computed in one pass for all row-wise checks and one uniqueness check; further uniqueness
checks add one pass each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    """``bad`` is true of an unexpected value; None stands for uniqueness, which needs the whole table."""

    name: str
    column: str
    bad: Callable[[Column], Column] | None
    severity: str = "critical"
    ignores_null: bool = True

    def unexpected(self) -> Column:
        return self.bad(F.col(self.column))


def not_null(column: str, severity: str = "critical") -> Expectation:
    return Expectation("not_null", column, lambda v: v.isNull(), severity, ignores_null=False)


def unique(column: str, severity: str = "critical") -> Expectation:
    """NULLs are ignored."""
    return Expectation("unique", column, None, severity)


def in_set(column: str, allowed: Sequence[str], severity: str = "critical") -> Expectation:
    """NULL passes."""
    return Expectation("in_set", column, lambda v: ~v.isin(*allowed), severity)


def at_least(column: str, minimum: int, severity: str = "critical") -> Expectation:
    """A one-sided range. NULL passes."""
    return Expectation("between", column, lambda v: v < minimum, severity)


def max_length(column: str, limit: int, severity: str = "critical") -> Expectation:
    return Expectation("max_length", column, lambda v: F.length(v) > limit, severity)


def measure(df: DataFrame, checks: Sequence[Expectation]) -> DataFrame:
    """Per check: rows evaluated, unexpected rows and, for uniqueness, repeated values.

    The first uniqueness check groups the table by its column; the row-wise counters ride along in
    that aggregate, so the table is read once. Counters are combined before the shuffle, so a value
    that fills a third of the table is no burden.
    """
    row_wise = [c for c in checks if c.bad is not None]
    unique_columns = list(dict.fromkeys(c.column for c in checks if c.bad is None))
    counters = {f"bad_{i}": F.count_if(c.unexpected()) for i, c in enumerate(row_wise)}
    counters |= {f"seen_{c}": F.count(c) for c in dict.fromkeys(c.column for c in row_wise if c.ignores_null)}
    named = [v.alias(n) for n, v in counters.items()]
    rows = [
        _row(c, f"seen_{c.column}" if c.ignores_null else "`rows`", f"bad_{i}", f"bad_{i}")
        for i, c in enumerate(row_wise)
    ]

    if not unique_columns:
        return df.agg(F.count("*").alias("rows"), *named).selectExpr(_as_rows(rows))
    first, *others = unique_columns
    totals = (
        df.groupBy(first)
        .agg(F.count("*").alias("copies"), *named)
        .selectExpr("sum(copies) AS `rows`", *_repeats(first), *[f"sum({n}) AS {n}" for n in counters])
        .selectExpr(_as_rows(rows + _repeat_rows(checks, first)))
    )
    more = [
        df.groupBy(c)
        .agg(F.count("*").alias("copies"))
        .selectExpr(*_repeats(c))
        .selectExpr(_as_rows(_repeat_rows(checks, c)))
        for c in others
    ]
    return reduce(DataFrame.unionByName, more, totals)


def _repeats(column: str) -> list[str]:
    repeated = f"{column} IS NOT NULL AND copies > 1"
    return [
        f"sum(copies) FILTER (WHERE {column} IS NOT NULL) AS present",
        f"sum(copies) FILTER (WHERE {repeated}) AS repeated_rows",
        f"count(*) FILTER (WHERE {repeated}) AS repeated_values",
    ]


def _repeat_rows(checks: Sequence[Expectation], column: str) -> list[str]:
    return [
        _row(c, "present", "repeated_rows", "repeated_values") for c in checks if c.bad is None and c.column == column
    ]


def _row(c: Expectation, evaluated: str, unexpected: str, values: str) -> str:
    return (
        f"named_struct('expectation', '{c.name}', 'column', '{c.column}', 'severity', '{c.severity}', "
        f"'evaluated', coalesce({evaluated}, 0L), 'unexpected', coalesce({unexpected}, 0L), "
        f"'unexpected_values', coalesce({values}, 0L))"
    )


def _as_rows(rows: Sequence[str]) -> str:
    return f"inline(array({', '.join(rows)}))"


def report(df: DataFrame, checks: Sequence[Expectation]) -> DataFrame:
    """One row per expectation. A uniqueness check counts every row of a repeated value."""
    return measure(df, checks).select(
        "expectation", "column", "severity", "evaluated", "unexpected", (F.col("unexpected") == 0).alias("success")
    )


def verdict(results: DataFrame) -> DataFrame:
    """Whether all expectations of a report hold, and how many do not."""
    return results.agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
        F.count_if(~F.col("success")).alias("failed_expectations"),
    )


def unexpected_sample(df: DataFrame, check: Expectation, rows: int = 20) -> DataFrame:
    """The first unexpected values of a row-wise check and how often each occurs, beside the totals of all.

    ``all_rows`` and ``all_values`` count every unexpected row and value, also those past the shown ones.
    """
    counted = (
        df.where(check.unexpected()).groupBy(F.col(check.column).alias("value")).agg(F.count("*").alias("n"))
    )
    all_rows = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("x")).scalar()
    all_values = counted.agg(F.count("*").alias("x")).scalar()
    return (
        counted.orderBy("value").limit(rows).select("value", "n", all_rows.alias("all_rows"), all_values.alias("all_values"))
    )
