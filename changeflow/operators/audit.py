"""Audits of constraints that only the source enforces."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.operators import expectations as ex
from changeflow.plans.shop import TABLES, ShopTable


def fk_orphans(tables: Mapping[str, DataFrame], declared: Mapping[str, ShopTable] = TABLES) -> DataFrame:
    """Per declared reference, how many child rows name a parent that does not exist.

    A NULL reference is no orphan. Every table is read once, for its references and as a parent: its rows
    are unfolded into the keys they name and the key they are. Both are counted per key before they are
    shuffled, so a parent named by a third of all rows costs one row per task, and there is no join.
    """
    links = [(t, fk, declared[parent]) for t in declared.values() for fk, parent in t.references]
    parts = []
    for t in declared.values():
        roles = [f"struct({i} AS link, {fk} AS k, 1L AS child)" for i, (child, fk, _) in enumerate(links) if child is t]
        roles += [f"struct({i} AS link, {t.key} AS k, 0L AS child)" for i, (_, _, parent) in enumerate(links) if parent is t]
        if roles:
            parts.append(tables[t.name].selectExpr(f"inline(array({', '.join(roles)}))"))
    counted = (
        reduce(DataFrame.unionByName, parts)
        .where("k IS NOT NULL")
        .groupBy("link", "k")
        .agg(F.sum("child").alias("n"), F.min("child").alias("least"))
    )
    totals = [f"sum(n) FILTER (WHERE least = 1 AND link = {i}) AS orphans_{i}" for i in range(len(links))]
    rows = [
        f"named_struct('child', '{t.name}', 'fk', '{fk}', 'orphans', coalesce(orphans_{i}, 0L))"
        for i, (t, fk, _) in enumerate(links)
    ]
    return counted.selectExpr(*totals).selectExpr(f"inline(array({', '.join(rows)}))")


def constraint_checks(table: ShopTable) -> list[ex.Expectation]:
    return [
        *[ex.not_null(c) for c in table.not_null],
        *[ex.unique(c) for c in table.unique],
        *[ex.max_length(c, n) for c, n in table.max_length],
        *[ex.at_least(c, n) for c, n in table.at_least],
    ]


def source_constraints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that break a NOT NULL, UNIQUE, length or bound rule of their source table.

    For UNIQUE every row of a repeated value counts.
    """
    parts = [
        ex.measure(df, constraint_checks(TABLES[name])).select(
            F.lit(name).alias("table"),
            F.concat_ws(" ", "expectation", "column").alias("rule"),
            F.col("unexpected").alias("violations"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# Which columns carry which test.
COLUMN_TESTS = {
    "silver_customers": (("customer_id", ("not_null", "unique")), ("email", ("not_null",))),
    "silver_products": (("product_id", ("not_null", "unique")),),
    "silver_orders": (("order_id", ("not_null", "unique")), ("customer_id", ("not_null",))),
    "silver_order_items": (
        ("order_item_id", ("not_null", "unique")),
        ("order_id", ("not_null",)),
        ("product_id", ("not_null",)),
    ),
    "gold_order_summary": (("order_id", ("not_null", "unique")), ("customer_id", ("not_null",))),
}


def column_tests(models: Mapping[str, DataFrame]) -> DataFrame:
    """Failures of every column test. ``unique`` counts repeated values, not their rows."""
    make = {"not_null": ex.not_null, "unique": ex.unique}
    parts = [
        ex.measure(df, [make[test](column) for column, tests in COLUMN_TESTS[name] for test in tests]).select(
            F.lit(name).alias("table"),
            "column",
            F.col("expectation").alias("test"),
            F.col("unexpected_values").alias("failures"),
        )
        for name, df in models.items()
    ]
    return reduce(DataFrame.unionByName, parts)
