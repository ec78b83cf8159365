"""Queries for checks, audits and contracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators import audit, contracts
from changeflow.operators import expectations as ex
from changeflow.plans.checks import GOLD_CHECKS
from changeflow.plans.gold import GOLD_ORDER_SUMMARY
from changeflow.plans.shop import ORDER_ITEMS, ORDER_STATUSES, ORDERS, PRODUCTS, TABLES, ShopTable
from changeflow.workload import sql
from changeflow.workload.derive import base_rows, order_item_events, table
from changeflow.workload.registry import query
from changeflow.workload.state import gold_of, silver_of

# Faults by key, as expressions that both engines read; every rule meets some.
GOLD_FAULTS = {
    "order_id": "CASE WHEN order_id % 101 = 0 THEN NULL ELSE order_id END",
    "customer_id": "CASE WHEN order_id % 107 = 0 THEN NULL ELSE customer_id END",
    "status": "CASE WHEN order_id % 89 = 0 THEN concat('lost-', CAST(order_id % 31 AS VARCHAR(9))) ELSE status END",
    "total_amount_cents": "CASE WHEN order_id % 109 = 0 THEN -1 ELSE total_amount_cents END",
    "item_count": "CASE WHEN order_id % 113 = 0 THEN -1 ELSE item_count END",
}


def table_faults(t: ShopTable) -> dict[str, str]:
    """Nulls, texts that are too long, numbers that are too small, values that are not unique, keys that are gone."""
    whens: dict[str, list[str]] = {}
    for i, c in enumerate(t.not_null):
        whens.setdefault(c, []).append(f"WHEN {t.key} % {41 + 2 * i} = 0 THEN NULL")
    for c, n in t.max_length:
        whens.setdefault(c, []).append(f"WHEN {t.key} % 27 = 0 THEN repeat('x', {n + 1})")
    for c, n in t.at_least:
        whens.setdefault(c, []).append(f"WHEN {t.key} % 29 = 0 THEN {n - 1}")
    for c in t.unique:
        if c != t.key:
            whens.setdefault(c, []).append(f"WHEN {t.key} % 37 = 0 THEN 'same'")
    return {c: f"CASE {' '.join(w)} ELSE {c} END" for c, w in whens.items()}


def broken(rows: DataFrame, key: str, faults: dict[str, str]) -> DataFrame:
    """The same as :func:`changeflow.workload.sql.broken`."""
    twice = rows.unionByName(rows.where(f"{key} % 103 = 0"))
    return twice.selectExpr(*[f"{faults[c]} AS {c}" if c in faults else c for c in rows.columns])


BROKEN_GOLD = sql.broken(sql.gold(), "order_id", GOLD_FAULTS)
BROKEN_SILVER = {n: sql.broken(sql.silver(n), t.key, table_faults(t)) for n, t in TABLES.items()}


def broken_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broken(gold_of(spark, sf_dir), "order_id", GOLD_FAULTS)


def broken_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t.name: broken(silver_of(spark, sf_dir, t), t.key, table_faults(t)) for t in TABLES.values()}


ALLOWED_SQL = ", ".join(f"'{s}'" for s in ORDER_STATUSES)


def _check_sql(name: str, column: str, evaluated: str, unexpected: str) -> str:
    return (
        f"SELECT '{name}' AS expectation, '{column}' AS \"column\", 'critical' AS severity, "
        f"CAST({evaluated} AS BIGINT) AS evaluated, CAST({unexpected} AS BIGINT) AS unexpected, "
        f"{unexpected} = 0 AS success FROM g"
    )


CHECK_SQL = {
    ("not_null", "order_id"): _check_sql("not_null", "order_id", "count(*)", "count(*) FILTER (order_id IS NULL)"),
    ("unique", "order_id"): _check_sql(
        "unique",
        "order_id",
        "count(order_id)",
        "(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM g WHERE order_id IS NOT NULL GROUP BY order_id) "
        "WHERE n > 1)",
    ),
    ("not_null", "customer_id"): _check_sql(
        "not_null", "customer_id", "count(*)", "count(*) FILTER (customer_id IS NULL)"
    ),
    ("in_set", "status"): _check_sql(
        "in_set", "status", "count(status)", f"count(*) FILTER (status NOT IN ({ALLOWED_SQL}))"
    ),
    ("between", "total_amount_cents"): _check_sql(
        "between", "total_amount_cents", "count(total_amount_cents)", "count(*) FILTER (total_amount_cents < 0)"
    ),
    ("between", "item_count"): _check_sql(
        "between", "item_count", "count(item_count)", "count(*) FILTER (item_count < 0)"
    ),
}


def _report_sql(*names: str) -> str:
    picked = [v for (name, _), v in CHECK_SQL.items() if not names or name in names]
    return f"WITH g AS MATERIALIZED ({BROKEN_GOLD}) " + sql.union_all(picked)


def _report(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return ex.report(broken_gold(spark, sf_dir), [c for c in GOLD_CHECKS if not names or c.name in names])


@query(_report_sql("not_null"))
def expect_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "not_null")


@query(_report_sql("unique"))
def expect_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "unique")


@query(_report_sql("in_set"))
def expect_status_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "in_set")


@query(_report_sql("between"))
def expect_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "between")


@query(_report_sql())
def expectation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir)


@query(
    f"SELECT bool_and(success) AS success, count(*) FILTER (NOT success) AS failed_expectations FROM ({_report_sql()})"
)
def checkpoint_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.verdict(_report(spark, sf_dir))


@query(
    f"""WITH bad AS (SELECT status AS value, count(*) AS n FROM ({BROKEN_GOLD}) WHERE status NOT IN ({ALLOWED_SQL}) GROUP BY status)
        SELECT value, n, (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM bad) AS all_rows, (SELECT count(*) FROM bad) AS all_values
        FROM bad ORDER BY value LIMIT 20"""
)
def unexpected_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.unexpected_sample(broken_gold(spark, sf_dir), ex.in_set("status", ORDER_STATUSES))


def _column_tests_sql() -> str:
    models = {f"silver_{n}": q for n, q in BROKEN_SILVER.items()} | {"gold_order_summary": BROKEN_GOLD}
    ctes = ", ".join(f"{m} AS MATERIALIZED ({q})" for m, q in models.items())
    parts = []
    for model, tests in audit.COLUMN_TESTS.items():
        for column, names in tests:
            for test in names:
                failures = (
                    f"(SELECT count(*) FROM {model} WHERE {column} IS NULL)"
                    if test == "not_null"
                    else f"(SELECT count(*) FROM (SELECT {column} FROM {model} WHERE {column} IS NOT NULL "
                    f"GROUP BY {column} HAVING count(*) > 1))"
                )
                parts.append(
                    f"SELECT '{model}' AS \"table\", '{column}' AS \"column\", '{test}' AS test, {failures} AS failures"
                )
    return f"WITH {ctes} " + sql.union_all(parts)


@query(_column_tests_sql())
def column_tests_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = {f"silver_{n}": df for n, df in broken_silver(spark, sf_dir).items()}
    return audit.column_tests(models | {"gold_order_summary": broken_gold(spark, sf_dir)})


@query(
    sql.union_all(
        [
            f"""SELECT '{t.name}' AS child, '{fk}' AS fk, count(*) AS orphans FROM ({sql.silver(t.name)}) c
                WHERE {fk} IS NOT NULL AND NOT EXISTS
                  (SELECT 1 FROM ({sql.silver(parent)}) p WHERE p.{TABLES[parent].key} = c.{fk})"""
            for t in TABLES.values()
            for fk, parent in t.references
        ]
    )
)
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.fk_orphans({t.name: silver_of(spark, sf_dir, t) for t in TABLES.values()})


def _constraints_sql() -> str:
    parts = []
    for t in TABLES.values():
        rules = [(f"not_null {c}", f"count(*) FILTER ({c} IS NULL)") for c in t.not_null]
        rules += [
            (
                f"unique {c}",
                f"(SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM "
                f"(SELECT count(*) AS n FROM {t.name}_s WHERE {c} IS NOT NULL GROUP BY {c}) WHERE n > 1)",
            )
            for c in t.unique
        ]
        rules += [(f"max_length {c}", f"count(*) FILTER (length({c}) > {n})") for c, n in t.max_length]
        rules += [(f"between {c}", f"count(*) FILTER ({c} < {n})") for c, n in t.at_least]
        parts += [
            f"SELECT '{t.name}' AS \"table\", '{r}' AS rule, CAST(max({e}) AS BIGINT) AS violations FROM {t.name}_s"
            if r.startswith("unique")
            else f"SELECT '{t.name}' AS \"table\", '{r}' AS rule, {e} AS violations FROM {t.name}_s"
            for r, e in rules
        ]
    ctes = ", ".join(f"{n}_s AS MATERIALIZED ({q})" for n, q in BROKEN_SILVER.items())
    return f"WITH {ctes} " + sql.union_all(parts)


@query(_constraints_sql())
def source_constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.source_constraints(broken_silver(spark, sf_dir))


# The mart's declaration with one column wrong on purpose.
WRONG_CONTRACT = GOLD_ORDER_SUMMARY.replace("customer_name string", "customer_name int")
CONTRACT_SQL = (
    ("order_id", "bigint", "0"),
    ("customer_id", "bigint", "0"),
    ("customer_name", "int", "count(*) FILTER (customer_name IS NOT NULL AND TRY_CAST(customer_name AS INT) IS NULL)"),
    ("customer_email", "string", "0"),
    ("status", "string", "0"),
    ("placed_at", "timestamp", "0"),
    ("item_count", "bigint", "0"),
    ("total_amount_cents", "bigint", "0"),
)


@query(
    f"WITH g AS MATERIALIZED ({sql.gold()}) "
    + sql.union_all(
        [
            f"SELECT '{c}' AS \"column\", '{t}' AS expected, count({c}) AS evaluated, "
            f"CAST({lost} AS BIGINT) AS not_castable FROM g"
            for c, t, lost in CONTRACT_SQL
        ]
    )
)
def gold_contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.castability(gold_of(spark, sf_dir), WRONG_CONTRACT)


@query(
    f"SELECT true AS shape_ok, count(*) FILTER (status NOT IN ({ALLOWED_SQL})) = 0 AS values_ok FROM ({sql.gold()})"
)
def layer_disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The misspelt status passes the shape contract and fails the value check."""
    mart = gold_of(spark, sf_dir)
    declared = contracts.T.StructType.fromDDL(GOLD_ORDER_SUMMARY)
    shape_ok = not contracts.shape_differences(mart.schema, declared)
    checked = ex.report(mart, [ex.in_set("status", ORDER_STATUSES)])
    return ex.verdict(checked).select(F.lit(shape_ok).alias("shape_ok"), F.col("success").alias("values_ok"))


CONTRACTS = {t.name: t.image for t in (PRODUCTS, ORDERS, ORDER_ITEMS)}


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row images as JSON text, with faults by product key; customers have no contract."""
    k = F.col("product_id")
    price = F.when(k % 11 == 0, F.concat(F.lit('"'), F.col("price_cents").cast("string"), F.lit('"'))).when(
        k % 23 == 0, F.lit("true")
    ).when(k % 29 == 0, F.lit("null")).otherwise(F.col("price_cents").cast("string"))
    text = F.concat(
        F.lit('{"product_id":'), k.cast("string"),
        F.when(k % 17 != 0, F.concat(F.lit(',"sku":"'), F.col("sku"), F.lit('"'))).otherwise(F.lit("")),
        F.lit(',"name":"'), F.col("name"),
        F.lit('","price_cents":'), price,
        F.when(k % 19 == 0, F.lit(',"legacy_code":1')).otherwise(F.lit("")),
        F.lit(',"category":"'), F.col("category"), F.lit('"'),
        F.when(k % 31 != 0, F.lit("}")).otherwise(F.lit("")),
    )
    products = base_rows(spark, sf_dir, "products").select(F.lit("products").alias("subject"), text.alias("value"))

    def plain(name: str) -> DataFrame:
        rows = base_rows(spark, sf_dir, name).drop("base_ms")
        return rows.select(F.lit(name).alias("subject"), F.to_json(F.struct("*")).alias("value"))

    items = order_item_events(table(spark, sf_dir, "lineitem")).select("before.*")
    items = items.select(F.lit("order_items").alias("subject"), F.to_json(F.struct("*")).alias("value"))
    return reduce(DataFrame.unionByName, [products, plain("orders"), plain("customers"), items])


@query(
    """WITH p AS (SELECT p_partkey AS k FROM part),
            readable AS (SELECT k FROM p WHERE k % 31 <> 0),
            v AS (
              SELECT 'products' AS subject, '*' AS field, 'unreadable' AS verdict FROM p WHERE k % 31 = 0
              UNION ALL SELECT 'products', f, 'ok' FROM readable, (VALUES ('product_id'), ('name'), ('category')) t(f)
              UNION ALL SELECT 'products', 'sku', CASE WHEN k % 17 = 0 THEN 'missing' ELSE 'ok' END FROM readable
              UNION ALL SELECT 'products', 'price_cents',
                     CASE WHEN k % 11 = 0 OR k % 23 = 0 THEN 'type_mismatch' ELSE 'ok' END FROM readable
              UNION ALL SELECT 'products', 'legacy_code', 'extra' FROM readable WHERE k % 19 = 0
              UNION ALL SELECT 'orders', f, 'ok' FROM orders,
                     (VALUES ('order_id'), ('customer_id'), ('status'), ('placed_at'), ('updated_at')) t(f)
              UNION ALL SELECT 'order_items', f, 'ok' FROM lineitem,
                     (VALUES ('order_item_id'), ('order_id'), ('product_id'), ('quantity'), ('unit_price_cents')) t(f)
              UNION ALL SELECT 'customers', '*', 'unchecked' FROM customer)
       SELECT subject, field, verdict, count(*) AS n FROM v GROUP BY ALL"""
)
def schema_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.conformance(_payloads(spark, sf_dir), CONTRACTS)


@query(
    """WITH v AS (
         SELECT 'products' AS subject,
                CASE WHEN p_partkey % 31 = 0 THEN '*' WHEN p_partkey % 17 = 0 THEN 'sku'
                     WHEN p_partkey % 11 = 0 OR p_partkey % 23 = 0 THEN 'price_cents' ELSE '*' END AS field,
                CASE WHEN p_partkey % 31 = 0 OR p_partkey % 17 = 0 OR p_partkey % 11 = 0 OR p_partkey % 23 = 0
                     THEN 'quarantined' ELSE 'accepted' END AS verdict
         FROM part
         UNION ALL SELECT 'orders', '*', 'accepted' FROM orders
         UNION ALL SELECT 'order_items', '*', 'accepted' FROM lineitem
         UNION ALL SELECT 'customers', '*', 'accepted' FROM customer)
       SELECT subject, field, verdict, count(*) AS n FROM v GROUP BY ALL"""
)
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        contracts.quarantine(_payloads(spark, sf_dir), CONTRACTS)
        .groupBy("subject", "field", "verdict")
        .agg(F.count("*").alias("n"))
    )


# Versions of two contracts by product key; the second subject takes any change.
VERSIONS = (
    ("products", 0, "product_id bigint, price int", None, ()),
    ("products", 50, "product_id bigint, price bigint", None, ()),
    ("products", 120, "product_id bigint, price double, tags array<string>", None, ("tags",)),
    ("prices", 20, "product_id bigint, price int", "NONE", ()),
    ("prices", 50, "product_id bigint, price decimal(12,2)", None, ()),
    ("prices", 120, "product_id bigint, price boolean", None, ()),
)


@query(
    """WITH p AS (SELECT s AS subject, p_partkey AS k,
                         CASE WHEN p_partkey >= 120 THEN 3 WHEN p_partkey >= 50 THEN 2
                              WHEN s = 'products' OR p_partkey >= 20 THEN 1 END AS version,
                         CASE WHEN p_partkey % 11 = 0 THEN 'text' WHEN p_partkey % 13 = 0 THEN 'large'
                              WHEN p_partkey % 7 = 0 THEN 'cents' WHEN p_partkey % 5 = 0 THEN 'mills' ELSE 'int' END AS price
                  FROM part, (VALUES ('products'), ('prices')) t(s)),
            v AS (
              SELECT subject, version, '*' AS field, 'unchecked' AS verdict FROM p WHERE version IS NULL
              UNION ALL SELECT subject, version, 'product_id', 'ok' FROM p WHERE version IS NOT NULL
              UNION ALL SELECT subject, version, 'price',
                     CASE WHEN price = 'text' OR (subject = 'prices' AND version = 3) THEN 'type_mismatch'
                          WHEN version = 1 THEN CASE price WHEN 'large' THEN 'out_of_range' WHEN 'int' THEN 'ok' ELSE 'type_mismatch' END
                          WHEN subject = 'prices' THEN CASE price WHEN 'mills' THEN 'out_of_range' ELSE 'ok' END
                          WHEN version = 2 THEN CASE WHEN price IN ('cents', 'mills') THEN 'type_mismatch' ELSE 'ok' END
                          ELSE 'ok' END
              FROM p WHERE version IS NOT NULL
              UNION ALL SELECT subject, version, 'tags',
                     CASE WHEN subject = 'prices' OR version < 3 THEN 'extra' WHEN k % 3 = 0 THEN 'type_mismatch' ELSE 'ok' END
              FROM p WHERE version IS NOT NULL AND k % 3 < 2
              UNION ALL SELECT subject, version, 'tags', 'missing' FROM p WHERE subject = 'products' AND version = 3 AND k % 3 = 2)
       SELECT subject, version, field, verdict, count(*) AS n FROM v GROUP BY ALL"""
)
def contract_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices as text, too large, with cents and with mills; tags of both kinds or none; judged by the version of their time."""
    registry = contracts.empty_registry(spark)
    for subject, since, contract, rule, defaults in VERSIONS:
        registry = registry.unionByName(contracts.register(registry, subject, since, contract, rule, defaults))
    k = F.col("product_id")
    price = (
        F.when(k % 11 == 0, '"12"').when(k % 13 == 0, "3000000000").when(k % 7 == 0, "12.75").when(k % 5 == 0, "12.345")
        .otherwise(F.col("price_cents").cast("string"))
    )
    tags = F.when(k % 3 == 0, ',"tags":["a",1]').when(k % 3 == 1, ',"tags":["a",null]').otherwise("")
    text = F.concat(F.lit('{"product_id":'), k.cast("string"), F.lit(',"price":'), price, tags, F.lit("}"))
    subject = F.explode(F.array(F.lit("products"), F.lit("prices"))).alias("subject")
    rows = base_rows(spark, sf_dir, "products").select(subject, k.alias("position"), text.alias("value"))
    return contracts.versioned_conformance(rows, registry, 1000)
