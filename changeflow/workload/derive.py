"""Change logs derived from the driver tables, by the rules of FIXTURES.md.

Each log is one narrow pass over its table: a row is exploded into its events, nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changeflow.plans.shop import TABLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso(ms: str) -> str:
    return f"date_format(timestamp_millis({ms}), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


# Row images as SQL expressions over the driver table, with the time of a row's first event.
SOURCE_TABLE = {"customers": "customer", "products": "part", "orders": "orders", "order_items": "lineitem"}
BASE_ROWS = {
    "customers": (
        "c_custkey AS customer_id",
        "concat(lower(replace(c_name, '#', '.')), '@example.com') AS email",
        "c_name AS full_name",
        "lpad(cast(c_nationkey AS string), 2, '0') AS country",
        f"{iso('1700000000000 + c_custkey * 1000')} AS signup_at",
        "1700000000000 + c_custkey * 1000 AS base_ms",
    ),
    "products": (
        "p_partkey AS product_id",
        "concat('SKU-', cast(p_partkey AS string)) AS sku",
        "p_name AS name",
        "cast(rint(p_retailprice * 100) AS bigint) AS price_cents",
        "p_type AS category",
        "1700000000000 + p_partkey * 1000 AS base_ms",
    ),
    "orders": (
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'placed' ELSE 'shipped' END AS status",
        f"{iso('unix_millis(cast(o_orderdate AS timestamp))')} AS placed_at",
        f"{iso('unix_millis(cast(o_orderdate AS timestamp))')} AS updated_at",
        "unix_millis(cast(o_orderdate AS timestamp)) AS base_ms",
    ),
}
UPDATES = {
    "customers": {"full_name": "concat(full_name, ' (renamed)')"},
    "products": {"price_cents": "price_cents + 100"},
    "orders": {
        "status": "if(order_id % 97 = 0, 'shpped', 'cancelled')",
        "updated_at": iso("base_ms + 60000"),
    },
}
# When an event happens, and its op, shift in ms, step in the log, and images.
EVENTS = (
    ("true", "if(k % 2 = 0, 'r', 'c')", 0, 0, "", "row"),
    ("k % 5 = 0", "if(k % 2 = 0, 'r', 'c')", 0, 0, "", "row"),
    ("k % 3 = 0", "'u'", 60000, 1, "row", "updated"),
    ("k % 10 = 0", "'d'", 120000, 2, "row", ""),
    ("k % 20 = 0", "'c'", 180000, 3, "", "row"),
    ("k % 13 = 0", "'u'", -60000, 9, "row", "updated"),
)


def base_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Row images (times as text) with ``base_ms``."""
    return table(spark, sf_dir, SOURCE_TABLE[name]).selectExpr(*BASE_ROWS[name])


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The raw change log of one shop table."""
    if name == "order_items":
        return order_item_events(table(spark, sf_dir, "lineitem"))
    shop, changes = TABLES[name], UPDATES[name]

    def image(updated: bool) -> str:
        fields = [f"'{c}', {changes.get(c, c) if updated else c}" for c in (shop.key, *shop.columns)]
        return f"named_struct({', '.join(fields)})"

    events = ", ".join(
        f"if({when.replace('k', shop.key)}, struct({op.replace('k', shop.key)} AS op, {shift} AS shift_ms, "
        f"{step} AS step, '{before}' AS old, '{after}' AS new), null)"
        for when, op, shift, step, before, after in EVENTS
    )
    return (
        base_rows(spark, sf_dir, name)
        .selectExpr("*", f"inline(array({events}))")
        .where("op IS NOT NULL")
        .selectExpr(
            f"if(old = 'row', {image(False)}, null) AS before",
            f"CASE new WHEN 'row' THEN {image(False)} WHEN 'updated' THEN {image(True)} END AS after",
            "op",
            "base_ms + shift_ms AS ts_ms",
            f"named_struct('schema', 'shop', 'table', '{name}', 'lsn', {shop.key} * 10 + step, "
            "'ts_ms', base_ms + shift_ms) AS source",
        )
    )


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a stream of its files; the pattern fits a file as well as a folder."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def order_item_events(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as it is: repeated (order, line) pairs are successive versions of an item."""
    row = (
        "named_struct('order_item_id', l_orderkey * 10 + l_linenumber, 'order_id', l_orderkey, "
        "'product_id', l_partkey, 'quantity', cast(l_quantity AS int), "
        "'unit_price_cents', cast(rint(l_extendedprice * 100) AS bigint))"
    )
    ts_ms = "unix_millis(cast(l_shipdate AS timestamp))"
    return lineitem.selectExpr(
        f"{row} AS before",
        f"if(l_returnflag = 'R', null, {row}) AS after",
        "if(l_returnflag = 'R', 'd', 'u') AS op",
        f"{ts_ms} AS ts_ms",
        "named_struct('schema', 'shop', 'table', 'order_items', 'lsn', l_partkey * 1000000 + l_suppkey, "
        f"'ts_ms', {ts_ms}) AS source",
    )


def hot_customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer keys as they occur in the raw order log."""
    return table(spark, sf_dir, "orders").selectExpr("o_custkey AS customer_id")
