"""SQL for the derived change logs and what follows from them, for the checking side."""

from __future__ import annotations

BASE = {
    "customers": """
        SELECT c_custkey AS k,
               lower(replace(c_name, '#', '.')) || '@example.com' AS email,
               c_name AS full_name,
               lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS country,
               1700000000000 + c_custkey * 1000 AS signup_at,
               1700000000000 + c_custkey * 1000 AS base_ms
        FROM customer""",
    "products": """
        SELECT p_partkey AS k, 'SKU-' || p_partkey AS sku, p_name AS name,
               CAST(round(p_retailprice * 100) AS BIGINT) AS price_cents, p_type AS category,
               1700000000000 + p_partkey * 1000 AS base_ms
        FROM part""",
    "orders": """
        SELECT o_orderkey AS k, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'placed' ELSE 'shipped' END AS status,
               epoch_ms(o_orderdate) AS placed_at, epoch_ms(o_orderdate) AS updated_at,
               epoch_ms(o_orderdate) AS base_ms
        FROM orders""",
}
COLUMNS = {
    "customers": ("email", "full_name", "country", "signup_at"),
    "products": ("sku", "name", "price_cents", "category"),
    "orders": ("customer_id", "status", "placed_at", "updated_at"),
    "order_items": ("order_id", "product_id", "quantity", "unit_price_cents"),
}
KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "order_item_id",
}
UPDATED = {
    "customers": {"full_name": "full_name || ' (renamed)'"},
    "products": {"price_cents": "price_cents + 100"},
    "orders": {
        "status": "CASE WHEN k % 97 = 0 THEN 'shpped' ELSE 'cancelled' END",
        "updated_at": "base_ms + 60000",
    },
}


def events(name: str) -> str:
    """Flat events: k, op, ts_ms, lsn, has_before, has_after and the columns of ``after``."""
    if name == "order_items":
        return """
        SELECT l_orderkey * 10 + l_linenumber AS k,
               CASE WHEN l_returnflag = 'R' THEN 'd' ELSE 'u' END AS op,
               epoch_ms(l_shipdate) AS ts_ms, l_partkey * 1000000 + l_suppkey AS lsn,
               true AS has_before, l_returnflag <> 'R' AS has_after,
               CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS order_id,
               CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS product_id,
               CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS INTEGER) END AS quantity,
               CASE WHEN l_returnflag <> 'R' THEN CAST(round(l_extendedprice * 100) AS BIGINT) END AS unit_price_cents
        FROM lineitem"""
    columns = COLUMNS[name]

    def part(op: str, shift: int, step: int, before: bool, after: str, where: str) -> str:
        if after == "none":
            values = [f"NULL AS {c}" for c in columns]
        elif after == "updated":
            values = [f"{UPDATED[name].get(c, c)} AS {c}" for c in columns]
        else:
            values = list(columns)
        return (
            f"SELECT k, {op} AS op, base_ms + {shift} AS ts_ms, k * 10 + {step} AS lsn, {before} AS has_before, "
            f"{after != 'none'} AS has_after, {', '.join(values)} FROM ({BASE[name]}) WHERE {where}"
        )

    first = "CASE WHEN k % 2 = 0 THEN 'r' ELSE 'c' END"
    return " UNION ALL ".join(
        [
            part(first, 0, 0, False, "row", "true"),
            part(first, 0, 0, False, "row", "k % 5 = 0"),
            part("'u'", 60000, 1, True, "updated", "k % 3 = 0"),
            part("'d'", 120000, 2, True, "none", "k % 10 = 0"),
            part("'c'", 180000, 3, False, "row", "k % 20 = 0"),
            part("'u'", -60000, 9, True, "updated", "k % 13 = 0"),
        ]
    )


def latest(name: str) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ("ts_ms", "lsn", "op", *COLUMNS[name]))
    return (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY {order}) AS rn "
        f"FROM ({events(name)})) WHERE rn = 1"
    )


def silver(name: str) -> str:
    return f"SELECT k AS {KEYS[name]}, {', '.join(COLUMNS[name])} FROM ({latest(name)}) WHERE op <> 'd'"


def gold() -> str:
    """Order totals first, then each order looks up its totals and its customer."""
    return f"""
        WITH sums AS (
          SELECT order_id, count(order_item_id) AS items, sum(CAST(quantity AS BIGINT) * unit_price_cents) AS cents
          FROM ({silver('order_items')}) GROUP BY order_id),
        people AS (SELECT customer_id, full_name, email FROM ({silver('customers')}))
        SELECT head.order_id, head.customer_id, people.full_name AS customer_name, people.email AS customer_email,
               head.status, head.placed_at, coalesce(sums.items, 0) AS item_count,
               CAST(coalesce(sums.cents, 0) AS BIGINT) AS total_amount_cents
        FROM ({silver('orders')}) AS head
        LEFT JOIN sums ON sums.order_id = head.order_id
        LEFT JOIN people ON people.customer_id = head.customer_id"""


def broken(rows: str, key: str, faults: dict[str, str]) -> str:
    """Rows with faults put in: those of every 103rd key twice, and columns replaced by their ``faults``."""
    twice = f"(SELECT * FROM ({rows}) UNION ALL SELECT * FROM ({rows}) WHERE {key} % 103 = 0)"
    return f"SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in faults.items())}) FROM {twice}"


def union_all(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)
