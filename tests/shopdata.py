"""Hand-made change logs for the shop."""

from changeflow.plans.shop import TABLES
from changeflow.sources.envelope import envelope_schema

# The seed rows of the source tables.
CUSTOMERS = [
    (1, "ada@example.com", "Ada Lovelace", "GB"),
    (2, "grace@example.com", "Grace Hopper", "US"),
    (3, "linus@example.com", "Linus Torvalds", "FI"),
    (4, "margaret@example.com", "Margaret Hamilton", "US"),
]
PRODUCTS = [
    (1, "SKU-001", "Mechanical Keyboard", 8999, "Electronics"),
    (2, "SKU-002", "USB-C Hub", 3499, "Electronics"),
    (3, "SKU-003", "Standing Desk", 45999, "Furniture"),
    (4, "SKU-004", "Notebook (3-pack)", 999, "Office"),
]
ORDERS = [(1, 1, "placed"), (2, 2, "shipped"), (3, 3, "placed")]
ORDER_ITEMS = [(1, 1, 1, 1, 8999), (2, 1, 2, 2, 3499), (3, 2, 3, 1, 45999), (4, 3, 4, 5, 999)]

NOON = "2026-08-12T12:00:00.123456Z"
T0 = 1_786_536_000_000


def rows_of(name):
    return {
        "customers": [(*r, NOON) for r in CUSTOMERS],
        "products": PRODUCTS,
        "orders": [(*r, NOON, NOON) for r in ORDERS],
        "order_items": ORDER_ITEMS,
    }[name]


def event(name, op, before=None, after=None, ts_ms=T0, lsn=1):
    return (before, after, op, ts_ms, ("shop", name, lsn, ts_ms))


def log(spark, name, events):
    return spark.createDataFrame(events, envelope_schema(TABLES[name].image))


def seed(spark, name, extra=()):
    """The snapshot of a table, then further events."""
    return log(spark, name, [event(name, "r", None, r, lsn=i) for i, r in enumerate(rows_of(name))] + list(extra))
