"""The order mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.operators.skew import hot_keys, salted_left_join

# The mart's declared columns and types.
GOLD_ORDER_SUMMARY = (
    "order_id bigint, customer_id bigint, customer_name string, customer_email string, status string, "
    "placed_at timestamp, item_count bigint, total_amount_cents bigint"
)


def orders_with_customer(orders: DataFrame, customers: DataFrame, hot_customers: DataFrame | None = None) -> DataFrame:
    """Every order with its customer's name and address, NULL where the customer is gone.

    ``hot_customers`` may come from any cheaper frame that holds the same keys, such as the raw log.
    """
    people = customers.select(
        "customer_id", F.col("full_name").alias("customer_name"), F.col("email").alias("customer_email")
    )
    hot = hot_keys(orders, "customer_id") if hot_customers is None else hot_customers
    return salted_left_join(orders, people, "customer_id", spread_by="order_id", hot=hot)


def order_totals(items: DataFrame) -> DataFrame:
    """Items and money per order, partly summed before the shuffle so that a huge order costs little."""
    line = F.col("quantity").cast("bigint") * F.col("unit_price_cents").cast("bigint")
    return items.groupBy("order_id").agg(
        F.count("order_item_id").alias("item_count"), F.sum(line).alias("total_amount_cents")
    )


def gold_order_summary(
    orders: DataFrame, customers: DataFrame, items: DataFrame, hot_customers: DataFrame | None = None
) -> DataFrame:
    """One row per order: customer, status, number of items, total.

    Orders and customers hold a key at most once, so summing the items first gives what grouping the
    joined rows would, without carrying names through an aggregate.
    """
    return gold_from_totals(orders, customers, order_totals(items), hot_customers)


def gold_from_totals(
    orders: DataFrame, customers: DataFrame, totals: DataFrame, hot_customers: DataFrame | None = None
) -> DataFrame:
    """The mart from totals that hold an order at most once; an order without totals has no items."""
    hot = hot_keys(orders, "customer_id") if hot_customers is None else hot_customers
    summed = orders.select("order_id", "customer_id", "status", "placed_at").join(
        totals, "order_id", "left"
    )
    return orders_with_customer(summed, customers, hot).select(
        "order_id",
        "customer_id",
        "customer_name",
        "customer_email",
        "status",
        "placed_at",
        F.coalesce("item_count", F.lit(0)).cast("bigint").alias("item_count"),
        F.coalesce("total_amount_cents", F.lit(0)).cast("bigint").alias("total_amount_cents"),
    )
