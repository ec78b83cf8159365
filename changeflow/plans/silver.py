"""Current-state tables of the shop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.iso8601 import parse_iso8601
from changeflow.operators.current_state import current_state, current_state_by_max
from changeflow.plans.shop import CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS, ShopTable


def silver(bronze: DataFrame, table: ShopTable) -> DataFrame:
    """Times are parsed on the surviving rows only."""
    return with_times(current_state(bronze, table.key, table.columns), table)


def silver_by_max(bronze: DataFrame, table: ShopTable) -> DataFrame:
    return with_times(current_state_by_max(bronze, table.key, table.columns), table)


def with_times(rows: DataFrame, table: ShopTable) -> DataFrame:
    return rows.withColumns({t: parse_iso8601(F.col(t)) for t in table.times})


def silver_customers(bronze: DataFrame) -> DataFrame:
    return silver(bronze, CUSTOMERS)


def silver_products(bronze: DataFrame) -> DataFrame:
    return silver(bronze, PRODUCTS)


def silver_orders(bronze: DataFrame) -> DataFrame:
    return silver(bronze, ORDERS)


def silver_order_items(bronze: DataFrame) -> DataFrame:
    return silver(bronze, ORDER_ITEMS)
