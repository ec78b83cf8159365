"""The shop domain: row images, keys, constraints and references of the four captured tables."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ShopTable:
    """One captured table. ``image`` is the row image as it travels: times are ISO-8601 text."""

    name: str
    key: str
    image: str
    columns: tuple[str, ...]
    times: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    max_length: tuple[tuple[str, int], ...] = ()
    at_least: tuple[tuple[str, int], ...] = ()
    references: tuple[tuple[str, str], ...] = ()


# Column names, lengths, bounds and references of the source tables.
CUSTOMERS = ShopTable(
    name="customers",
    key="customer_id",
    image="customer_id bigint, email string, full_name string, country string, signup_at string",
    columns=("email", "full_name", "country", "signup_at"),
    times=("signup_at",),
    not_null=("customer_id", "email", "full_name", "signup_at", "country"),
    unique=("customer_id", "email"),
    max_length=(("email", 255), ("full_name", 255), ("country", 2)),
)
PRODUCTS = ShopTable(
    name="products",
    key="product_id",
    image="product_id bigint, sku string, name string, price_cents bigint, category string",
    columns=("sku", "name", "price_cents", "category"),
    not_null=("product_id", "sku", "name", "price_cents", "category"),
    unique=("product_id", "sku"),
    max_length=(("sku", 64), ("name", 255), ("category", 100)),
    at_least=(("price_cents", 0),),
)
ORDERS = ShopTable(
    name="orders",
    key="order_id",
    image="order_id bigint, customer_id bigint, status string, placed_at string, updated_at string",
    columns=("customer_id", "status", "placed_at", "updated_at"),
    times=("placed_at", "updated_at"),
    not_null=("order_id", "customer_id", "status", "placed_at", "updated_at"),
    unique=("order_id",),
    max_length=(("status", 32),),
    references=(("customer_id", "customers"),),
)
ORDER_ITEMS = ShopTable(
    name="order_items",
    key="order_item_id",
    image="order_item_id bigint, order_id bigint, product_id bigint, quantity int, unit_price_cents bigint",
    columns=("order_id", "product_id", "quantity", "unit_price_cents"),
    not_null=("order_item_id", "order_id", "product_id", "quantity", "unit_price_cents"),
    unique=("order_item_id",),
    at_least=(("quantity", 1),),
    references=(("order_id", "orders"), ("product_id", "products")),
)
TABLES = {t.name: t for t in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS)}

ORDER_STATUSES = ("placed", "shipped", "delivered", "cancelled")
