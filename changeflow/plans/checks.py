"""The value checks that gate the order mart."""

from __future__ import annotations

from changeflow.operators.expectations import at_least, in_set, not_null, unique
from changeflow.plans.shop import ORDER_STATUSES

# Which rule guards which column.
GOLD_CHECKS = (
    not_null("order_id"),
    unique("order_id"),
    not_null("customer_id"),
    in_set("status", ORDER_STATUSES),
    at_least("total_amount_cents", 0),
    at_least("item_count", 0),
)
