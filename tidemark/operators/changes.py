"""What incremental batches are drawn from: pairs sold before, orders still open."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The states in which an order still moves.
OPEN_STATUSES = ("created", "approved", "processing", "shipped")


def product_seller_pairs(order_items: DataFrame) -> DataFrame:
    """Distinct (product, seller) pairs that were sold together."""
    known = F.col("product_id").isNotNull() & F.col("seller_id").isNotNull()
    return order_items.filter(known).select("product_id", "seller_id").distinct()


def orders_in(orders: DataFrame, statuses: Sequence[str] = OPEN_STATUSES) -> DataFrame:
    """Orders in one of the given states; the list is pushed down to the scan."""
    return orders.filter(F.col("order_status").isin(list(statuses)))
