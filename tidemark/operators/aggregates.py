"""Child-to-parent aggregations used by the marts.

Each one collapses a child table to one row per parent key before any join,
which keeps the marts at their grain and lets the map side combine a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import money_sum


def item_summary(order_items: DataFrame) -> DataFrame:
    return order_items.groupBy("order_id").agg(
        F.count("*").alias("item_line_count"),
        money_sum(order_items, "price").alias("total_product_value"),
        money_sum(order_items, "freight_value").alias("total_freight_value"),
    )


def payment_summary(order_payments: DataFrame) -> DataFrame:
    return order_payments.groupBy("order_id").agg(
        F.count("*").alias("payment_count"),
        money_sum(order_payments, "payment_value").alias("total_payment_value"),
    )


def review_summary(order_reviews: DataFrame) -> DataFrame:
    return order_reviews.groupBy("order_id").agg(
        F.count("*").alias("review_count"),
        F.round(F.avg("review_score"), 2).alias("average_review_score"),
    )


def customer_order_summary(fact_orders: DataFrame) -> DataFrame:
    bought = "order_purchase_timestamp"
    return fact_orders.groupBy("customer_id").agg(
        F.count("*").alias("order_count"),
        money_sum(fact_orders, "total_product_value").alias("total_product_value"),
        F.min(bought).alias("first_order_timestamp"),
        F.max(bought).alias("last_order_timestamp"),
    )


def product_sales_summary(order_items: DataFrame) -> DataFrame:
    """Sales per product. Spark spreads the distinct count over
    (product_id, order_id) first, so a best-seller is not one task."""
    return order_items.groupBy("product_id").agg(
        F.count("*").alias("order_line_count"),
        F.countDistinct("order_id").alias("order_count"),
        money_sum(order_items, "price").alias("total_product_value"),
        money_sum(order_items, "freight_value").alias("total_freight_value"),
    )
