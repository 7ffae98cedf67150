"""Gold marts as pure DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.columns import money_or_zero, or_zero
from tidemark.operators.aggregates import (
    customer_order_summary,
    item_summary,
    payment_summary,
    product_sales_summary,
    review_summary,
)

# The columns of the marts.
ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
CUSTOMER_COLUMNS = (
    "customer_id",
    "customer_unique_id",
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
)
PRODUCT_COLUMNS = (
    "product_id",
    "product_category_name",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)


def fact_orders(
    orders: DataFrame, order_items: DataFrame, order_payments: DataFrame, order_reviews: DataFrame
) -> DataFrame:
    """One row per order. Counts are 0 without children; sums and the average stay NULL.

    All joins and all child aggregates hash on order_id, so orders are shuffled
    once and each child once, after its map-side combine.
    """
    wide = orders.select(*ORDER_COLUMNS)
    for child in (
        item_summary(order_items),
        payment_summary(order_payments),
        review_summary(order_reviews),
    ):
        wide = wide.join(child, "order_id", "left")
    return wide.select(
        *ORDER_COLUMNS,
        or_zero("item_line_count").alias("item_line_count"),
        "total_product_value",
        "total_freight_value",
        or_zero("payment_count").alias("payment_count"),
        "total_payment_value",
        or_zero("review_count").alias("review_count"),
        "average_review_score",
    )


def customer_summary(customers: DataFrame, fact: DataFrame) -> DataFrame:
    """One row per customer; without orders the count and value are 0, the dates NULL.

    The value is item value without freight.
    """
    joined = customers.select(*CUSTOMER_COLUMNS).join(
        customer_order_summary(fact), "customer_id", "left"
    )
    return joined.select(
        *CUSTOMER_COLUMNS,
        or_zero("order_count").alias("order_count"),
        money_or_zero("total_product_value").alias("total_product_value"),
        "first_order_timestamp",
        "last_order_timestamp",
    )


def product_summary(products: DataFrame, order_items: DataFrame) -> DataFrame:
    """One row per product; unsold products have zeros everywhere."""
    joined = products.select(*PRODUCT_COLUMNS).join(
        product_sales_summary(order_items), "product_id", "left"
    )
    return joined.select(
        *PRODUCT_COLUMNS,
        or_zero("order_line_count").alias("order_line_count"),
        or_zero("order_count").alias("order_count"),
        money_or_zero("total_product_value").alias("total_product_value"),
        money_or_zero("total_freight_value").alias("total_freight_value"),
    )
