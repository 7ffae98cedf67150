"""Cross-mart reconciliation in one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOTAL = "decimal(28,2)"


def _total(df: DataFrame, column: str, dtype: str):
    return df.agg(F.coalesce(F.sum(column), F.lit(0)).cast(dtype).alias("total")).scalar()


def item_totals(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """One struct: the value of all items, and of those whose product is unknown.

    Items are summed per product before the join, so they are read once and a
    best-seller is one row in it.
    """
    per_product = order_items.groupBy("product_id").agg(F.sum("price").alias("value"))
    known = products.select("product_id").distinct().withColumn("known", F.lit(True))
    judged = per_product.join(known, "product_id", "left")

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0)).cast(_TOTAL)

    orphan = F.when(F.col("known").isNull(), F.col("value"))
    return judged.agg(
        F.struct(total(F.col("value")).alias("all_items"), total(orphan).alias("orphans")).alias("t")
    )


def reconciliation(
    customer_summary: DataFrame,
    fact_orders: DataFrame,
    product_summary: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
) -> DataFrame:
    """Totals that should agree, with their differences.

    The customer difference is the value of orders whose customer is not in
    Silver; the product totals differ from the item total by exactly the value
    of items whose product is not in Silver.
    """
    totals = customer_summary.agg(
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("summarized_order_count"),
        F.coalesce(F.sum("total_product_value"), F.lit(0))
        .cast(_TOTAL)
        .alias("customer_summary_total"),
    )
    items = item_totals(order_items, products).scalar()
    totals = totals.select(
        "*",
        _total(fact_orders, "total_product_value", _TOTAL).alias("fact_orders_total"),
        _total(product_summary, "total_product_value", _TOTAL).alias("product_summary_total"),
        items.alias("__items"),
    ).select(
        *[c for c in totals.columns],
        "fact_orders_total",
        "product_summary_total",
        F.col("__items.all_items").alias("order_items_total"),
        F.col("__items.orphans").alias("orphan_product_value"),
    )
    return totals.select(
        "*",
        (F.col("fact_orders_total") - F.col("customer_summary_total"))
        .cast(_TOTAL)
        .alias("customer_value_diff"),
        (
            F.col("order_items_total")
            - F.col("product_summary_total")
            - F.col("orphan_product_value")
        )
        .cast(_TOTAL)
        .alias("product_value_diff"),
    )
