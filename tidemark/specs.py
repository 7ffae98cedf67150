"""Declarative description of the nine source tables.

Everything the layers need to know about a table is data here: how it is
loaded, its keys, its high-water-mark column, which strings are trimmed and
which quality rules apply. The layer code itself is generic.
"""

from __future__ import annotations

from dataclasses import dataclass

INCREMENTAL = "incremental"
STATIC = "static"


@dataclass(frozen=True)
class Rule:
    """A named predicate (Spark SQL text); the row fails where it is true."""

    reason: str
    predicate: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    load: str
    keys: tuple[str, ...]
    watermark: str | None = None
    trimmed: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    # Where a table can be keyed on NULL-able columns without a rule that
    # rejects the NULLs, merges still use plain equality (SQL MERGE semantics).
    bronze_keys: tuple[str, ...] | None = None
    # Key columns by which published tables are split into parts. Tables that
    # share them (an order and its children) are split alike.
    part_by: tuple[str, ...] = ()

    @property
    def ingest_keys(self) -> tuple[str, ...]:
        return self.keys if self.bronze_keys is None else self.bronze_keys

    @property
    def is_incremental(self) -> bool:
        return self.load == INCREMENTAL


def _null(column: str, reason: str) -> Rule:
    return Rule(reason, f"{column} IS NULL")


# Keys, load types, trimmed columns, rule order and reason
# strings define the result of the validation and must stay as they are.
CUSTOMERS = TableSpec(
    name="customers",
    load=INCREMENTAL,
    keys=("customer_id",),
    watermark="updated_at",
    part_by=("customer_id",),
    trimmed=("customer_city", "customer_state"),
    rules=(
        _null("customer_id", "missing_customer_id"),
        Rule("invalid_zip_code", "customer_zip_code_prefix NOT BETWEEN 0 AND 99999"),
        Rule("missing_customer_state", "coalesce(trim(customer_state), '') = ''"),
    ),
)

ORDERS = TableSpec(
    name="orders",
    load=INCREMENTAL,
    keys=("order_id",),
    watermark="updated_at",
    part_by=("order_id",),
    trimmed=("order_status",),
    # Timestamp anomalies are profiled, not rejected.
    rules=(_null("order_id", "missing_order_id"),),
)

ORDER_ITEMS = TableSpec(
    name="order_items",
    load=INCREMENTAL,
    keys=("order_id", "order_item_id"),
    watermark="updated_at",
    part_by=("order_id",),
    rules=(
        _null("order_id", "missing_order_id"),
        _null("order_item_id", "missing_order_item_id"),
        _null("product_id", "missing_product_id"),
        _null("seller_id", "missing_seller_id"),
        _null("shipping_limit_date", "missing_shipping_limit_date"),
        _null("price", "missing_price"),
        _null("freight_value", "missing_freight_value"),
        Rule("negative_price", "price < 0"),
        Rule("negative_freight_value", "freight_value < 0"),
    ),
)

ORDER_PAYMENTS = TableSpec(
    name="order_payments",
    load=INCREMENTAL,
    keys=("order_id", "payment_sequential"),
    watermark="updated_at",
    part_by=("order_id",),
    trimmed=("payment_type",),
    rules=(Rule("invalid_payment_installments", "payment_installments <= 0"),),
)

ORDER_REVIEWS = TableSpec(
    name="order_reviews",
    load=INCREMENTAL,
    # One review may belong to several orders, so the pair is the key in every
    # layer; keying the ingest on review_id alone would lose sibling rows.
    keys=("review_id", "order_id"),
    watermark="updated_at",
    part_by=("order_id",),
    trimmed=("review_comment_title", "review_comment_message"),
    rules=(
        Rule("invalid_review_score", "review_score NOT BETWEEN 1 AND 5"),
        Rule("answer_before_creation", "review_answer_timestamp < review_creation_date"),
    ),
)

PRODUCTS = TableSpec(
    name="products",
    load=STATIC,
    keys=("product_id",),
    trimmed=("product_category_name",),
    rules=(
        _null("product_id", "missing_product_id"),
        _null("product_weight_g", "missing_product_weight"),
        _null("product_length_cm", "missing_product_length"),
        _null("product_height_cm", "missing_product_height"),
        _null("product_width_cm", "missing_product_width"),
        Rule("invalid_product_weight", "product_weight_g <= 0"),
        Rule("invalid_product_length", "product_length_cm <= 0"),
        Rule("invalid_product_height", "product_height_cm <= 0"),
        Rule("invalid_product_width", "product_width_cm <= 0"),
    ),
)

SELLERS = TableSpec(
    name="sellers",
    load=STATIC,
    keys=("seller_id",),
    trimmed=("seller_city", "seller_state"),
)

GEOLOCATION = TableSpec(
    name="geolocation",
    load=STATIC,
    keys=(),  # no key: whole-row duplicates are removed
    trimmed=("geolocation_city", "geolocation_state"),
)

TRANSLATION = TableSpec(
    name="product_category_name_translation",
    load=STATIC,
    keys=("product_category_name",),
    trimmed=("product_category_name", "product_category_name_english"),
)

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        CUSTOMERS,
        ORDERS,
        ORDER_ITEMS,
        ORDER_PAYMENTS,
        ORDER_REVIEWS,
        GEOLOCATION,
        TRANSLATION,
        PRODUCTS,
        SELLERS,
    )
}
