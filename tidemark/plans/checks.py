"""Named data checks per source table (fixed predicates, counted in one pass)."""

from __future__ import annotations

RANGE_CHECKS: dict[str, dict[str, str]] = {
    "customers": {
        "zip_out_of_range": "customer_zip_code_prefix NOT BETWEEN 0 AND 99999",
        "state_missing": "coalesce(customer_state, '') = ''",
    },
    "sellers": {"zip_out_of_range": "seller_zip_code_prefix NOT BETWEEN 0 AND 99999"},
    "order_items": {"price_negative": "price < 0", "freight_negative": "freight_value < 0"},
    "order_payments": {
        "value_negative": "payment_value < 0",
        "installments_not_positive": "payment_installments <= 0",
    },
    "order_reviews": {"score_out_of_range": "review_score NOT BETWEEN 1 AND 5"},
    "products": {
        "size_missing": (
            "product_weight_g IS NULL OR product_length_cm IS NULL"
            " OR product_height_cm IS NULL OR product_width_cm IS NULL"
        ),
        "size_not_positive": (
            "product_weight_g <= 0 OR product_length_cm <= 0"
            " OR product_height_cm <= 0 OR product_width_cm <= 0"
        ),
        "photos_negative": "product_photos_qty < 0",
        "text_length_negative": "product_name_lenght < 0 OR product_description_lenght < 0",
    },
    "geolocation": {
        "latitude_out_of_range": "geolocation_lat NOT BETWEEN -90 AND 90",
        "longitude_out_of_range": "geolocation_lng NOT BETWEEN -180 AND 180",
    },
}

TIME_ORDER_CHECKS: dict[str, dict[str, str]] = {
    "orders": {
        "approved_before_purchase": "order_approved_at < order_purchase_timestamp",
        "carrier_before_purchase": "order_delivered_carrier_date < order_purchase_timestamp",
        "delivered_before_purchase": "order_delivered_customer_date < order_purchase_timestamp",
        "delivered_before_carrier": (
            "order_delivered_customer_date < order_delivered_carrier_date"
        ),
    },
    "order_reviews": {
        "answer_before_creation": "review_answer_timestamp < review_creation_date"
    },
}

STATUS_CHECKS: dict[str, dict[str, str]] = {
    "orders": {
        "delivered_without_customer_date": (
            "order_status = 'delivered' AND order_delivered_customer_date IS NULL"
        ),
        "delivered_without_carrier_date": (
            "order_status = 'delivered' AND order_delivered_carrier_date IS NULL"
        ),
    }
}

#: All checks of a table, for `Warehouse(checks=...)` and `one_pass`.
ALL_CHECKS: dict[str, dict[str, str]] = {
    table: RANGE_CHECKS.get(table, {}) | TIME_ORDER_CHECKS.get(table, {}) | STATUS_CHECKS.get(table, {})
    for table in RANGE_CHECKS | TIME_ORDER_CHECKS | STATUS_CHECKS
}
