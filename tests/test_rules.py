"""Every validation rule, their order, and unknown values."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import ts
from tidemark.operators.quality import REASON, accepted, reason_counts, rejected, tagged
from tidemark.specs import TABLES

T0, T1 = ts("2020-01-01"), ts("2020-01-02")

SCHEMAS = {
    "customers": "customer_id string, customer_zip_code_prefix int, customer_state string",
    "orders": "order_id string, order_delivered_customer_date timestamp_ntz",
    "order_items": (
        "order_id string, order_item_id int, product_id string, seller_id string,"
        " shipping_limit_date timestamp_ntz, price int, freight_value int"
    ),
    "order_payments": "order_id string, payment_installments int",
    "order_reviews": (
        "review_score int, review_creation_date timestamp_ntz,"
        " review_answer_timestamp timestamp_ntz"
    ),
    "products": (
        "product_id string, product_weight_g int, product_length_cm int,"
        " product_height_cm int, product_width_cm int"
    ),
}
GOOD = {
    "customers": ("a", 10, "SP"),
    "orders": ("a", None),
    "order_items": ("a", 1, "p", "s", T0, 5, 1),
    "order_payments": ("a", 1),
    "order_reviews": (3, T0, T1),
    "products": ("p", 1, 1, 1, 1),
}


def bad(table, **changes):
    names = [c.split()[0] for c in SCHEMAS[table].split(",")]
    values = dict(zip(names, GOOD[table], strict=True))
    values.update(changes)
    return tuple(values[n] for n in names)


CASES = [
    ("customers", {}, None),
    ("customers", {"customer_id": None}, "missing_customer_id"),
    ("customers", {"customer_zip_code_prefix": -1}, "invalid_zip_code"),
    ("customers", {"customer_zip_code_prefix": 100000}, "invalid_zip_code"),
    ("customers", {"customer_zip_code_prefix": 99999}, None),
    ("customers", {"customer_zip_code_prefix": 0}, None),
    ("customers", {"customer_zip_code_prefix": None}, None),
    ("customers", {"customer_state": None}, "missing_customer_state"),
    ("customers", {"customer_state": "  "}, "missing_customer_state"),
    ("customers", {"customer_id": None, "customer_zip_code_prefix": -1}, "missing_customer_id"),
    ("customers", {"customer_zip_code_prefix": -1, "customer_state": ""}, "invalid_zip_code"),
    ("orders", {}, None),
    ("orders", {"order_id": None}, "missing_order_id"),
    ("order_items", {}, None),
    ("order_items", {"order_id": None}, "missing_order_id"),
    ("order_items", {"order_item_id": None}, "missing_order_item_id"),
    ("order_items", {"product_id": None}, "missing_product_id"),
    ("order_items", {"seller_id": None}, "missing_seller_id"),
    ("order_items", {"shipping_limit_date": None}, "missing_shipping_limit_date"),
    ("order_items", {"price": None}, "missing_price"),
    ("order_items", {"freight_value": None}, "missing_freight_value"),
    ("order_items", {"price": -1}, "negative_price"),
    ("order_items", {"freight_value": -1}, "negative_freight_value"),
    ("order_items", {"price": 0, "freight_value": 0}, None),
    ("order_items", {"price": -1, "freight_value": None}, "missing_freight_value"),
    ("order_items", {"price": -1, "freight_value": -1}, "negative_price"),
    ("order_payments", {}, None),
    ("order_payments", {"payment_installments": 0}, "invalid_payment_installments"),
    ("order_payments", {"payment_installments": None}, None),
    ("order_payments", {"order_id": None}, None),
    ("order_reviews", {}, None),
    ("order_reviews", {"review_score": 0}, "invalid_review_score"),
    ("order_reviews", {"review_score": 6}, "invalid_review_score"),
    ("order_reviews", {"review_score": None}, None),
    ("order_reviews", {"review_answer_timestamp": ts("2019-01-01")}, "answer_before_creation"),
    ("order_reviews", {"review_answer_timestamp": T0}, None),
    ("order_reviews", {"review_answer_timestamp": None}, None),
    ("products", {}, None),
    ("products", {"product_id": None}, "missing_product_id"),
    ("products", {"product_weight_g": None}, "missing_product_weight"),
    ("products", {"product_length_cm": None}, "missing_product_length"),
    ("products", {"product_height_cm": None}, "missing_product_height"),
    ("products", {"product_width_cm": None}, "missing_product_width"),
    ("products", {"product_weight_g": 0}, "invalid_product_weight"),
    ("products", {"product_length_cm": -1}, "invalid_product_length"),
    ("products", {"product_height_cm": 0}, "invalid_product_height"),
    ("products", {"product_width_cm": 0}, "invalid_product_width"),
    ("products", {"product_weight_g": 0, "product_width_cm": None}, "missing_product_width"),
]


@pytest.mark.parametrize("table", SCHEMAS)
def test_rules_of_table(spark, table):
    cases = [(changes, reason) for t, changes, reason in CASES if t == table]
    schema = "case int, " + SCHEMAS[table]
    data = [(i, *bad(table, **changes)) for i, (changes, _) in enumerate(cases)]
    judged = tagged(spark.createDataFrame(data, schema), TABLES[table].rules)
    got = {r["case"]: r[REASON] for r in judged.collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(cases)}


def test_every_rule_has_a_case():
    wanted = {rule.reason for spec in TABLES.values() for rule in spec.rules}
    assert wanted == {reason for _, _, reason in CASES if reason}
    assert sum(len(spec.rules) for spec in TABLES.values()) == 25


def test_split_is_a_partition_of_the_rows(spark):
    df = spark.range(100).select(
        F.col("id").cast("string").alias("order_id"), (F.col("id") % 7 - 1).cast("int").alias("payment_installments")
    )
    judged = tagged(df, TABLES["order_payments"].rules)
    good, broken = accepted(judged), rejected(judged)
    assert good.columns == df.columns
    assert broken.columns == [*df.columns, REASON]
    assert good.count() + broken.count() == 100
    counts = {r[REASON]: r["row_count"] for r in reason_counts(judged).collect()}
    assert counts == {None: good.count(), "invalid_payment_installments": broken.count()}


def test_tables_without_rules_pass_everything(spark):
    judged = tagged(spark.range(3), TABLES["sellers"].rules)
    assert accepted(judged).count() == 3
    assert rejected(judged).count() == 0
