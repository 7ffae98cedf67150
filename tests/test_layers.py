"""Bronze, Silver and Gold runs over two and more batches."""

import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows, ts
from tidemark.plans.bronze import LOADED, MERGED, SKIPPED, UNCHANGED, ingest, run_bronze
from tidemark.plans.marts import run_gold
from tidemark.plans.pipeline import run_pipeline
from tidemark.plans.silver import refine
from tidemark.sources import FrameSource
from tidemark.specs import TABLES
from tidemark.warehouse import Warehouse

ORDERS = TABLES["orders"]
PAYMENTS = TABLES["order_payments"]
PAYMENT_SCHEMA = (
    "order_id string, payment_sequential int, payment_type string, payment_installments int,"
    " payment_value decimal(12,2), updated_at timestamp_ntz"
)


@pytest.fixture
def house(spark, tmp_path):
    return Warehouse(spark, root=str(tmp_path), namespace=f"l{uuid.uuid4().hex[:8]}_")


def payments(spark, *data):
    full = [(o, s, " card ", i, Decimal("1.00"), ts(f"2020-01-{d:02d}")) for o, s, i, d in data]
    return spark.createDataFrame(full, PAYMENT_SCHEMA)


def load(house, spec, df):
    how = ingest(house, FrameSource({spec.name: df}), spec)
    refine(house, spec)
    return how


def silver(house, *columns):
    return rows(house.read("silver", "order_payments"), *columns)


def test_first_load_then_merge(spark, house):
    assert load(house, PAYMENTS, payments(spark, ("a", 1, 1, 1), ("b", 1, 0, 2))) == LOADED
    assert silver(house, "order_id", "payment_type") == [("a", "card")]
    second = payments(spark, ("a", 1, 4, 3), ("b", 1, 0, 2), ("c", 1, 2, 4))
    assert load(house, PAYMENTS, second) == MERGED
    assert silver(house, "order_id", "payment_installments") == [("a", 4), ("c", 2)]
    # Bronze keeps what came, untrimmed and unjudged.
    assert house.read("bronze", "order_payments").filter("payment_type = ' card '").count() == 3


def test_rerun_changes_nothing(spark, house):
    df = payments(spark, ("a", 1, 1, 1), ("b", 1, 0, 2), ("c", 1, 2, 2))
    load(house, PAYMENTS, df)
    before = silver(house), rows(house.read("quarantine", "order_payments"))
    load(house, PAYMENTS, df)
    assert (silver(house), rows(house.read("quarantine", "order_payments"))) == before


def test_nothing_new_rewrites_nothing(spark, house):
    df = payments(spark, ("a", 1, 1, 1), ("b", 1, 0, 2), ("c", 1, 2, 2))
    load(house, PAYMENTS, df)
    layers = ("bronze", "silver", "quarantine")
    before = [house.snapshot(layer, "order_payments") for layer in layers]
    assert load(house, PAYMENTS, df) == UNCHANGED
    assert [house.snapshot(layer, "order_payments") for layer in layers] == before
    # A valid change leaves the quarantine table alone.
    more = payments(spark, ("a", 1, 1, 1), ("b", 1, 0, 2), ("c", 1, 2, 2), ("d", 1, 2, 3))
    assert load(house, PAYMENTS, more) == MERGED
    after = [house.snapshot(layer, "order_payments") for layer in layers]
    assert after[:2] != before[:2] and after[2] == before[2]


def test_late_rows_below_the_mark_are_skipped(spark, house):
    load(house, PAYMENTS, payments(spark, ("a", 1, 1, 5)))
    load(house, PAYMENTS, payments(spark, ("a", 1, 1, 5), ("late", 1, 1, 4), ("edge", 1, 1, 5)))
    assert silver(house, "order_id") == [("a",), ("edge",)]


def test_repaired_and_spoiled_rows(spark, house):
    load(house, PAYMENTS, payments(spark, ("fix", 1, 0, 1), ("bad", 1, 3, 1)))
    load(house, PAYMENTS, payments(spark, ("fix", 1, 2, 2), ("bad", 1, -1, 2)))
    # The repaired row enters Silver and stays listed; the spoiled row's last
    # good version stays in Silver.
    assert silver(house, "order_id", "payment_installments") == [("bad", 3), ("fix", 2)]
    listed = rows(house.read("quarantine", "order_payments"), "order_id", "payment_installments")
    assert listed == [("bad", -1), ("fix", 0)]


def test_an_empty_silver_table_does_not_stall(spark, house):
    load(house, PAYMENTS, payments(spark, ("a", 1, 0, 1)))
    assert silver(house) == []
    load(house, PAYMENTS, payments(spark, ("a", 1, 5, 2)))
    assert silver(house, "order_id", "payment_installments") == [("a", 5)]


def test_missing_keys_do_not_pile_up_in_quarantine(spark, house):
    schema = "order_id string, order_status string, updated_at timestamp_ntz"
    data = [(None, "x", ts("2020-01-01")), (None, "y", ts("2020-01-02")), ("a", "z", ts("2020-01-02"))]
    df = spark.createDataFrame(data, schema)
    for _ in range(3):
        load(house, ORDERS, df)
    assert rows(house.read("quarantine", "orders"), "order_status") == [("y",)]


def test_a_repeated_source_key_fails_the_merge(spark, house):
    load(house, PAYMENTS, payments(spark, ("a", 1, 1, 1)))
    with pytest.raises(Exception, match="several source rows"):
        load(house, PAYMENTS, payments(spark, ("a", 1, 1, 1), ("a", 1, 2, 1)))
    assert silver(house, "order_id", "payment_installments") == [("a", 1)]


def test_reviews_shared_by_orders_keep_their_siblings(spark, house):
    spec = TABLES["order_reviews"]
    schema = (
        "review_id string, order_id string, review_score int, review_comment_title string,"
        " review_comment_message string, review_creation_date timestamp_ntz,"
        " review_answer_timestamp timestamp_ntz, updated_at timestamp_ntz"
    )

    def reviews(*data):
        t = ts("2020-01-01")
        return spark.createDataFrame(
            [(r, o, s, "", "", t, t, ts(f"2020-01-{d:02d}")) for r, o, s, d in data], schema
        )

    load(house, spec, reviews(("r", "a", 1, 1), ("r", "b", 2, 1)))
    load(house, spec, reviews(("r", "a", 5, 2), ("r", "b", 2, 1)))
    got = rows(house.read("silver", "order_reviews"), "order_id", "review_score")
    assert got == [("a", 5), ("b", 2)]


def test_static_tables_load_once_unless_refreshed(spark, house):
    spec = TABLES["sellers"]
    schema = "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string"
    one = FrameSource({"sellers": spark.createDataFrame([("s", 1, " c ", "x")], schema)})
    two = FrameSource({"sellers": spark.createDataFrame([("t", 1, "d", "x")], schema)})
    assert ingest(house, one, spec) == LOADED
    assert ingest(house, two, spec) == SKIPPED
    refine(house, spec)
    assert rows(house.read("silver", "sellers"), "seller_id", "seller_city") == [("s", "c")]
    assert ingest(house, two, spec, refresh=True) == LOADED
    refine(house, spec)
    assert rows(house.read("silver", "sellers"), "seller_id") == [("t",)]


def test_change_batch_reaches_gold(spark, house):
    """20 new orders, 10 new customers and 10 status updates: +20 / +10 / 0 rows."""
    from tidemark.operators.dedup import latest_per_key
    from tidemark.verify.queries import Shop

    shop = Shop(spark, "/root/testdata/sf0.001")
    state = {}
    for name, spec in TABLES.items():
        df = shop.source(name)
        state[name] = latest_per_key(df, spec.keys, spec.watermark) if spec.keys else df
    first = run_pipeline(house, FrameSource(state))

    # The change set, written out: ids far above those of the tables, one line and
    # one payment for each order, and ten open orders moved on.
    now = "TIMESTAMP_NTZ '2030-01-01 00:00:00'"
    customers = house.read("silver", "customers")
    known = [r["customer_id"] for r in customers.orderBy("customer_id").limit(10).collect()]
    place = customers.orderBy("customer_id").first()
    new_customers = spark.range(900_000_000, 900_000_010).selectExpr(
        "id AS customer_id", "id AS customer_unique_id",
        f"{place['customer_zip_code_prefix']!r} AS customer_zip_code_prefix",
        f"{place['customer_city']!r} AS customer_city", f"{place['customer_state']!r} AS customer_state",
        f"{now} AS created_at", f"{now} AS updated_at")
    buyers = [*known, *range(900_000_000, 900_000_010)]
    new_orders = spark.createDataFrame(
        [(900_000_000 + i, buyer) for i, buyer in enumerate(buyers)], "order_id long, customer_id long"
    ).selectExpr(
        "*", "'created' AS order_status", f"{now} AS order_purchase_timestamp",
        "CAST(NULL AS TIMESTAMP_NTZ) AS order_approved_at", "CAST(NULL AS TIMESTAMP_NTZ) AS order_delivered_carrier_date",
        "CAST(NULL AS TIMESTAMP_NTZ) AS order_delivered_customer_date", f"{now} AS order_estimated_delivery_date",
        f"{now} AS created_at", f"{now} AS updated_at")
    sold = house.read("silver", "order_items").orderBy("order_id", "order_item_id").first()
    new_items = new_orders.selectExpr(
        "order_id", "1 AS order_item_id", f"{sold['product_id']!r} AS product_id", f"{sold['seller_id']!r} AS seller_id",
        f"{now} AS shipping_limit_date", "100.00 AS price", "9.50 AS freight_value", f"{now} AS created_at", f"{now} AS updated_at")
    new_payments = new_orders.selectExpr(
        "order_id", "1 AS payment_sequential", "'voucher' AS payment_type", "1 AS payment_installments",
        "109.50 AS payment_value", f"{now} AS created_at", f"{now} AS updated_at")
    moved = (
        house.read("silver", "orders").filter("order_status = 'shipped'").orderBy("order_id").limit(10)
        .withColumns({"order_status": F.lit("delivered"), "updated_at": F.expr(now)})
    )
    after = dict(state)
    for name, fresh in (
        ("customers", new_customers),
        ("orders", new_orders.unionByName(moved.select(*new_orders.columns))),
        ("order_items", new_items),
        ("order_payments", new_payments),
    ):
        keys = list(TABLES[name].keys)
        old = state[name].join(fresh.select(*keys), keys, "left_anti")
        after[name] = old.unionByName(fresh.select(*[
            F.col(f.name).cast(f.dataType) for f in state[name].schema.fields
        ]))
    second = run_pipeline(house, FrameSource(after))
    assert {t: second[t] - first[t] for t in first} == {
        "fact_orders": 20,
        "customer_summary": 10,
        "product_summary": 0,
    }
    fact = house.read("gold", "fact_orders")
    assert fact.select("order_id").distinct().count() == second["fact_orders"]
    new = fact.filter("order_id >= 900000000")
    assert new.filter("item_line_count = 1 AND payment_count = 1").count() == 20
    assert new.filter(
        "total_payment_value = total_product_value + total_freight_value"
    ).count() == 20
    assert moved.count() == 10


def keyed(spark, *data):
    return FrameSource({"orders": spark.createDataFrame(
        [(k, status, ts(f"2020-01-0{day}")) for k, status, day in data],
        "order_id string, order_status string, updated_at timestamp_ntz")})


def test_every_row_of_a_key_is_updated(spark, house):
    """An older row of the key, below the mark, takes the newest values too."""
    source = keyed(spark, ("k", "old", 1), ("k", "new", 5), ("z", "new", 2))
    assert ingest(house, source, TABLES["orders"]) == LOADED
    assert ingest(house, source, TABLES["orders"]) == MERGED
    assert rows(house.read("bronze", "orders"), "order_id", "order_status") == [
        ("k", "new"), ("k", "new"), ("z", "new")]
    assert ingest(house, source, TABLES["orders"]) == UNCHANGED


def test_several_source_rows_for_a_known_key_are_an_error(spark, house):
    source = keyed(spark, ("k", "a", 5), ("k", "b", 5))
    assert ingest(house, source, TABLES["orders"]) == LOADED
    with pytest.raises(Exception, match="several source rows"):
        ingest(house, source, TABLES["orders"])


def test_bronze_covers_all_tables(spark, house):
    from tidemark.verify.queries import Shop

    shop = Shop(spark, "/root/testdata/sf0.001")
    source = FrameSource({n: shop.source(n) for n in ("sellers", "geolocation")})
    specs = [TABLES["sellers"], TABLES["geolocation"]]
    assert run_bronze(house, source, specs) == {"sellers": LOADED, "geolocation": LOADED}
    assert run_bronze(house, source, specs) == {"sellers": SKIPPED, "geolocation": SKIPPED}


def test_gold_edge_cases(spark, house):
    """Orders without children, customers without orders, unsold products, orphans."""
    t = ts("2020-01-01")
    house.overwrite("silver", "orders", spark.createDataFrame(
        [("o1", "c1", "delivered", t, t, t, t, t), ("o2", "gone", "created", t, None, None, None, t)],
        "order_id string, customer_id string, order_status string,"
        " order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,"
        " order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,"
        " order_estimated_delivery_date timestamp_ntz"))
    house.overwrite("silver", "order_items", spark.createDataFrame(
        [("o1", 1, "p1", "2.50", "1.00"), ("o1", 2, "p1", "2.50", "1.00"), ("o1", 3, "px", "9", "9")],
        "order_id string, order_item_id int, product_id string, price string, freight_value string",
    ).withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("price", "freight_value")}))
    house.overwrite("silver", "order_payments", payments(spark, ("o1", 1, 1, 1), ("o1", 2, 1, 1)))
    house.overwrite("silver", "order_reviews", spark.createDataFrame(
        [("r1", "o1", 5), ("r2", "o1", 4), ("r3", "o1", 4)],
        "review_id string, order_id string, review_score int"))
    house.overwrite("silver", "customers", spark.createDataFrame(
        [("c1", "u1", 1, "x", "y"), ("c2", "u2", 1, "x", "y")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int,"
        " customer_city string, customer_state string"))
    house.overwrite("silver", "products", spark.createDataFrame(
        [("p1", "n", 1, 1, 1, 1, 1), ("p2", "n", 1, 1, 1, 1, 1)],
        "product_id string, product_category_name string, product_photos_qty int,"
        " product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int"))
    assert run_gold(house) == {"fact_orders": 2, "customer_summary": 2, "product_summary": 2}
    money = ["item_line_count", "total_product_value", "payment_count", "total_payment_value",
             "review_count", "average_review_score"]
    assert rows(house.read("gold", "fact_orders"), "order_id", *money) == [
        ("o1", 3, Decimal("14.00"), 2, Decimal("2.00"), 3, 4.33),
        ("o2", 0, None, 0, None, 0, None),
    ]
    assert rows(house.read("gold", "customer_summary"), "customer_id", "order_count",
                "total_product_value", "last_order_timestamp") == [
        ("c1", 1, Decimal("14.00"), t), ("c2", 0, Decimal("0.00"), None)]
    assert rows(house.read("gold", "product_summary"), "product_id", "order_line_count",
                "order_count", "total_product_value", "total_freight_value") == [
        ("p1", 2, 1, Decimal("5.00"), Decimal("2.00")), ("p2", 0, 0, Decimal("0.00"), Decimal("0.00"))]
    assert dict(house.read("gold", "fact_orders").dtypes)["total_product_value"] == "decimal(18,2)"
