"""Marts brought up to date by part against full builds, and tables worked on together."""

import random
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of, rows, ts
from tidemark import layout as layout_module
from tidemark.plans import marts
from tidemark.plans.gold import customer_summary, fact_orders, product_summary
from tidemark.plans.marts import KEPT, REBUILT, REFRESHED, publish_customers, publish_fact, publish_products, sales_changes
from tidemark.plans.pipeline import run_pipeline
from tidemark.plans.together import NotStarted, Step, StepsFailed, run_together
from tidemark.sources import FrameSource
from tidemark.warehouse import Warehouse

TIMES = ", ".join(f"{c} timestamp_ntz" for c in (
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date"))
SCHEMAS = {
    "orders": f"order_id string, customer_id string, order_status string, {TIMES}",
    "order_items": "order_id string, order_item_id int, product_id string, price string, freight_value string",
    "order_payments": "order_id string, payment_sequential int, payment_value string",
    "order_reviews": "review_id string, order_id string, review_score int",
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string",
    "products": "product_id string, product_category_name string, product_photos_qty int, product_weight_g int,"
    " product_length_cm int, product_height_cm int, product_width_cm int",
}
KEYS = {
    "orders": ["order_id"], "order_items": ["order_id", "order_item_id"], "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id", "order_id"], "customers": ["customer_id"],
}
MARTS = ("fact_orders", "customer_summary", "product_summary")


def frame(spark, table, data):
    df = spark.createDataFrame(data, SCHEMAS[table])
    money = [c for c in ("price", "freight_value", "payment_value") if c in df.columns]
    return df.withColumns({c: F.col(c).cast("decimal(12,2)") for c in money}) if money else df


class Shop:
    """Random Silver tables; a step changes a few rows of each."""

    def __init__(self, spark, house, seed):
        self.spark, self.house, self.rng = spark, house, random.Random(seed)
        self.tables = {
            "orders": [self.order(o) for o in range(60)],
            "order_items": [self.item(o, i) for o in range(60) for i in range(self.rng.randint(0, 3))],
            "order_payments": [self.payment(o, 1) for o in range(50)],
            "order_reviews": [(f"r{o}", f"o{o}", self.rng.randint(1, 5)) for o in range(40)],
            "customers": [self.customer(c) for c in range(20)],
        }
        for table, data in self.tables.items():
            by = ("customer_id",) if table == "customers" else ("order_id",)
            house.overwrite("silver", table, frame(spark, table, data), part_by=by)
        products = [(f"p{p}", "n", 1, 1, 1, 1, 1) for p in range(8)]
        house.overwrite("silver", "products", frame(spark, "products", products))

    def order(self, o):
        t = ts(f"2020-01-{self.rng.randint(1, 28):02d}")
        return (f"o{o}", self.rng.choice([None, *(f"c{c}" for c in range(22))]), "created", t, t, None, None, t)

    def item(self, o, i):
        return (f"o{o}", i, f"p{self.rng.randint(0, 9)}", f"{self.rng.randint(0, 999) / 100}", "1.50")

    def payment(self, o, s):
        return (f"o{o}", s, f"{self.rng.randint(0, 999) / 100}")

    def customer(self, c):
        return (f"c{c}", f"u{c}", self.rng.randint(1, 99), "x", "y")

    def change(self, orders=2, items=2):
        """Moved and new orders, new and changed lines, payments and customers."""
        new = [self.rng.randint(0, 70) for _ in range(orders)]
        self.merge("orders", [self.order(o) for o in sorted(set(new))])
        lines = {(self.rng.randint(0, 70), self.rng.randint(0, 3)) for _ in range(items)}
        self.merge("order_items", [self.item(o, i) for o, i in sorted(lines)])
        self.merge("order_payments", [self.payment(self.rng.randint(0, 70), 1)])
        self.merge("customers", [self.customer(self.rng.randint(0, 24))])

    def merge(self, table, data):
        if data:
            self.house.merge("silver", table, frame(self.spark, table, data), KEYS[table], source_is_unique=True)

    def expected(self):
        read = lambda t: self.house.read("silver", t)
        fact = fact_orders(*[read(t) for t in marts.FACT_INPUTS])
        made = (fact, customer_summary(read("customers"), fact), product_summary(read("products"), read("order_items")))
        return dict(zip(MARTS, made))

    def publish(self):
        return [publish(self.house) for publish in (publish_fact, publish_customers, publish_products)]


@pytest.fixture
def house(spark, tmp_path):
    return Warehouse(spark, root=str(tmp_path), namespace=f"g{uuid.uuid4().hex[:8]}_", parts=12)


def test_three_change_sets_equal_full_builds(spark, house):
    shop = Shop(spark, house, 3)
    assert shop.publish() == [REBUILT] * 3
    assert shop.publish() == [KEPT] * 3
    for _ in range(3):
        before = house.layout("gold", "fact_orders")
        shop.change()
        assert shop.publish() == [REFRESHED] * 3
        # Parts that no change fell into are still those of earlier runs.
        assert 0 < len(house.layout("gold", "fact_orders").differing(before)) < 12
        for mart, df in shop.expected().items():
            assert rows(house.read("gold", mart)) == rows(df), mart
            assert house.rows("gold", mart) == df.count()
            assert house.read("gold", mart).dtypes == df.dtypes


@pytest.mark.parametrize("hashed", [True, False])
def test_patched_inputs_have_single_orders_built(spark, tmp_path, monkeypatch, hashed):
    """Of few changed rows only the orders that they touch are built, not their whole parts."""
    monkeypatch.setattr(layout_module, "_BROADCAST_ROWS", 0 if hashed else 10_000)
    house = Warehouse(spark, root=str(tmp_path), namespace=f"o{uuid.uuid4().hex[:8]}_", parts=1)
    shop = Shop(spark, house, 7)
    assert shop.publish() == [REBUILT] * 3
    for _ in range(2):
        shop.change(orders=1, items=1)
        house.merge("silver", "order_items", frame(spark, "order_items", [(None, 1, "p1", "2.00", "1.00")]), KEYS["order_items"])
        assert shop.publish() == [REFRESHED] * 3
        assert house.layout("silver", "order_items").patches and house.layout("gold", "fact_orders").patches
        run = spark.table(house.name("gold", house.snapshot("gold", "fact_orders")))
        assert 0 < run.count() < 12
        for mart, df in shop.expected().items():
            assert rows(house.read("gold", mart)) == rows(df), mart
            assert house.rows("gold", mart) == df.count()


def test_refresh_reads_changed_parts_only(spark, house):
    shop = Shop(spark, house, 4)
    shop.publish()
    before = {t: house.layout("silver", t) for t in marts.FACT_INPUTS}
    shop.merge("order_items", [shop.item(5, 0)])
    read = []
    real = Warehouse.read_parts
    try:
        Warehouse.read_parts = lambda self, layer, table, parts, layout=None: (
            read.append((table, sorted(parts))) or real(self, layer, table, parts, layout))
        assert publish_fact(house) == REFRESHED
        assert publish_products(house) == REFRESHED
    finally:
        Warehouse.read_parts = real
    changed = sorted(house.layout("silver", "order_items").differing(before["order_items"]))
    assert len(changed) == 1
    assert [parts for table, parts in read if table in marts.FACT_INPUTS] == [changed] * 6


def test_what_cannot_be_told_is_built_in_full(spark, house, monkeypatch):
    shop = Shop(spark, house, 5)
    shop.publish()
    shop.change()
    for table in ("order_items", "customers"):  # written as a whole; the rows as they were are gone
        by = house.layout("silver", table).part_by
        house.overwrite("silver", table, house.read("silver", table), part_by=by)
        assert house.drop_old_snapshots("silver", table)
    assert publish_fact(house) == REFRESHED  # needs no old rows
    assert publish_customers(house) == REBUILT
    assert publish_products(house) == REBUILT
    for mart, df in shop.expected().items():
        assert rows(house.read("gold", mart)) == rows(df), mart
    # Other products, or other code.
    house.overwrite("silver", "products", frame(spark, "products", [("p1", "n", 1, 1, 1, 1, 1)]))
    assert publish_products(house) == REBUILT
    monkeypatch.setattr(marts, "code_version", lambda *_: "new")
    assert shop.publish() == [REBUILT] * 3
    assert publish_fact(house, force=True) == REBUILT


def test_tables_split_differently_are_built_in_full(spark, house):
    shop = Shop(spark, house, 6)
    shop.publish()
    data = [shop.payment(o, 1) for o in range(30)]
    house.overwrite("silver", "order_payments", frame(spark, "order_payments", data), part_by=("order_id",), count=5)
    assert publish_fact(house) == REBUILT
    assert rows(house.read("gold", "fact_orders")) == rows(shop.expected()["fact_orders"])


def test_sales_changes_shuffle_only_what_they_are_given(spark):
    lines = frame(spark, "order_items", [("o1", 1, "p", "2.00", "1.00"), ("o1", 2, "p", "3.00", "1.00"), ("o2", 1, "q", "1.00", "0.00")])
    after = frame(spark, "order_items", [("o1", 1, "p", "2.50", "1.00"), ("o2", 1, "q", "1.00", "0.00"), ("o3", 1, "r", "1.00", "2.00")])
    found = sales_changes(lines, after)
    made = [(p, n, m, str(a), str(b)) for p, n, m, a, b in rows(found)]
    assert made == [("p", -1, 0, "-2.50", "-1.00"), ("r", 1, 1, "1.00", "2.00")]
    assert "CartesianProduct" not in plan_of(found)


# -- together --------------------------------------------------------------------------


def test_steps_run_at_the_same_time_and_in_order(spark):
    meet, order = threading.Barrier(2, timeout=60), []

    def step(name, wait=False):
        def work():
            if wait:
                meet.wait()
            order.append(name)
            return name.upper()

        return work

    steps = [Step("a", step("a", True)), Step("b", step("b", True)), Step("c", step("c"), after=("a", "b"))]
    assert run_together(spark, steps, workers=2) == {"a": "A", "b": "B", "c": "C"}
    assert order[-1] == "c"


@pytest.mark.parametrize("workers", [1, 3])
def test_failures_stop_only_what_waits_for_them(spark, workers):
    done = []

    def fail():
        raise ValueError("broken")

    steps = [Step("a", fail), Step("b", lambda: done.append("b")), Step("c", lambda: done.append("c"), after=("a",)),
             Step("d", lambda: done.append("d"), after=("b",)), Step("e", lambda: done.append("e"), after=("c", "d"))]
    with pytest.raises(StepsFailed, match="broken") as caught:
        run_together(spark, steps, workers)
    assert sorted(done) == ["b", "d"]
    assert {n: type(e) for n, e in caught.value.errors.items()} == {"a": ValueError, "c": NotStarted, "e": NotStarted}


def test_one_failing_table_leaves_the_others_published(spark, house):
    from tidemark.verify.queries import two_states

    state, _ = two_states(spark, "/root/testdata/sf0.001")
    broken = state["order_payments"].withColumn("payment_type", F.raise_error(F.lit("torn")).cast("string"))
    with pytest.raises(StepsFailed) as caught:
        run_pipeline(house, FrameSource(state | {"order_payments": broken}))
    assert set(caught.value.errors) == {"order_payments", "fact_orders", "customer_summary"}
    assert house.exists("silver", "orders") and house.exists("gold", "product_summary")
    assert not house.exists("bronze", "order_payments") and not house.exists("gold", "fact_orders")
    counts = run_pipeline(house, FrameSource(state))  # picks up from there
    assert counts["fact_orders"] == house.read("silver", "orders").count()
