"""One named query per operator, over whole tables of a test-data folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import aggregates, changes, profiling, watermark
from tidemark.operators.cleaning import clean
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.quality import reason_counts
from tidemark.operators.ranking import shuffled_sample
from tidemark.operators.upsert import upsert
from tidemark.operators.watermark import Watermark
from tidemark.plans import gold
from tidemark.plans.bronze import ingest
from tidemark.plans.checks import ALL_CHECKS, RANGE_CHECKS, STATUS_CHECKS, TIME_ORDER_CHECKS
from tidemark.plans.pipeline import run_pipeline
from tidemark.plans.reconcile import reconciliation
from tidemark.plans.silver import invalid_rows, judged, refine, valid_rows
from tidemark.shared import new_folder
from tidemark.sources import FrameSource
from tidemark.specs import TABLES, TableSpec
from tidemark.verify import change_sets
from tidemark.verify.shapes import SourceTables
from tidemark.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

# Where the first of two loads ends (exclusive, on updated_at).
FIRST_LOAD_END = {
    "customers": "DATE '1996-08-01'",
    "orders": "TIMESTAMP '1998-03-01 00:00:00'",
    "order_items": "TIMESTAMP '1999-01-01 00:00:00'",
    "order_payments": "TIMESTAMP '1999-01-01 00:00:00'",
    "order_reviews": "TIMESTAMP '2024-01-15 00:00:00'",
}
RULED = [name for name, spec in TABLES.items() if spec.rules]
INCREMENTAL = [name for name, spec in TABLES.items() if spec.is_incremental]
SHORT = {"product_category_name_translation": "translation"}

SEED = "batch-1"
SHARE = 0.02
SMALL_SHARE = 0.0005
SAMPLE_ROWS = 37
#: Order lines (all versions) in a part of the warehouse, about.
PART_ROWS = 1_000_000


class Shop:
    """Lazy source and Silver tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sources = SourceTables(spark, sf_dir)

    def source(self, name: str) -> DataFrame:
        return self.sources[name]

    def silver(self, name: str) -> DataFrame:
        return valid_rows(self.sources[name], TABLES[name])

    def first_load(self, name: str) -> DataFrame:
        end = F.expr(FIRST_LOAD_END[name])
        if FIRST_LOAD_END[name].startswith("TIMESTAMP"):
            end = end.cast("timestamp_ntz")
        return self.sources[name].filter(F.col("updated_at") < end)

    def fact(self) -> DataFrame:
        return gold.fact_orders(
            *[self.silver(t) for t in ("orders", "order_items", "order_payments", "order_reviews")]
        )


def over_shop(build: Callable[[Shop], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Shop(spark, sf_dir))


def short(name: str) -> str:
    return SHORT.get(name, name)


# -- cleaning, validation --------------------------------------------------------


def _cleaning() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name, spec in TABLES.items():
        found[f"clean_{short(name)}"] = over_shop(
            lambda s, n=name, sp=spec: clean(s.source(n), sp)
        )
    for name in RULED:
        found[f"silver_{name}"] = over_shop(lambda s, n=name: s.silver(n))
        found[f"quarantine_{name}"] = over_shop(
            lambda s, n=name: invalid_rows(s.source(n), TABLES[n])
        )
    found["quarantine_reason_counts"] = over_shop(
        lambda s: profiling.stacked(
            {n: reason_counts(judged(s.source(n), TABLES[n])) for n in RULED}
        )
    )
    return found


# -- incremental load ------------------------------------------------------------


def _watermark_max(s: Shop) -> DataFrame:
    marks = {
        n: watermark.high_water_mark(s.silver(n)).select(
            F.col("watermark").cast("timestamp_ntz").alias("watermark")
        )
        for n in INCREMENTAL
    }
    return profiling.stacked(marks)


def _second_slice(s: Shop, name: str) -> DataFrame:
    """Source rows at or above the mark of the first load's Silver table."""
    first = valid_rows(s.first_load(name), TABLES[name])
    return watermark.slice_above(s.source(name), first)


def _two_loads(s: Shop, name: str) -> DataFrame:
    spec = TABLES[name]
    first = valid_rows(s.first_load(name), spec)
    second = valid_rows(_second_slice(s, name), spec)
    return upsert(first, second, spec.keys, source_is_unique=True)


def _quarantine_two_loads(s: Shop, name: str) -> DataFrame:
    spec = TABLES[name]
    first = invalid_rows(s.first_load(name), spec)
    second = invalid_rows(_second_slice(s, name), spec)
    return upsert(first, second, spec.keys, null_safe=True, source_is_unique=True)


def _upsert_many_targets(s: Shop) -> DataFrame:
    """Raw payments (repeated keys, NULL keys) updated by one row per key."""
    target = s.source("order_payments")
    source = clean(target, TABLES["order_payments"]).withColumn(
        "payment_type", F.concat(F.lit("merged "), "payment_type")
    )
    newer = source.filter("payment_installments > 10 OR payment_installments IS NULL")
    return upsert(target, newer, ["order_id", "payment_sequential"])


def _incremental() -> dict[str, Query]:
    found: dict[str, Query] = {
        "watermark_max": over_shop(_watermark_max),
        "incremental_slice": over_shop(lambda s: _second_slice(s, "orders")),
        "upsert_many_targets": over_shop(_upsert_many_targets),
        "upsert_null_safe": over_shop(lambda s: _quarantine_two_loads(s, "orders")),
        "quarantine_merge": over_shop(lambda s: _quarantine_two_loads(s, "order_items")),
    }
    for name in INCREMENTAL:
        found[f"two_loads_{name}"] = over_shop(lambda s, n=name: _two_loads(s, n))
    return found


# -- marts -----------------------------------------------------------------------


def _marts() -> dict[str, Query]:
    return {
        "order_item_summary": over_shop(lambda s: aggregates.item_summary(s.silver("order_items"))),
        "item_summary_fine_amounts": over_shop(
            lambda s: aggregates.item_summary(
                s.silver("order_items").withColumns(
                    {
                        "price": (F.col("price") * F.lit(Decimal("0.001"))).cast("decimal(12,4)"),
                        "freight_value": F.col("freight_value").cast("double") * 0.125,
                    }
                )
            )
        ),
        "order_payment_summary": over_shop(
            lambda s: aggregates.payment_summary(s.silver("order_payments"))
        ),
        "order_review_summary": over_shop(
            lambda s: aggregates.review_summary(s.silver("order_reviews"))
        ),
        "customer_order_summary": over_shop(lambda s: aggregates.customer_order_summary(s.fact())),
        "product_sales_summary": over_shop(
            lambda s: aggregates.product_sales_summary(s.silver("order_items"))
        ),
        "fact_orders": over_shop(lambda s: s.fact()),
        "customer_summary": over_shop(
            lambda s: gold.customer_summary(s.silver("customers"), s.fact())
        ),
        "product_summary": over_shop(
            lambda s: gold.product_summary(s.silver("products"), s.silver("order_items"))
        ),
    }


# -- published layers --------------------------------------------------------------


def _versions(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All versions of the shop's rows up to two points in time."""
    s = Shop(spark, sf_dir)
    after = {name: s.source(name) for name in TABLES}
    return {**after, **{name: s.first_load(name) for name in INCREMENTAL}}, after


def _newest(spec: TableSpec, rows: DataFrame, parts: int) -> DataFrame:
    """One current row per key."""
    if spec.part_by:  # as the warehouse will split them: one exchange for both
        rows = rows.repartition(parts, *spec.part_by)
    return latest_per_key(rows, spec.keys, spec.watermark) if spec.keys else rows


def two_states(
    spark: SparkSession, sf_dir: str
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The shop's database at two points in time: one current row per key each."""
    parts = parts_for(spark, sf_dir)
    before, after = (
        {name: _newest(TABLES[name], rows, parts) for name, rows in versions.items()}
        for versions in _versions(spark, sf_dir)
    )
    return before, after


@dataclass(frozen=True)
class CurrentSource(FrameSource):
    """The current rows among all versions. The newest row of a key is at or above
    a mark if any is, so those below it are left out before the newest are sought.
    They are split into ``parts`` by key, as the warehouse's tables should be."""

    parts: int = 0

    def read(self, spec: TableSpec) -> DataFrame:
        return self._newest(spec, self.frames[spec.name])

    def read_since(self, spec: TableSpec, mark: Watermark | None) -> DataFrame:
        return self._newest(spec, watermark.since(self.frames[spec.name], mark))

    def _newest(self, spec: TableSpec, rows: DataFrame) -> DataFrame:
        return _newest(spec, rows, self.parts or _shuffle_partitions(rows.sparkSession))


def _shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(spark: SparkSession, sf_dir: str) -> int:
    """Into how many parts a shop's tables are split: so many that a task sorts one in memory."""
    lines = SourceTables(spark, sf_dir)["order_items"].count()
    return max(_shuffle_partitions(spark), -(-lines // PART_ROWS))


def new_warehouse(
    spark: SparkSession, checks: dict[str, dict[str, str]] | None = None, parts: int | None = None
) -> Warehouse:
    """An empty warehouse in the shared folder."""
    root = new_folder(spark, "warehouse")
    return Warehouse(spark, root=root, namespace=f"t{root[-12:]}_", parts=parts, checks=checks)


@lru_cache(maxsize=4)
def _published(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Two full runs of all layers, over the earlier and the later state."""
    parts = parts_for(spark, sf_dir)
    warehouse = new_warehouse(spark, ALL_CHECKS, parts)
    for versions in _versions(spark, sf_dir):
        run_pipeline(warehouse, CurrentSource(versions, parts))
    return warehouse


def _from_run(layer: str, table: str) -> Query:
    return lambda spark, sf_dir: _published(spark, sf_dir).read(layer, table)


def _run_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = _published(spark, sf_dir)
    tables = {f"bronze.{t}": house.read("bronze", t) for t in TABLES}
    tables |= {f"silver.{t}": house.read("silver", t) for t in TABLES}
    tables |= {f"quarantine.{t}": house.read("quarantine", t) for t in RULED}
    return profiling.row_counts(tables)


def _run_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze and Silver as profiled by the writes of two runs; the tables are not read."""
    house = _published(spark, sf_dir)
    return profiling.stacked(
        {f"{layer}.{t}": house.profile(layer, t) for layer in ("bronze", "silver") for t in TABLES}
    )


def _bronze_repeated_keys(s: Shop) -> DataFrame:
    """Two equal loads of a table in which every key also has an older row."""
    rows = s.silver("orders")
    older = rows.withColumns(
        {"order_status": F.lit("older"), "updated_at": F.expr("updated_at - INTERVAL '900' DAY")}
    )
    source = FrameSource({"orders": rows.unionByName(older)})
    warehouse = new_warehouse(s.spark)
    for _ in range(2):
        ingest(warehouse, source, TABLES["orders"])
    return warehouse.read("bronze", "orders")


@lru_cache(maxsize=2)
def refreshed(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A full run, then three change sets whose marts are brought up to date by part."""
    _, state = two_states(spark, sf_dir)
    warehouse = new_warehouse(spark, parts=parts_for(spark, sf_dir))
    # Every run reads the state, a change set the one before it twice and more. Staged
    # like the tables, it is shuffled once.
    state = state | {t: warehouse.staged("bronze", t, state[t], TABLES[t].part_by) for t in INCREMENTAL}
    run_pipeline(warehouse, FrameSource(state))
    for k in change_sets.STEPS:
        state = state | {t: change_sets.changed(t, state[t], k) for t in change_sets.HITS}
        run_pipeline(warehouse, FrameSource(state))
    return warehouse


def _after_changes(mart: str) -> Query:
    return lambda spark, sf_dir: refreshed(spark, sf_dir).read("gold", mart)


def _current(s: Shop, name: str) -> tuple[Warehouse, DataFrame]:
    """A new warehouse, and a table's current rows staged as it will split them."""
    spec, warehouse = TABLES[name], new_warehouse(s.spark, parts=parts_for(s.spark, s.sources.sf_dir))
    rows = _newest(spec, s.source(name), warehouse.parts)
    return warehouse, warehouse.staged("bronze", name, rows, spec.part_by)


def _quarantine_cleared(s: Shop) -> DataFrame:
    """Payments that are bad, good, bad and good again; repaired ones leave quarantine."""
    spec = TABLES["order_payments"]
    warehouse, payments = _current(s, spec.name)
    for number in range(1, 5):
        source = FrameSource({spec.name: change_sets.payments_at(payments, number)})
        ingest(warehouse, source, spec)
        refine(warehouse, spec, clear_repaired=True)
    return warehouse.read("quarantine", spec.name)


def _lookback(s: Shop) -> DataFrame:
    """Orders of which every fifth arrives late; those of the last days are read again."""
    spec = TABLES["orders"]
    warehouse, orders = _current(s, spec.name)
    lookback = f"INTERVAL '{change_sets.LOOKBACK_DAYS}' DAY"
    late = F.coalesce(F.expr(change_sets.LATE), F.lit(False))
    for rows in (orders.filter(~late), orders):
        ingest(warehouse, FrameSource({spec.name: rows}), spec, lookback=lookback)
        refine(warehouse, spec, lookback=lookback)
    return warehouse.read("silver", spec.name)


def _runs() -> dict[str, Query]:
    found: dict[str, Query] = {
        "quarantine_cleared": over_shop(_quarantine_cleared),
        "lookback_orders": over_shop(_lookback),
        "bronze_repeated_keys": over_shop(_bronze_repeated_keys),
        "run_row_counts": _run_row_counts,
        "run_profiles": _run_profiles,
        "run_bronze_orders": _from_run("bronze", "orders"),
        "run_bronze_order_items": _from_run("bronze", "order_items"),
        "run_quarantine_order_items": _from_run("quarantine", "order_items"),
        "run_quarantine_products": _from_run("quarantine", "products"),
    }
    for name in TABLES:
        found[f"run_silver_{short(name)}"] = _from_run("silver", name)
    for mart in ("fact_orders", "customer_summary", "product_summary"):
        found[f"run_gold_{mart}"] = _from_run("gold", mart)
        found[f"refreshed_{mart}"] = _after_changes(mart)
    return found


# -- profiling ---------------------------------------------------------------------

GRAINS = {
    "customers": ["customer_id"],
    "customers.person": ["customer_unique_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_items.line": ["order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id", "order_id"],
    "order_reviews.review": ["review_id"],
    "order_reviews.order": ["order_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "product_category_name_translation": ["product_category_name"],
    "geolocation": None,
}


def _grain(s: Shop) -> DataFrame:
    reports = {
        label: profiling.grain(s.source(label.split(".")[0]), keys)
        for label, keys in GRAINS.items()
    }
    return profiling.stacked(reports)


def _gold_grain(s: Shop) -> DataFrame:
    items = s.silver("order_items")
    fact = s.fact()
    marts = {
        "fact_orders": (fact, "order_id"),
        "customer_summary": (gold.customer_summary(s.silver("customers"), fact), "customer_id"),
        "product_summary": (gold.product_summary(s.silver("products"), items), "product_id"),
    }
    return profiling.stacked({n: profiling.grain(df, [key]) for n, (df, key) in marts.items()})


def _flags(s: Shop, checks: dict[str, dict[str, str]]) -> DataFrame:
    return profiling.stacked(
        {t: profiling.flag_counts(s.source(t), flags) for t, flags in checks.items()}
    )


def _one_pass(s: Shop) -> DataFrame:
    reports = {}
    for name in TABLES:
        checks = {}
        for group in (RANGE_CHECKS, TIME_ORDER_CHECKS, STATUS_CHECKS):
            checks |= group.get(name, {})
        reports[name] = profiling.one_pass(s.source(name), checks)
    return profiling.stacked(reports)


def _frequency(s: Shop) -> DataFrame:
    reports = {
        "order_status": profiling.frequency(
            clean(s.source("orders"), TABLES["orders"]), "order_status"
        ),
        "customer_state": profiling.frequency(s.silver("customers"), "customer_state"),
    }
    return profiling.stacked(
        {label: df.withColumnRenamed(label, "value") for label, df in reports.items()},
        label="column_name",
    )


def _top(s: Shop, table: str, key: str, **measures) -> DataFrame:
    return profiling.heaviest_keys(s.silver(table), [key], 10, measures)


def _drift(s: Shop) -> DataFrame:
    attributes = [
        "customer_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ]
    return profiling.attribute_drift(s.source("customers"), "customer_unique_id", attributes)


def _bad_samples(s: Shop) -> DataFrame:
    columns = [
        "order_id",
        "order_status",
        "order_purchase_timestamp",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
    ]
    orders = s.silver("orders")
    checks = TIME_ORDER_CHECKS["orders"]
    return profiling.stacked(
        {
            name: profiling.offending_rows(orders, checks[name], columns, ["order_id"])
            for name in ("carrier_before_purchase", "delivered_before_carrier")
        },
        label="check_name",
    )


def _bad_products(s: Shop) -> DataFrame:
    products = clean(s.source("products"), TABLES["products"])
    checks = RANGE_CHECKS["products"]
    return profiling.stacked(
        {
            name: profiling.offending_rows(
                products, checks[name], products.columns, ["product_id"]
            )
            for name in ("size_missing", "size_not_positive")
        },
        label="check_name",
    )


def _orphans(s: Shop) -> DataFrame:
    pairs = [
        ("orders", "customers", "customer_id"),
        ("order_items", "orders", "order_id"),
        ("order_items", "products", "product_id"),
        ("order_items", "sellers", "seller_id"),
        ("order_payments", "orders", "order_id"),
    ]
    return profiling.stacked(
        {
            f"{child}->{parent}": profiling.orphan_count(s.source(child), s.source(parent), key)
            for child, parent, key in pairs
        },
        label="relation",
    )


def _coverage(s: Shop) -> DataFrame:
    return profiling.stacked(
        {
            "customers.zip": profiling.coverage(s.silver("customers"), "customer_zip_code_prefix"),
            "order_items.product": profiling.coverage(s.silver("order_items"), "product_id"),
        },
        label="column_name",
    )


def _reconcile(s: Shop) -> DataFrame:
    items, products, fact = s.silver("order_items"), s.silver("products"), s.fact()
    return reconciliation(
        gold.customer_summary(s.silver("customers"), fact),
        fact,
        gold.product_summary(products, items),
        items,
        products,
    )


def _profiles() -> dict[str, Query]:
    lines = ["order_item_id", "product_id", "price", "freight_value"]
    payments = ["payment_sequential", "payment_type", "payment_installments", "payment_value"]
    return {
        "profile_grain": over_shop(_grain),
        "profile_gold_grain": over_shop(_gold_grain),
        "profile_nulls": over_shop(
            lambda s: profiling.stacked({n: profiling.null_counts(s.source(n)) for n in TABLES})
        ),
        "profile_one_pass": over_shop(_one_pass),
        "profile_frequency": over_shop(_frequency),
        "profile_duplicate_keys": over_shop(
            lambda s: profiling.repeated_keys(s.source("customers"), ["customer_id"])
        ),
        "profile_top_persons": over_shop(lambda s: _top(s, "customers", "customer_unique_id")),
        "profile_top_customers": over_shop(lambda s: _top(s, "orders", "customer_id")),
        "profile_top_orders": over_shop(
            lambda s: _top(
                s,
                "order_items",
                "order_id",
                total_product_value=F.sum("price").cast("decimal(22,2)"),
                total_freight_value=F.sum("freight_value").cast("decimal(22,2)"),
            )
        ),
        "profile_top_payments": over_shop(
            lambda s: _top(
                s,
                "order_payments",
                "order_id",
                total_payment_value=F.sum("payment_value").cast("decimal(22,2)"),
            )
        ),
        "profile_top_reviews": over_shop(
            lambda s: _top(
                s, "order_reviews", "order_id", average_review_score=F.avg("review_score")
            )
        ),
        "profile_attribute_drift": over_shop(_drift),
        "profile_range_checks": over_shop(lambda s: _flags(s, RANGE_CHECKS)),
        "profile_time_order": over_shop(lambda s: _flags(s, TIME_ORDER_CHECKS)),
        "profile_status_mismatch": over_shop(
            lambda s: profiling.flag_counts(
                clean(s.source("orders"), TABLES["orders"]), STATUS_CHECKS["orders"]
            )
        ),
        "profile_bad_samples": over_shop(_bad_samples),
        "profile_bad_products": over_shop(_bad_products),
        "profile_orphans": over_shop(_orphans),
        "orphan_products": over_shop(
            lambda s: profiling.orphan_keys(
                s.silver("order_items"), s.silver("products"), "product_id"
            )
        ),
        "orphan_product_value": over_shop(
            lambda s: profiling.orphan_value(
                s.silver("order_items"), s.silver("products"), "product_id", "price"
            ).select(F.col("orphan_value").cast("decimal(28,2)").alias("orphan_value"))
        ),
        "profile_childless": over_shop(
            lambda s: profiling.childless_count(
                s.silver("customers"), s.silver("orders"), "customer_id"
            )
        ),
        "profile_coverage": over_shop(_coverage),
        "profile_fanout": over_shop(
            lambda s: profiling.fan_out(
                s.silver("orders"),
                [s.silver(t) for t in ("order_items", "order_payments", "order_reviews")],
                "order_id",
            )
        ),
        "profile_repeated_pairs": over_shop(
            lambda s: profiling.repeated_keys(s.silver("order_items"), ["product_id", "order_id"])
        ),
        "reconcile_gold": over_shop(_reconcile),
        "row_counts": over_shop(
            lambda s: profiling.row_counts({n: s.silver(n) for n in TABLES})
        ),
        "entity_order_lines": over_shop(
            lambda s: profiling.entity_rows(
                s.silver("order_items"), "order_id", 12, lines, ["order_item_id"]
            )
        ),
        "entity_payments": over_shop(
            lambda s: profiling.entity_rows(
                s.silver("order_payments"), "order_id", 12, payments, ["payment_sequential"]
            )
        ),
        "entity_person": over_shop(
            lambda s: profiling.entity_rows(
                s.silver("customers"),
                "customer_unique_id",
                20,
                s.source("customers").columns,
                ["customer_id"],
            )
        ),
        "entity_activity": over_shop(
            lambda s: profiling.entity_activity(
                s.silver("customers"),
                s.silver("orders"),
                "customer_unique_id",
                20,
                "customer_id",
                "order_id",
            )
        ),
        "person_activity": over_shop(
            lambda s: profiling.entity_activity(
                s.silver("customers"),
                s.silver("orders"),
                "customer_unique_id",
                None,
                "customer_id",
                "order_id",
            )
        ),
        "preview_orders": over_shop(lambda s: profiling.preview(s.silver("orders"), ["order_id"])),
    }


# -- change sets -------------------------------------------------------------------


def _changes() -> dict[str, Query]:
    found: dict[str, Query] = {
        "product_seller_pairs": over_shop(
            lambda s: changes.product_seller_pairs(s.source("order_items"))
        ),
        "open_orders": over_shop(lambda s: changes.orders_in(s.silver("orders"))),
        "shuffled_sample": over_shop(
            lambda s: shuffled_sample(s.silver("orders"), ["order_id"], SEED, share=SHARE)
        ),
        "shuffled_sample_rows": over_shop(
            lambda s: shuffled_sample(s.silver("orders"), ["order_id"], SEED, rows=SAMPLE_ROWS)
        ),
        "shuffled_sample_small_share": over_shop(
            lambda s: shuffled_sample(s.silver("orders"), ["order_id"], SEED, share=SMALL_SHARE)
        ),
    }
    return found


def all_queries() -> dict[str, Query]:
    return {
        **_cleaning(),
        **_incremental(),
        **_marts(),
        **_profiles(),
        **_changes(),
        **_runs(),
    }
