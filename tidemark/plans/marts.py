"""Publishing the Gold marts: as a whole, or only what the changes since the last build touch.

Each mart notes the state and the layout of its inputs. If nothing has changed
it is left alone. If the tables are still split alike, the layouts tell which
parts have been written since, and only these are read:

* ``fact_orders`` is split by order like its four inputs. A part of it depends
  on the same part of each, and is built anew from them alone. If these parts have
  only been patched, the patches tell the orders, and only their rows are built.
* ``customer_summary``: the customers of all rows that came, went or changed in
  the customers' and the fact's parts (so also the customer whom an order has
  left) are summed up again. First and last dates can't be taken back, so this
  reads three columns of the fact, but no child table.
* ``product_summary`` holds sums over orders. An order's lines lie in one part,
  so sums over the parts before and after differ by exactly what is to be added.

Whatever can't be told - other code, other splits, runs that were dropped - is
built in full.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import all_not_null, money_sum, quoted
from tidemark.layout import Layout, may_be_hashed, parts_touched, rows_by_part
from tidemark.operators import aggregates
from tidemark.plans import gold
from tidemark.plans.gold import customer_summary, fact_orders, product_summary
from tidemark.plans.stamps import code_version, layout_in, stamp_of
from tidemark.shared import staged
from tidemark.warehouse import PATCH_SHARE, Warehouse

FACT_INPUTS = ("orders", "order_items", "order_payments", "order_reviews")
KEPT, REFRESHED, REBUILT = "kept", "refreshed", "rebuilt"


def _build(
    warehouse: Warehouse,
    mart: str,
    inputs: dict[str, tuple[str, str]],
    refresh: Callable[[Warehouse, dict], bool],
    rebuild: Callable[[Warehouse], None],
    force: bool,
) -> str:
    """Bring one mart up to date and say how."""
    version = code_version(gold, aggregates)
    stamp = stamp_of(warehouse, inputs, version, with_layouts=True)
    before = warehouse.built_from("gold", mart) if stamp is not None and not force else None
    if before is not None and before["version"] != version:
        before = None
    if before is not None and before["inputs"] == stamp["inputs"]:
        return KEPT
    how = REFRESHED if before is not None and refresh(warehouse, before) else REBUILT
    if how == REBUILT:
        rebuild(warehouse)
    if stamp is not None:
        warehouse.stamp("gold", mart, stamp)
    return how


def _changed_parts(warehouse: Warehouse, before: dict, name: str, layer: str, table: str) -> set[int] | None:
    """Parts of an input that were written since; None if its split has changed."""
    old, new = layout_in(before, name), warehouse.layout(layer, table)
    return old.differing(new) if old is not None and old.split_like(new) else None


def net_changes(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (of ``columns``) that are more or fewer times in ``after`` than ``before``."""
    sides = before.select(*columns, F.lit(-1).alias("__times")).unionByName(
        after.select(*columns, F.lit(1).alias("__times"))
    )
    return sides.groupBy(*columns).agg(F.sum("__times").alias("__times")).filter("__times <> 0").drop("__times")


def _patched_keys(
    warehouse: Warehouse, before: dict, name: str, layer: str, table: str, key: str
) -> DataFrame | None:
    """The ``key`` (a column of the merge's) of all rows that came, went or changed, as the patches
    alone tell it: a patch holds all rows that ever differed from its part's own. None where they
    don't, as parts were written anew."""
    old, new = layout_in(before, name), warehouse.layout(layer, table)
    parts = old.differing(new)
    if not old.patched_since(new, parts) or key not in new.patch_keys or not warehouse.holds(layer, old, parts):
        return None
    rows, earlier = warehouse.patch_rows(layer, table, parts), warehouse.patch_rows(layer, table, parts, old)
    return (rows if earlier is None else net_changes(earlier, rows, rows.columns)).select(key)


def _listed(warehouse: Warehouse, layer: str, table: str, keys: DataFrame) -> tuple[DataFrame, list[int]]:
    """Distinct keys staged like a table that is split by them, and how many there are by part."""
    keys = warehouse.staged(layer, table, keys.filter(all_not_null(keys.columns)).distinct())
    return keys, list(rows_by_part(keys, warehouse.layout(layer, table)).values())


def _of_keys(
    warehouse: Warehouse,
    layer: str,
    table: str,
    parts: set[int],
    keys: DataFrame,
    count: list[int],
    layout: Layout | None = None,
) -> DataFrame:
    """The rows of some parts that have one of the listed keys."""
    if may_be_hashed(count):
        return warehouse.read_keys(layer, table, parts, keys, keys.columns, layout)
    return warehouse.read_parts(layer, table, parts, layout).join(keys, keys.columns, "left_semi")


def _both_sides(
    warehouse: Warehouse, before: dict, name: str, layer: str, table: str, key: str
) -> tuple[DataFrame, DataFrame] | None:
    """The changed parts' rows as they were and as they are; None if they can't be had.

    If only patches were written since, of those with a ``key`` only the rows that
    have the key of one that differs.
    """
    parts = _changed_parts(warehouse, before, name, layer, table)
    old = layout_in(before, name)
    if parts is None or not warehouse.holds(layer, old, parts):
        return None
    keys = _patched_keys(warehouse, before, name, layer, table, key) if old.part_by == (key,) else None
    if keys is None:
        return warehouse.read_parts(layer, table, parts, old), warehouse.read_parts(layer, table, parts)
    keys, count = _listed(warehouse, layer, table, keys)

    def side(layout: Layout | None) -> DataFrame:
        found = _of_keys(warehouse, layer, table, parts, keys, count, layout)
        patch = warehouse.patch_rows(layer, table, parts, layout)  # replaces no row without a key
        return found if patch is None else found.unionByName(patch.filter(quoted(key).isNull()))

    return side(old), side(None)


# -- fact_orders -------------------------------------------------------------------


def _refresh_fact(warehouse: Warehouse, before: dict) -> bool:
    layouts = [warehouse.layout("silver", t) for t in FACT_INPUTS] + [warehouse.layout("gold", "fact_orders")]
    kinds = {warehouse.read("silver", t).schema["order_id"].dataType.simpleString() for t in FACT_INPUTS}
    if any(layout is None or not layout.split_like(layouts[0]) for layout in layouts) or len(kinds) > 1:
        return False
    parts: set[int] = set()
    for table in FACT_INPUTS:
        changed = _changed_parts(warehouse, before, table, "silver", table)
        if changed is None:
            return False
        parts |= changed
    if not parts or _refresh_orders(warehouse, before, parts):
        return True
    fact = fact_orders(*[warehouse.read_parts("silver", t, parts) for t in FACT_INPUTS])
    warehouse.replace_parts("gold", "fact_orders", fact, parts)
    return True


def _refresh_orders(warehouse: Warehouse, before: dict, parts: set[int]) -> bool:
    """Build the rows of the orders anew that patches of the inputs tell, if they are few; whether that was done.

    A patch takes no row away, so no order leaves the mart.
    """
    found = []
    for table in FACT_INPUTS:
        if layout_in(before, table).differing(warehouse.layout("silver", table)):
            found.append(_patched_keys(warehouse, before, table, "silver", table, "order_id"))
    if any(keys is None for keys in found):
        return False
    affected, count = _listed(warehouse, "gold", "fact_orders", reduce(DataFrame.union, found))
    held = warehouse.layout("gold", "fact_orders").parts
    if sum(count) > PATCH_SHARE * sum(held[part].rows for part in parts if part in held):
        return False
    inputs = [_of_keys(warehouse, "silver", t, parts, affected, count) for t in FACT_INPUTS]
    rows = warehouse.staged("gold", "fact_orders", fact_orders(*inputs))
    changes = warehouse.staged_changes("gold", "fact_orders", rows, ["order_id"], source_is_unique=True)
    warehouse.merge("gold", "fact_orders", changes, ["order_id"], source_is_unique=True)
    return True


def _rebuild_fact(warehouse: Warehouse) -> None:
    fact = fact_orders(*[warehouse.read("silver", t) for t in FACT_INPUTS])
    layout = warehouse.layout("silver", "orders")
    warehouse.overwrite(
        "gold",
        "fact_orders",
        fact,
        schema_may_change=True,
        part_by=("order_id",),
        count=layout.count if layout else None,
    )


# -- customer_summary ----------------------------------------------------------------


def _refresh_customers(warehouse: Warehouse, before: dict) -> bool:
    key = "customer_id"
    people = _both_sides(warehouse, before, "customers", "silver", "customers", key)
    orders = _both_sides(warehouse, before, "fact_orders", "gold", "fact_orders", "order_id")
    if people is None or orders is None:
        return False
    summed = ["order_id", key, "total_product_value", "order_purchase_timestamp"]
    affected = staged(
        net_changes(*people, gold.CUSTOMER_COLUMNS)
        .select(key)
        .unionByName(net_changes(*orders, summed).select(key))
        .filter(all_not_null([key]))
        .distinct()
    )
    layout = warehouse.layout("silver", "customers")
    customers = warehouse.read_parts("silver", "customers", parts_touched(affected, layout))
    fact = warehouse.read("gold", "fact_orders").join(affected, key, "left_semi")
    rows = customer_summary(customers.join(affected, key, "left_semi"), fact)
    rows = warehouse.staged("gold", "customer_summary", rows)
    gone = staged(affected.join(rows.select(key), key, "left_anti"))
    changes = warehouse.staged(
        "gold", "customer_summary", warehouse.changes("gold", "customer_summary", rows, [key], source_is_unique=True)
    )
    leaving = None if gone.isEmpty() else gone
    warehouse.merge("gold", "customer_summary", changes, [key], source_is_unique=True, gone=leaving)
    return True


def _rebuild_customers(warehouse: Warehouse) -> None:
    mart = customer_summary(warehouse.read("silver", "customers"), warehouse.read("gold", "fact_orders"))
    warehouse.overwrite("gold", "customer_summary", mart, schema_may_change=True, part_by=("customer_id",))


# -- product_summary -----------------------------------------------------------------

SALES = ("order_line_count", "order_count", "total_product_value", "total_freight_value")


def sales_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What the order lines ``after`` add to each product's sales over those ``before``.

    Both sides must hold whole orders. An order's lines of a product are netted
    first, where they are if both sides are split by order; only what has changed
    goes on to its product.
    """
    def side(lines: DataFrame, sign: int) -> DataFrame:
        amounts = [(quoted(c) * sign).alias(c) for c in ("price", "freight_value")]
        return lines.select("order_id", "product_id", F.lit(sign).alias("__sign"), *amounts)

    lines = side(before, -1).unionByName(side(after, 1))
    there = [F.max((F.col("__sign") == sign).cast("bigint")) for sign in (1, -1)]
    pairs = lines.groupBy("order_id", "product_id").agg(
        F.sum("__sign").alias("order_line_count"),
        F.when(F.col("order_id").isNotNull(), there[0] - there[1]).otherwise(0).alias("order_count"),
        *[
            F.coalesce(money_sum(lines, c), F.lit(0)).alias(total)
            for c, total in (("price", "total_product_value"), ("freight_value", "total_freight_value"))
        ],
    )
    changed = " OR ".join(f"{c} <> 0" for c in SALES)
    return pairs.filter(changed).groupBy("product_id").agg(*[F.sum(c).alias(c) for c in SALES]).filter(changed)


def _refresh_products(warehouse: Warehouse, before: dict) -> bool:
    """Only where the products have not changed, and amounts are whole cents (sums of rounded ones drift)."""
    if before["inputs"]["products"] != warehouse.state("silver", "products"):
        return False
    lines = _both_sides(warehouse, before, "order_items", "silver", "order_items", "order_id")
    if lines is None or layout_in(before, "order_items").part_by != ("order_id",):
        return False
    schema = lines[1].schema
    kinds = [schema[c].dataType for c in ("price", "freight_value")]
    if not all(isinstance(k, T.IntegralType) or (isinstance(k, T.DecimalType) and k.scale <= 2) for k in kinds):
        return False
    mart = warehouse.read("gold", "product_summary")
    added = staged(sales_changes(*lines)).select("product_id", *[F.col(c).alias(f"__{c}") for c in SALES])
    fresh = {c: (F.col(c) + F.col(f"__{c}")).cast(mart.schema[c].dataType).alias(c) for c in SALES}
    rows = mart.join(added, "product_id").select(*[fresh.get(c, quoted(c)) for c in mart.columns])
    rows = staged(rows)
    warehouse.merge("gold", "product_summary", rows, ["product_id"], source_is_unique=True)
    return True


def _rebuild_products(warehouse: Warehouse) -> None:
    mart = product_summary(warehouse.read("silver", "products"), warehouse.read("silver", "order_items"))
    warehouse.overwrite("gold", "product_summary", mart, schema_may_change=True, part_by=("product_id",))


# -- the run ---------------------------------------------------------------------------


def publish_fact(warehouse: Warehouse, force: bool = False) -> str:
    inputs = {t: ("silver", t) for t in FACT_INPUTS}
    return _build(warehouse, "fact_orders", inputs, _refresh_fact, _rebuild_fact, force)


def publish_customers(warehouse: Warehouse, force: bool = False) -> str:
    inputs = {"customers": ("silver", "customers"), "fact_orders": ("gold", "fact_orders")}
    return _build(warehouse, "customer_summary", inputs, _refresh_customers, _rebuild_customers, force)


def publish_products(warehouse: Warehouse, force: bool = False) -> str:
    inputs = {t: ("silver", t) for t in ("products", "order_items")}
    return _build(warehouse, "product_summary", inputs, _refresh_products, _rebuild_products, force)


def run_gold(warehouse: Warehouse, force: bool = False) -> dict[str, int]:
    """Bring the three marts up to date from Silver; returns their row counts.

    ``force`` builds them in full, whatever has changed.
    """
    publish_fact(warehouse, force)
    publish_customers(warehouse, force)
    publish_products(warehouse, force)
    return mart_rows(warehouse)


def mart_rows(warehouse: Warehouse) -> dict[str, int]:
    return {mart: warehouse.rows("gold", mart) for mart in ("fact_orders", "customer_summary", "product_summary")}
