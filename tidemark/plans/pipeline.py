"""The three layers, each table as soon as what it needs is there."""

from __future__ import annotations

from collections.abc import Callable

from tidemark.plans.bronze import ingest
from tidemark.plans.marts import FACT_INPUTS, mart_rows, publish_customers, publish_fact, publish_products
from tidemark.plans.silver import refine
from tidemark.plans.together import Step, run_together
from tidemark.retention import Lease
from tidemark.specs import TABLES, TableSpec
from tidemark.warehouse import Warehouse


def run_pipeline(
    warehouse: Warehouse,
    source,
    refresh: bool = False,
    lookback: str | None = None,
    clear_repaired: bool = False,
    workers: int = 4,
) -> dict[str, int]:
    """Ingest, refine and bring the marts up to date; returns the marts' row counts.

    Up to ``workers`` tables are worked on at once. If some fail, the others are
    published nevertheless, marts without them included, and `StepsFailed` names
    the failed ones; a repeated run picks up from there. A lease, renewed by each
    step, keeps `retention.clean_up` from what the run reads and writes.
    """

    def table(spec: TableSpec) -> None:
        lease.renew()
        ingest(warehouse, source, spec, refresh, lookback)
        refine(warehouse, spec, lookback, clear_repaired)

    def mart(publish: Callable[[Warehouse], object]) -> None:
        lease.renew()
        publish(warehouse)

    steps = [Step(spec.name, lambda spec=spec: table(spec)) for spec in TABLES.values()]
    steps += [
        Step("fact_orders", lambda: mart(publish_fact), after=FACT_INPUTS),
        Step("product_summary", lambda: mart(publish_products), after=("products", "order_items")),
        Step("customer_summary", lambda: mart(publish_customers), after=("customers", "fact_orders")),
    ]
    with Lease(warehouse.spark) as lease:
        run_together(warehouse.spark, steps, workers)
        return mart_rows(warehouse)
