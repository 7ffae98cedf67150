"""Silver: clean, judge, split into valid and quarantined rows, merge both."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tidemark.operators.cleaning import clean
from tidemark.operators.quality import accepted, rejected, tagged
from tidemark.operators.upsert import keys_among
from tidemark.operators.watermark import since
from tidemark.plans.stamps import spec_version, stamp_of
from tidemark.shared import staged
from tidemark.specs import TABLES, TableSpec
from tidemark.warehouse import Warehouse


def judged(batch: DataFrame, spec: TableSpec) -> DataFrame:
    """Cleaned rows with their verdict."""
    return tagged(clean(batch, spec), spec.rules)


def valid_rows(batch: DataFrame, spec: TableSpec) -> DataFrame:
    """The batch as it would enter Silver."""
    return accepted(judged(batch, spec)) if spec.rules else clean(batch, spec)


def invalid_rows(batch: DataFrame, spec: TableSpec) -> DataFrame:
    """The batch as it would enter quarantine, with the reason."""
    return rejected(judged(batch, spec))


def refine(
    warehouse: Warehouse,
    spec: TableSpec,
    lookback: str | None = None,
    clear_repaired: bool = False,
    force: bool = False,
) -> bool:
    """Update one Silver table and its quarantine from Bronze; whether there was anything to do.

    Incremental tables take the Bronze rows at or above the highest mark among
    valid Silver rows, or from ``lookback`` below it (SQL, e.g. ``INTERVAL '3'
    DAY``); static ones are rebuilt. A row that turns bad leaves its last good
    version in Silver. A repaired one stays listed in quarantine, unless
    ``clear_repaired`` asks for its entry to be deleted.

    A table whose Bronze rows, specification and options are those it was built
    from is left as it is; ``force`` builds it all the same.
    """
    name = spec.name
    options = f"lookback={lookback} clear_repaired={clear_repaired}"
    stamp = stamp_of(warehouse, {"bronze": ("bronze", name)}, spec_version(spec), options)
    if not force and stamp is not None and warehouse.built_from("silver", name) == stamp:
        return False
    _update(warehouse, spec, lookback, clear_repaired)
    # Last of all: a run that dies before is repeated.
    if stamp is not None:
        warehouse.stamp("silver", name, stamp)
    return True


def _update(warehouse: Warehouse, spec: TableSpec, lookback: str | None, clear_repaired: bool) -> None:
    name, mark_column = spec.name, spec.watermark
    batch = warehouse.read("bronze", name)
    if not (spec.is_incremental and warehouse.exists("silver", name)):
        if spec.rules:
            warehouse.overwrite_judged(
                "silver",
                name,
                judged(batch, spec),
                mark_column,
                keep_rejected=lambda bad: write_quarantine(warehouse, spec, bad),
                part_by=spec.part_by,
            )
        else:
            warehouse.overwrite("silver", name, clean(batch, spec), mark_column, part_by=spec.part_by)
        return

    # The verdict is evaluated once; both sides of the split read the result.
    # Quarantine goes first: only the Silver mark decides what is read next time.
    mark = warehouse.watermark("silver", name, mark_column)
    if mark is not None:
        mark = mark.earlier(warehouse.spark, lookback)
    rows = warehouse.staged("silver", name, judged(since(batch, mark), spec))
    valid = accepted(rows)
    write_quarantine(warehouse, spec, rejected(rows), valid if clear_repaired else None)
    changes = warehouse.staged_changes("silver", name, valid, spec.keys, source_is_unique=True)
    warehouse.merge("silver", name, changes, spec.keys, mark_column, source_is_unique=True)


def write_quarantine(
    warehouse: Warehouse, spec: TableSpec, bad: DataFrame, repaired: DataFrame | None = None
) -> None:
    """Create or merge the quarantine table; nothing happens without a change.

    Keys are compared null-safe: a row rejected for its missing key is replaced
    when it is read again instead of piling up. Entries whose key is among the
    ``repaired`` rows are deleted in the same merge.
    """
    name = spec.name
    if not warehouse.exists("quarantine", name):
        if not bad.isEmpty():
            warehouse.overwrite("quarantine", name, bad, part_by=spec.part_by)
        return
    changes = warehouse.staged(
        "quarantine",
        name,
        warehouse.changes("quarantine", name, bad, spec.keys, null_safe=True, source_is_unique=True),
    )
    gone = None
    if repaired is not None:
        gone = staged(keys_among(warehouse.read("quarantine", name), repaired, spec.keys))
        if gone.isEmpty():
            gone = None
    warehouse.merge("quarantine", name, changes, spec.keys, null_safe=True, source_is_unique=True, gone=gone)


def run_silver(
    warehouse: Warehouse,
    specs: Iterable[TableSpec] = TABLES.values(),
    lookback: str | None = None,
    clear_repaired: bool = False,
) -> None:
    for spec in specs:
        refine(warehouse, spec, lookback, clear_repaired)
