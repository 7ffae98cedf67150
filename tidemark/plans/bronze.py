"""Bronze ingest: first load, incremental merge, static skip."""

from __future__ import annotations

from collections.abc import Iterable

from tidemark.specs import TABLES, TableSpec
from tidemark.warehouse import Warehouse

LAYER = "bronze"
LOADED, MERGED, UNCHANGED, SKIPPED = "loaded", "merged", "unchanged", "skipped"


def ingest(
    warehouse: Warehouse,
    source,
    spec: TableSpec,
    refresh: bool = False,
    lookback: str | None = None,
) -> str:
    """Bring one table up to date and say how.

    A static table is read once; ``refresh`` loads it again. Of an incremental
    slice only the rows that are new or differ are merged (the rows at the mark
    are always read again), so a slice that holds nothing new leaves the table
    as it is.

    ``lookback`` (SQL, e.g. ``INTERVAL '3' DAY``) reads from so far below the
    mark, for rows that arrive late. What is already stored of that window costs
    a read and a comparison, but no rewrite.
    """
    first = not warehouse.exists(LAYER, spec.name)
    if first or (refresh and not spec.is_incremental):
        warehouse.overwrite(LAYER, spec.name, source.read(spec), mark=spec.watermark, part_by=spec.part_by)
        return LOADED
    if not spec.is_incremental:
        return SKIPPED
    mark = warehouse.watermark(LAYER, spec.name, spec.watermark)
    if mark is not None:
        mark = mark.earlier(warehouse.spark, lookback)
    # The merge reads its source more than once; a live database could answer
    # differently each time, so the slice is fetched once.
    fetched = warehouse.staged(LAYER, spec.name, source.read_since(spec, mark))
    changes = warehouse.staged_changes(LAYER, spec.name, fetched, spec.ingest_keys)
    merged = warehouse.merge(LAYER, spec.name, changes, keys=spec.ingest_keys, mark=spec.watermark)
    return UNCHANGED if merged is None else MERGED


def run_bronze(
    warehouse: Warehouse,
    source,
    specs: Iterable[TableSpec] = TABLES.values(),
    refresh: bool = False,
    lookback: str | None = None,
) -> dict[str, str]:
    return {spec.name: ingest(warehouse, source, spec, refresh, lookback) for spec in specs}
