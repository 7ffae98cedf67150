"""Spec-driven cleaning: trim, then deduplicate."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.columns import trimmed
from tidemark.operators.dedup import distinct_rows, latest_per_key
from tidemark.specs import TableSpec


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Trim the spec's string columns and keep one row per key.

    Cleaning runs before validation: of several versions of a row the latest
    one is judged.
    """
    df = trimmed(df, spec.trimmed)
    if not spec.keys:
        return distinct_rows(df)
    return latest_per_key(df, spec.keys, spec.watermark)
