"""Deterministic duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import quoted

_RANK = "__rank"


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: str | None = None) -> DataFrame:
    """Keep one row per key: the newest, ties broken by all other columns.

    The order is total, so the survivor does not depend on partitioning or on
    a re-run after a lost executor. NULL keys count as equal.

    ``row_number() = 1`` plans a WindowGroupLimit before the exchange: every
    map task sends at most one row per key, so a key that holds a third of the
    table arrives as one row per map task, not as one huge group.
    """
    ranking = [] if newest is None else [newest]
    ranking += [c for c in df.columns if c not in keys and c != newest]
    if not ranking:
        return df.distinct()
    window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(
        *[quoted(c).desc_nulls_last() for c in ranking]
    )
    return df.withColumn(_RANK, F.row_number().over(window)).filter(f"{_RANK} = 1").drop(_RANK)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Remove whole-row duplicates (map-side combined)."""
    return df.distinct()
