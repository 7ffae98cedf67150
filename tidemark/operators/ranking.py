"""Positions and samples in a repeatable random order, without one big sort."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import quoted
from tidemark.functions.draws import DRAW_BITS, as_number, digest

POSITION = "position"
GROUPS = 4_096
MOST_GROUPS = 1 << 16  # their offsets are joined by broadcast: 2 MB at most
_DIGEST = "__digest"
_BUCKET = "__bucket"
_OFFSET = "__offset"


def _bucketed(df: DataFrame, keys: Sequence[str], seed: str, groups: int) -> tuple[DataFrame, DataFrame]:
    """Rows with digest and bucket, and each bucket's number of rows before it."""
    if not 1 <= groups <= MOST_GROUPS:
        raise ValueError(f"groups must be 1 to {MOST_GROUPS}")
    # The bucket grows with the digest: groups of equal width in its first 60 bits.
    width = (1 << DRAW_BITS) // groups + 1
    number = as_number(F.col(_DIGEST))
    marked = df.withColumn(_DIGEST, digest(seed, *[quoted(k) for k in keys])).withColumn(
        _BUCKET, ((number - number % width) / width).cast("int")
    )
    # Window without partition keys: runs over the bounded bucket counts only.
    lower = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        marked.groupBy(_BUCKET)
        .agg(F.count("*").alias("__rows"))
        .select(_BUCKET, F.coalesce(F.sum("__rows").over(lower), F.lit(0)).alias(_OFFSET))
    )
    return marked, F.broadcast(offsets)


def shuffled_positions(
    df: DataFrame, keys: Sequence[str], seed: str, groups: int = GROUPS, first: Column | None = None
) -> DataFrame:
    """Add ``position`` 1..N in the order of a seeded digest of a unique key.

    Global ranking in two levels: rows are ranked within a bucket of digests and
    shifted by the number of rows in lower buckets. Digests spread evenly, so no
    bucket is hot. ``groups`` sets how many buckets there are (at 10^11 rows
    take 65,536); the result doesn't depend on it. With ``first``, only the rows
    up to that position are ranked: buckets beyond it never reach the exchange.
    """
    marked, offsets = _bucketed(df, keys, seed, groups)
    placed = marked.join(offsets, _BUCKET)
    if first is not None:
        placed = placed.filter(F.col(_OFFSET) < first)
    in_bucket = Window.partitionBy(_BUCKET).orderBy(_DIGEST, *[quoted(k) for k in keys])
    ranked = placed.withColumn(POSITION, F.col(_OFFSET) + F.row_number().over(in_bucket))
    if first is not None:
        ranked = ranked.filter(F.col(POSITION) <= first)
    return ranked.drop(_BUCKET, _DIGEST, _OFFSET)


def share_of(df: DataFrame, share: float | Decimal) -> Column:
    """Row count times a share in exact decimals, rounded up, as a scalar subquery."""
    exact = Decimal(str(share))
    if not 0 < exact <= 1:
        raise ValueError("a share lies above 0 and is 1 at most")
    scale = max(0, -exact.as_tuple().exponent)
    if scale > 18:
        raise ValueError("a share has 18 decimal places at most")
    part, whole = int(exact.scaleb(scale)), 10**scale
    # ceil(rows * part / whole) in integers: DIV and % of decimals are exact.
    product = f"(CAST(count(*) AS DECIMAL(19, 0)) * CAST({part} AS DECIMAL(19, 0)))"
    wanted = f"({product} DIV {whole}) + IF({product} % {whole} > 0, 1, 0)"
    return df.agg(F.expr(wanted).cast("bigint").alias("n")).scalar()


def shuffled_sample(
    df: DataFrame,
    keys: Sequence[str],
    seed: str,
    rows: int | None = None,
    share: float | Decimal | None = None,
    groups: int = GROUPS,
) -> DataFrame:
    """Random rows without replacement: a fixed number, or an exact share of the table.

    Same rows for the same seed however the data is partitioned, by one plan for
    every size.
    """
    if (rows is None) == (share is None):
        raise ValueError("give either rows or share")
    wanted = F.lit(rows) if rows is not None else share_of(df, share)
    return shuffled_positions(df, keys, seed, groups, first=wanted).drop(POSITION)
