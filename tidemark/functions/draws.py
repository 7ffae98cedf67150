"""Repeatable pseudo-random order derived from row keys.

``rand()`` gives other values when a lost task is recomputed or the data is
partitioned differently. These digests depend on the key and a seed alone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DRAW_DIGITS = 15
DRAW_BITS = 4 * _DRAW_DIGITS  # 60: fits a signed bigint


def digest(seed: str, *parts: Column) -> Column:
    """32-digit hex digest of the seed and the given values (NULL reads as empty)."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("|", F.lit(seed), *texts))


def as_number(hex_digest: Column) -> Column:
    """First 60 bits of a digest as a non-negative bigint."""
    return F.conv(F.substring(hex_digest, 1, _DRAW_DIGITS), 16, 10).cast("bigint")
