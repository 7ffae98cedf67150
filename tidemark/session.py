"""Spark session settings this package is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: coalescing, skew-join splitting, broadcast chosen
    # from measured sizes instead of hints.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Timestamps with a zone are rendered and compared in one fixed zone.
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app: str = "tidemark", master: str | None = None, **settings: str
) -> SparkSession:
    """Create a session with the package defaults.

    ``spark.sql.shuffle.partitions`` is left to the caller: on a cluster aim at
    100-200 MB of shuffle data per partition and let AQE coalesce downwards.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
