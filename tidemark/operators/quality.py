"""Quality verdicts and the valid / quarantined split."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import first_failure
from tidemark.specs import Rule

REASON = "quarantine_reason"


def tagged(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Add the verdict once; both sides of the split read the same column."""
    return df.withColumn(REASON, first_failure(rules))


def accepted(tagged_rows: DataFrame) -> DataFrame:
    return tagged_rows.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(tagged_rows: DataFrame) -> DataFrame:
    return tagged_rows.filter(F.col(REASON).isNotNull())


def reason_counts(tagged_rows: DataFrame) -> DataFrame:
    """Rows per verdict; valid rows have a NULL reason."""
    return tagged_rows.groupBy(REASON).agg(F.count("*").alias("row_count"))
