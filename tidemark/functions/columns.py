"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.specs import Rule

MONEY = "decimal(18,2)"
FINE = "decimal(28,10)"  # in which floats are summed


def quoted(name: str) -> Column:
    """Column by exact name, also when it holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def trimmed(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Strip leading and trailing spaces; tabs and newlines stay."""
    columns = list(columns)
    if not columns:
        return df
    return df.withColumns({c: F.trim(quoted(c)) for c in columns})


def first_failure(rules: Iterable[Rule]) -> Column:
    """Reason of the first rule whose predicate is true, NULL if none is.

    A predicate that evaluates to NULL is not true, so unknown values pass.
    """
    verdict = None
    for rule in rules:
        broken, reason = F.expr(rule.predicate), F.lit(rule.reason)
        verdict = F.when(broken, reason) if verdict is None else verdict.when(broken, reason)
    return F.lit(None).cast("string") if verdict is None else verdict


def all_not_null(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [quoted(c).isNotNull() for c in columns])


def money_sum(df: DataFrame, column: str) -> Column:
    """Exact money total, whatever the order of rows: summed first, then rounded to cents.

    Amounts of whole cents are summed as bigint cents, which take 8 bytes in the
    aggregation buffer and the shuffle where a decimal sum takes 24, and reach
    beyond decimal(18,2). Decimals of more places are summed as they are, floats
    as decimals of ten places, since a float sum depends on the order.
    """
    kind = df.schema[column].dataType
    whole_cents = isinstance(kind, T.IntegralType) or (
        isinstance(kind, T.DecimalType) and kind.scale <= 2
    )
    if not whole_cents:
        exact = isinstance(kind, T.DecimalType)
        return F.sum(quoted(column) if exact else quoted(column).cast(FINE)).cast(MONEY)
    cents = F.sum((quoted(column).cast(MONEY) * 100).cast("bigint"))
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0))


def money_or_zero(column: str) -> Column:
    return or_zero(column).cast(MONEY)
