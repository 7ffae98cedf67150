"""Money totals: summed first, rounded once, whatever the order of rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import money_sum


def total(df):
    return df.agg(money_sum(df, "v").alias("t")).first()["t"]


@pytest.mark.parametrize("parts", [1, 4, 7])
@pytest.mark.parametrize(
    ("kind", "value", "rows", "expected"),
    [
        ("decimal(12,4)", "0.004", 5, "0.02"),
        ("decimal(12,2)", "0.10", 1000, "100.00"),
        ("double", "0.1", 1000, "100.00"),
        ("double", "0.0049", 3, "0.01"),
        ("int", "3", 7, "21.00"),
    ],
)
def test_sum_then_cast(spark, parts, kind, value, rows, expected):
    df = spark.range(rows).repartition(parts).select(F.lit(value).cast(kind).alias("v"))
    assert total(df) == Decimal(expected)


def test_nulls(spark):
    assert total(spark.createDataFrame([(None,)], "v double")) is None
    assert total(spark.createDataFrame([(None,), (Decimal("1.005"),)], "v decimal(9,3)")) == Decimal("1.01")
