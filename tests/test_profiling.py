"""Reports against brute force on small frames."""

from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of, rows
from tidemark.operators import profiling as p


@pytest.fixture
def df(spark):
    data = [(1, "a"), (1, "a"), (2, "b"), (None, "b"), (None, None), (3, None)]
    return spark.createDataFrame(data, "k int, v string")


def test_grain(df):
    assert rows(p.grain(df, ["k"])) == [(6, 4, 3, 2)]
    assert rows(p.grain(df, ["k", "v"])) == [(6, 5, 2, 1)]
    assert rows(p.grain(df)) == [(6, 5, 2, 1)]
    assert rows(p.grain(df.filter("false"), ["k"])) == [(0, 0, 0, 0)]


def test_null_counts_in_one_scan(df):
    assert rows(p.null_counts(df)) == [("k", 2), ("v", 2)]
    assert rows(p.null_counts(df.filter("false"))) == [("k", 0), ("v", 0)]
    assert plan_of(p.null_counts(df)).count("Scan") == 1


def test_one_pass(df):
    report = p.one_pass(df, {"big": "k > 1"})
    assert plan_of(report).count("Scan") == 1
    assert dict(rows(report)) == {"rows": 6, "nulls:k": 2, "nulls:v": 2, "check:big": 2}


def test_flag_counts_ignore_unknown(df):
    flags = {"big": "k > 1", "small": "k < 2", "none": "k > 100"}
    assert rows(p.flag_counts(df, flags)) == [("big", 2), ("none", 0), ("small", 2)]


def test_frequency_and_repeats(df):
    assert [tuple(r) for r in p.frequency(df, "v").collect()] == [(None, 2), ("a", 2), ("b", 2)]
    assert rows(p.repeated_keys(df, ["k"])) == sorted([(None, 2), (1, 2)], key=repr)


def test_heaviest_keys_break_ties_by_key(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("k"), "id")
    top = p.heaviest_keys(df, ["k"], 3, {"total": F.sum("id")})
    assert [tuple(r) for r in top.collect()] == [(0, 10, 450), (1, 10, 460), (2, 10, 470)]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_attribute_drift_of_a_hot_entity(spark):
    df = spark.range(20_000).selectExpr(
        "IF(id % 3 = 0, id, NULL) AS e", "CAST(id % 7 AS INT) AS a", "IF(id % 2 = 0, NULL, CAST(id % 5 AS STRING)) AS `b.c`",
        "IF(id % 2 = 0, 0.0D, -0.0D) AS z")
    drift = p.attribute_drift(df, "e", ["a", "b.c", "z"])
    assert "Expand" not in plan_of(drift) and "partial_count" in plan_of(drift)
    got = {r[0]: tuple(r[1:]) for r in drift.filter("e IS NULL OR e < 5").collect()}
    assert got == {None: (7, 5, 1), 0: (1, 0, 1), 3: (1, 1, 1)}


def test_attribute_drift(spark):
    data = [("u", 1, "x"), ("u", 2, "x"), ("u", 2, None), ("w", 1, "y")]
    df = spark.createDataFrame(data, "e string, a int, b string")
    drift = [tuple(r) for r in p.attribute_drift(df, "e", ["a", "b"]).collect()]
    assert drift == [("u", 2, 1), ("w", 1, 1)]
    assert p.attribute_drift(df, "e", ["a"], k=1).count() == 1


def test_coverage(df):
    assert rows(p.coverage(df, "k")) == [(3, 6)]


def test_orphans(spark):
    child = spark.createDataFrame(
        [(1, 10), (1, 5), (2, 7), (None, 3), (None, 4)], "k int, v int"
    )
    parent = spark.createDataFrame([(1,), (1,), (9,)], "k int")
    assert rows(p.orphan_keys(child, parent, "k")) == sorted([(2,), (None,)], key=repr)
    assert rows(p.orphan_count(child, parent, "k")) == [(2,)]
    assert rows(p.orphan_value(child, parent, "k", "v")) == [(14,)]
    assert rows(p.childless_count(parent, child, "k")) == [(1,)]


def test_fan_out_equals_the_real_join(spark):
    parent = spark.range(20).withColumnRenamed("id", "k")
    a = spark.range(60).select((F.col("id") % 7).alias("k"))
    b = spark.range(30).select((F.col("id") % 11).alias("k"))
    joined = parent.join(a.withColumn("x", F.lit(1)), "k", "left").join(
        b.withColumn("y", F.lit(1)), "k", "left"
    )
    expected = (joined.count(), joined.select("k").distinct().count())
    assert rows(p.fan_out(parent, [a, b], "k")) == [expected]


def test_fan_out_beyond_a_bigint(spark):
    parent = spark.range(1).withColumnRenamed("id", "k")
    child = spark.range(3_000_000).select(F.lit(0).cast("long").alias("k"))
    assert rows(p.fan_out(parent, [child] * 3, "k")) == [(27 * 10**18, 1)]


def test_entity_reports(spark):
    people = spark.createDataFrame([("u", 1), ("u", 2), ("w", 3), ("z", 4)], "u string, c int")
    orders = spark.createDataFrame([(1, 10), (1, 11), (2, 12), (3, 13), (8, 1)], "c int, o int")
    assert rows(p.entity_activity(people, orders, "u", None, "c", "o")) == [
        ("u", 2, 3), ("w", 1, 1), ("z", 1, 0),
    ]
    assert rows(p.entity_activity(people, orders, "u", "u", "c", "o")) == [("u", 2, 3)]
    assert rows(p.entity_rows(orders, "c", 1, ["o"], ["o"])) == [(10,), (11,)]


def test_samples_and_counts(df):
    flagged = p.offending_rows(df, "v IS NULL", ["k", "v"], ["k"], k=1)
    assert rows(flagged) == [(None, None)]
    assert p.preview(df, ["k", "v"], 4).count() == 4
    assert rows(p.row_counts({"t": df, "empty": df.filter("false")})) == [("empty", 0), ("t", 6)]


def test_sums_are_exact_on_skewed_decimals(spark):
    """A third of all rows under one key: the same totals, however partitioned."""
    from tidemark.operators.aggregates import item_summary, product_sales_summary

    n = 9000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("order_id"),
        F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id") % 50).alias("product_id"),
        (F.col("id") % 1000 / 100).cast("double").alias("price"),
        F.lit(0.1).alias("freight_value"),
    )
    expected = Counter()
    for i in range(n):
        expected[0 if i % 3 == 0 else i] += Decimal(i % 1000) / 100
    for parts in (1, 7):
        got = {
            r.order_id: r.total_product_value
            for r in item_summary(df.repartition(parts)).collect()
        }
        assert got == {k: v.quantize(Decimal("0.01")) for k, v in expected.items()}
        hot = product_sales_summary(df.repartition(parts)).filter("product_id = 0").first()
        assert hot.order_line_count >= n // 3
        assert hot.total_freight_value == Decimal("0.1") * hot.order_line_count
