"""Trimming and deterministic deduplication."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of, rows, ts
from tidemark.functions.columns import trimmed
from tidemark.operators.cleaning import clean
from tidemark.operators.dedup import latest_per_key
from tidemark.specs import TABLES


def test_trim_strips_spaces_only(spark):
    df = spark.createDataFrame([("  a b ", "\tx\t"), (None, " ")], "a string, b string")
    assert rows(trimmed(df, ["a", "b"])) == sorted([("a b", "\tx\t"), (None, "")], key=repr)


def test_latest_version_wins_before_validation(spark):
    data = [
        ("o1", "created ", ts("2020-01-01")),
        ("o1", " shipped ", ts("2020-01-03")),
        ("o1", "approved", ts("2020-01-02")),
        ("o2", "created", None),
        ("o2", "approved", ts("2020-01-01")),
    ]
    df = spark.createDataFrame(data, "order_id string, order_status string, updated_at timestamp_ntz")
    got = rows(clean(df, TABLES["orders"]), "order_id", "order_status")
    assert got == [("o1", "shipped"), ("o2", "approved")]


def test_null_keys_count_as_equal(spark):
    data = [(None, 1), (None, 2), ("a", 3)]
    df = spark.createDataFrame(data, "k string, v int")
    assert rows(latest_per_key(df, ["k"])) == sorted([(None, 2), ("a", 3)], key=repr)


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_survivor_does_not_depend_on_partitioning(spark, parts):
    df = spark.range(2000).select(
        (F.col("id") % 50).alias("k"),
        F.lit(1).alias("updated_at"),
        F.when(F.col("id") % 3 > 0, F.xxhash64("id")).alias("v"),
        F.md5(F.col("id").cast("string")).alias("w"),
    )
    expected = {}
    for r in df.collect():
        rank = (r.v is not None, r.v or 0, r.w)
        if r.k not in expected or rank > expected[r.k][0]:
            expected[r.k] = (rank, (r.k, r.updated_at, r.v, r.w))
    got = latest_per_key(df.repartition(parts), ["k"], "updated_at")
    assert rows(got) == sorted((v for _, v in expected.values()), key=repr)


def test_all_columns_key_is_distinct(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (None, 2), (None, 2)], "a int, b int")
    assert latest_per_key(df, ["a", "b"]).count() == 2


def test_whole_row_duplicates_after_trim(spark):
    data = [(1.0, 2.0, " x", "y "), (1.0, 2.0, "x ", " y"), (1.0, 2.5, "x", "y")]
    df = spark.createDataFrame(
        data,
        "geolocation_lat double, geolocation_lng double,"
        " geolocation_city string, geolocation_state string",
    )
    assert clean(df, TABLES["geolocation"]).count() == 2


def test_dedup_limits_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(latest_per_key(df, ["k"]))
    assert "Partial" in plan[plan.index("Exchange") :]
    assert plan.count("Exchange") == 1
