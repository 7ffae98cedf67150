"""Seeded samples, pairs and open orders."""

import hashlib
import math
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tidemark.functions.draws import digest
from tidemark.operators.changes import orders_in, product_seller_pairs
from tidemark.operators.ranking import POSITION, share_of, shuffled_positions, shuffled_sample


def expected_order(seed, n):
    key = {i: hashlib.md5(f"{seed}|{i}".encode()).hexdigest() for i in range(n)}
    return sorted(key, key=lambda i: (key[i], i))


@pytest.mark.parametrize("parts", [1, 5])
def test_positions_are_the_global_digest_order(spark, parts):
    df = spark.range(3000).repartition(parts)
    got = {r[POSITION]: r["id"] for r in shuffled_positions(df, ["id"], "s").collect()}
    assert got == {i + 1: v for i, v in enumerate(expected_order("s", 3000))}


def test_sample_by_rows_and_by_share_agree(spark):
    df = spark.range(5000)
    first = set(expected_order("x", 5000)[:100])
    assert {r["id"] for r in shuffled_sample(df, ["id"], "x", rows=100).collect()} == first
    assert {r["id"] for r in shuffled_sample(df, ["id"], "x", share=0.02).collect()} == first
    big = shuffled_sample(spark.range(30_000), ["id"], "x", rows=20_000)
    assert big.count() == 20_000 and big.distinct().count() == 20_000
    assert shuffled_sample(df, ["id"], "x", share=0.0001).count() == 1
    assert shuffled_sample(spark.range(100_000), ["id"], "x", share=0.0001).count() == 10
    with pytest.raises(ValueError):
        shuffled_sample(df, ["id"], "x")


@pytest.mark.parametrize("groups", [1, 7, 1000])
def test_groups_do_not_change_the_result(spark, groups):
    df = spark.range(2000)
    got = {r["id"] for r in shuffled_sample(df, ["id"], "x", rows=150, groups=groups).collect()}
    assert got == set(expected_order("x", 2000)[:150])


@pytest.mark.parametrize("share", [1, 0.5, 0.1, 0.07, 0.0005, 1e-7, Decimal("0.333333333333333333")])
def test_share_is_exact(spark, share):
    for n in (0, 1, 3, 999, 10_000):
        expected = math.ceil(n * Decimal(str(share)))
        assert spark.range(1).select(share_of(spark.range(n), share).alias("n")).first()["n"] == expected


def test_share_out_of_range(spark):
    for share in (0, -0.1, 1.01):
        with pytest.raises(ValueError):
            shuffled_sample(spark.range(5), ["id"], "x", share=share)


def test_sample_filters_before_the_exchange(spark):
    plan = shuffled_sample(spark.range(5000), ["id"], "x", rows=10)._jdf.queryExecution().optimizedPlan().toString()
    below_window = plan[plan.index("row_number") :]
    assert re.search(r"Filter .*< 10\)", below_window)


def test_digest(spark):
    row = spark.range(1).select(digest("d", F.lit(None).cast("string")).alias("h")).first()
    assert row["h"] == hashlib.md5(b"d|").hexdigest()


def test_open_orders(spark):
    df = spark.createDataFrame([(1, "created"), (2, "delivered"), (3, None), (4, "shipped")], "order_id int, order_status string")
    assert rows(orders_in(df), "order_id") == [(1,), (4,)]
    assert rows(orders_in(df, ["delivered"]), "order_id") == [(2,)]


def test_pairs_skip_unknown_sides(spark):
    data = [("p", "s"), ("p", "s"), ("p", None), (None, "s")]
    df = spark.createDataFrame(data, "product_id string, seller_id string")
    assert rows(product_seller_pairs(df)) == [("p", "s")]
