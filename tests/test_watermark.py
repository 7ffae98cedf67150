"""High-water marks: inclusive boundary, empty targets, exact text round trip."""

import pytest

from tests.helpers import plan_of, rows, ts
from tidemark.operators.watermark import (
    Watermark,
    high_water_mark,
    read_watermark,
    since,
    slice_above,
)

DATA = [
    ("a", ts("2020-01-01T00:00:00")),
    ("b", ts("2020-01-02T03:04:05.678901")),
    ("c", ts("2020-01-03T00:00:00")),
    ("d", None),
]


@pytest.fixture(params=["timestamp_ntz", "timestamp"])
def df(spark, request):
    return spark.createDataFrame(DATA, f"k string, updated_at {request.param}")


def test_boundary_is_inclusive(df):
    mark = read_watermark(df.filter("k < 'c'"))
    assert rows(since(df, mark), "k") == [("b",), ("c",)]


def test_no_mark_takes_everything(spark, df):
    assert read_watermark(df.filter("k > 'z'")) is None
    assert since(df, None).count() == 4


def test_slice_in_one_plan(df):
    assert rows(slice_above(df, df.filter("k < 'c'")), "k") == [("b",), ("c",)]
    assert slice_above(df, df.filter("k > 'z'")).count() == 4


def test_high_water_mark_is_one_row(df):
    assert high_water_mark(df).count() == 1
    assert high_water_mark(df.filter("false")).first()[0] is None


def test_other_types(spark):
    dates = spark.sql("SELECT DATE '2020-05-01' AS updated_at UNION ALL SELECT DATE '2020-06-01'")
    mark = read_watermark(dates)
    assert mark.sql_literal() == "DATE '2020-06-01'"
    assert since(dates, mark).count() == 1
    numbers = spark.range(10).withColumnRenamed("id", "updated_at")
    assert read_watermark(numbers).sql_literal() == "9"


def test_time_zone_of_the_session_does_not_shift_the_mark(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.sql(
            "SELECT 1 AS k, TIMESTAMP '2018-02-17 23:30:00' AS updated_at"
            " UNION ALL SELECT 2, TIMESTAMP '2018-02-17 23:30:00' + INTERVAL 1 HOUR"
        )
        mark = read_watermark(df)
        assert rows(since(df, mark), "k") == [(2,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_literal_is_quoted():
    assert Watermark("c", "string", "o'clock").sql_literal() == "'o''clock'"
    assert Watermark("c", "timestamp_ntz", "2020-01-01 00:00:00").sql_literal() == (
        "TIMESTAMP '2020-01-01 00:00:00'"
    )


def test_zoned_marks_keep_their_offset(spark):
    df = spark.sql("SELECT TIMESTAMP '2020-01-01 00:00:00.25+02:00' AS updated_at")
    assert read_watermark(df).sql_literal() == (
        "TIMESTAMP WITH TIME ZONE '2019-12-31 22:00:00.250000Z'"
    )


def test_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame(DATA, "k string, updated_at timestamp_ntz").write.parquet(
        f"{tmp_path}/t"
    )
    df = spark.read.parquet(f"{tmp_path}/t")
    assert "GreaterThanOrEqual(updated_at" in plan_of(since(df, read_watermark(df)))
