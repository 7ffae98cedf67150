"""Published tables: snapshots, schema checks, recorded marks, buckets."""

import uuid

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of, rows
from tidemark.operators.quality import tagged
from tidemark.operators.upsert import SchemaMismatch
from tidemark.operators.watermark import read_watermark
from tidemark.specs import Rule
from tidemark.warehouse import MergeWarehouse, Warehouse


def new_warehouse(spark, tmp_path, **settings):
    return Warehouse(
        spark, root=str(tmp_path), namespace=f"w{uuid.uuid4().hex[:8]}_", **settings
    )


@pytest.fixture
def house(spark, tmp_path):
    return new_warehouse(spark, tmp_path)


def numbers(spark, n, text="a"):
    return spark.range(n).select(
        "id",
        F.lit(text).alias("v"),
        F.expr("TIMESTAMP_NTZ '2020-01-01' + make_dt_interval(CAST(id AS INT))").alias(
            "updated_at"
        ),
    )


def test_write_read_and_exists(spark, house):
    assert not house.exists("silver", "t")
    published = house.overwrite("silver", "t", numbers(spark, 5))
    assert published.rows == 5
    assert house.exists("silver", "t")
    assert house.read("silver", "t").count() == 5


def test_overwrite_from_its_own_content(spark, house):
    house.overwrite("silver", "t", numbers(spark, 5))
    house.overwrite("silver", "t", house.read("silver", "t").filter("id > 2"))
    assert rows(house.read("silver", "t"), "id") == [(3,), (4,)]


def test_fixed_and_free_schema(spark, house):
    house.overwrite("gold", "t", numbers(spark, 2))
    wider = numbers(spark, 2).withColumn("extra", F.lit(1))
    with pytest.raises(SchemaMismatch):
        house.overwrite("gold", "t", wider)
    house.overwrite("gold", "t", wider, schema_may_change=True)
    assert "extra" in house.read("gold", "t").columns


def test_failed_write_keeps_the_published_state(spark, house):
    house.overwrite("silver", "t", numbers(spark, 3))
    broken = numbers(spark, 3).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        house.overwrite("silver", "t", broken)
    assert house.read("silver", "t").count() == 3


def test_recorded_mark_equals_a_scan(spark, house):
    house.overwrite("silver", "t", numbers(spark, 5), mark="updated_at")
    recorded = house.watermark("silver", "t", "updated_at")
    assert recorded == read_watermark(house.read("silver", "t"))
    house.merge("silver", "t", numbers(spark, 9, "b"), ["id"], mark="updated_at")
    assert house.watermark("silver", "t", "updated_at").text.startswith("2020-01-09")
    house.overwrite("silver", "empty", numbers(spark, 0), mark="updated_at")
    assert house.watermark("silver", "empty", "updated_at") is None


def test_text_marks_are_quoted(spark, house):
    df = spark.createDataFrame([("it's \\ here",)], "version string")
    house.overwrite("silver", "t", df, mark="version")
    assert house.watermark("silver", "t", "version") == read_watermark(df, "version")


def test_merge(spark, house):
    house.overwrite("silver", "t", numbers(spark, 3))
    published = house.merge("silver", "t", numbers(spark, 5, "b").filter("id >= 2"), ["id"])
    assert published.rows == 5
    assert rows(house.read("silver", "t"), "id", "v") == [
        (0, "a"), (1, "a"), (2, "b"), (3, "b"), (4, "b"),
    ]


def test_judged_rows_are_written_once_and_split(spark, house):
    judged = tagged(numbers(spark, 6), [Rule("odd", "id % 2 = 1")])
    kept = []

    def keep(bad):
        assert not house.exists("silver", "t")
        kept.extend(rows(bad, "id", "quarantine_reason"))

    published = house.overwrite_judged("silver", "t", judged, "updated_at", keep)
    assert published.rows == 3
    assert kept == [(1, "odd"), (3, "odd"), (5, "odd")]
    assert rows(house.read("silver", "t"), "id") == [(0,), (2,), (4,)]
    assert house.read("silver", "t").columns == ["id", "v", "updated_at"]
    # The mark is that of the valid rows.
    assert house.watermark("silver", "t", "updated_at").text.startswith("2020-01-05")
    assert "IsNull(quarantine_reason)" in plan_of(house.read("silver", "t"))


def test_rejected_rows_are_kept_before_silver_appears(spark, house):
    def fail(_):
        raise OSError("lost")

    judged = tagged(numbers(spark, 6), [Rule("odd", "id % 2 = 1")])
    with pytest.raises(OSError):
        house.overwrite_judged("silver", "t", judged, "updated_at", fail)
    assert not house.exists("silver", "t")


def test_old_snapshots_can_be_dropped(spark, house):
    for n in (1, 2, 3):
        house.overwrite("silver", "t", numbers(spark, n))
    house.overwrite("silver", "t__other", numbers(spark, 1))
    assert len(house.drop_old_snapshots("silver", "t")) >= 2
    assert house.read("silver", "t").count() == 3
    assert house.read("silver", "t__other").count() == 1


def test_merge_format_uses_the_catalogs_merge(spark, tmp_path):
    """No such format is installed here; a plain table must be asked and refuse."""
    house = MergeWarehouse(
        spark, "parquet", root=str(tmp_path), namespace=f"m{uuid.uuid4().hex[:8]}_"
    )
    house.overwrite("silver", "t", numbers(spark, 3))
    assert house.read("silver", "t").count() == 3
    with pytest.raises(Exception, match="(?i)merge"):
        house.merge("silver", "t", numbers(spark, 5), ["id"])
