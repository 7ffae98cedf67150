"""Tables of one key and as many parts meet and are written again without a shuffle."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of
from tidemark.layout import PART
from tidemark.operators.upsert import upsert
from tidemark.operators.watermark import Watermark, since
from tidemark.shared import shared_folder
from tidemark.specs import TABLES
from tidemark.verify import queries
from tidemark.verify.queries import CurrentSource, new_warehouse

KEYS = ["order_id", "line"]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def house(spark, no_broadcast):
    """Two runs: the view is a union of both; some rows have no order."""
    warehouse = new_warehouse(spark)
    rows = spark.range(600).select(
        F.expr("CASE WHEN id % 50 <> 7 THEN id div 3 END").alias("order_id"),
        (F.col("id") % 3).alias("line"),
        F.lit("old").alias("v"),
    )
    warehouse.overwrite("silver", "lines", rows, part_by=("order_id",))
    warehouse.merge("silver", "lines", rows.filter("order_id = 5").withColumn("v", F.lit("mid")), KEYS)
    return warehouse


def source_of(house):
    lines = house.read("silver", "lines").filter("order_id % 2 = 0")
    return house.staged("silver", "lines", lines.withColumn("v", F.lit("new")))


def test_changes_and_merge_move_no_row(spark, house):
    assert len(house.layout("silver", "lines").runs()) == 2
    source = source_of(house)
    found = house.changes("silver", "lines", source, KEYS)
    assert "Exchange" not in plan_of(found)
    changes = house.staged("silver", "lines", found)
    target = house.read_parts("silver", "lines", range(4))
    merged = upsert(target, changes, KEYS).repartition(4, "order_id").withColumn(PART, F.lit(0))
    assert "Exchange" not in plan_of(merged)
    before = house.read("silver", "lines").collect()
    house.merge("silver", "lines", changes, KEYS)
    after = house.read("silver", "lines").collect()
    expected = [(r.order_id, r.line, "new" if r.order_id is not None and r.order_id % 2 == 0 else r.v) for r in before]
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in after)


def test_each_part_is_one_file(spark, house):
    run = house.snapshot("silver", "lines")
    files = spark.table(house.name("silver", run)).select(PART, F.input_file_name().alias("f")).distinct()
    assert files.count() == files.select(PART).distinct().count()


def test_staged_rows_leave_no_table(house):
    before = set(house.run_tables("silver"))
    assert source_of(house).count() > 0
    assert set(house.run_tables("silver")) == before


def test_rows_below_the_mark_are_left_out_before_the_newest_are_sought(spark):
    spec = TABLES["orders"]
    rows = spark.sql(
        """SELECT order_id, status AS order_status, CAST(at AS TIMESTAMP_NTZ) AS updated_at FROM VALUES
           (1, 'a', '2020-01-01'), (1, 'b', '2020-02-01'), (2, 'c', '2020-01-01'), (3, 'd', NULL),
           (NULL, 'e', '2020-03-01'), (NULL, 'f', '2020-01-05'), (4, 'g', '2020-02-01'), (4, 'h', '2020-02-01')
           AS t(order_id, status, at)"""
    )
    source, mark = CurrentSource({"orders": rows}), Watermark("updated_at", "timestamp_ntz", "2020-01-15 00:00:00")
    found = source.read_since(spec, mark)
    assert sorted(map(str, found.collect())) == sorted(map(str, since(source.read(spec), mark).collect()))
    assert found.count() == 3


def test_of_the_changes_only_keys_are_written(spark, house):
    """Known, new, repeated and missing keys: the rows come from the staged source."""
    data = [(3, 0, "new"), (4, 1, "old"), (900, 0, "new"), (901, 0, "x"), (901, 0, "y"), (None, 1, "z")]
    source = house.staged("silver", "lines", spark.createDataFrame(data, "order_id bigint, line bigint, v string"))
    expected = house.changes("silver", "lines", source, KEYS)
    found = house.staged_changes("silver", "lines", source, KEYS)
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect())) and found.count() == 5
    written = {path.split("/staged-")[1].split("/")[0] for path in found.inputFiles()}
    columns = [set(spark.read.parquet(f"{shared_folder(spark)}/staged-{folder}").columns) for folder in written]
    assert sorted(map(sorted, columns)) == [["__known", *KEYS[::-1]], [*KEYS[::-1], "v"]]
    assert "Exchange" not in plan_of(found)


def test_large_shops_get_more_parts(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    assert queries.parts_for(spark, folder) == 4
    lines = queries.SourceTables(spark, folder)["order_items"].count()
    monkeypatch.setattr(queries, "PART_ROWS", lines // 9)
    assert queries.parts_for(spark, folder) == 10
    state, _ = queries.two_states(spark, folder)
    assert state["orders"].select(F.spark_partition_id()).distinct().count() == 10
