"""Profiles that the writes measure: equal to a pass over the table, without one."""

import random
import subprocess
import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_of, rows
from tidemark.layout import parts_touched
from tidemark.operators.profiling import one_pass
from tidemark.operators.quality import REASON, tagged
from tidemark.specs import Rule
from tidemark.warehouse import Warehouse

SCHEMA = "k int, v string, n int"
CHECKS = {"t": {"n_negative": "n < 0", "text's_empty": "v = ''"}}


@pytest.fixture
def settings(tmp_path):
    return {"root": str(tmp_path), "namespace": f"q{uuid.uuid4().hex[:8]}_", "parts": 6}


@pytest.fixture
def house(spark, settings):
    return Warehouse(spark, checks=CHECKS, **settings)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def random_rows(rng, keys):
    return [(k, rng.choice([None, "", "x"]), rng.choice([None, -1, 0, 5])) for k in keys]


def scanned(house, checks=CHECKS["t"]):
    return rows(one_pass(house.read("silver", "t"), checks))


def reads_nothing(report):
    return "FileScan" not in plan_of(report)


def test_merges_keep_the_profile_of_every_part(spark, house):
    rng = random.Random(3)
    house.overwrite("silver", "t", frame(spark, random_rows(rng, [None, None, *range(80)])), part_by=("k",))
    for _ in range(4):
        assert rows(house.profile("silver", "t")) == scanned(house)
        assert reads_nothing(house.profile("silver", "t"))
        source = frame(spark, random_rows(rng, rng.sample(range(120), 2)))
        gone = frame(spark, random_rows(rng, rng.sample(range(80), 2))).select("k")
        house.merge("silver", "t", source, ["k"], source_is_unique=True, gone=gone)
    assert rows(house.profile("silver", "t")) == scanned(house)


def test_tables_without_parts_are_observed(spark, house):
    house.overwrite("silver", "t", frame(spark, random_rows(random.Random(5), range(40))))
    assert rows(house.profile("silver", "t")) == scanned(house)
    assert reads_nothing(house.profile("silver", "t"))
    house.merge("silver", "t", frame(spark, [(1, None, -7)]), ["k"])
    assert rows(house.profile("silver", "t")) == scanned(house)


@pytest.mark.parametrize("part_by", [(), ("k",)])
def test_rejected_rows_do_not_count(spark, house, part_by):
    judged = tagged(frame(spark, random_rows(random.Random(7), range(60))), [Rule("odd", "k % 2 = 1")])
    house.overwrite_judged("silver", "t", judged, None, lambda bad: None, part_by)
    report = dict(rows(house.profile("silver", "t")))
    assert report["rows"] == 30 and f"nulls:{REASON}" not in report
    assert rows(house.profile("silver", "t")) == scanned(house)
    assert reads_nothing(house.profile("silver", "t"))


@pytest.mark.parametrize("part_by", [(), ("k",)])
def test_empty_tables_count_zero(spark, house, part_by):
    house.overwrite("silver", "t", frame(spark, []), part_by=part_by)
    assert {n for _, n in rows(house.profile("silver", "t"))} == {0}
    assert rows(house.profile("silver", "t")) == scanned(house)


def test_only_parts_without_these_counts_are_read(spark, settings, house):
    """A table written without counts, then merged into by a warehouse that counts."""
    plain = Warehouse(spark, **settings)
    plain.overwrite("silver", "t", frame(spark, random_rows(random.Random(9), range(60))), part_by=("k",))
    assert rows(plain.profile("silver", "t")) == scanned(house, None)
    assert rows(house.profile("silver", "t")) == scanned(house)
    change = frame(spark, [(5, "", -3)])
    house.merge("silver", "t", change, ["k"], source_is_unique=True)
    counted = {p for p, held in house.layout("silver", "t").parts.items() if held.counts is not None}
    assert counted == set(parts_touched(change, house.layout("silver", "t")))
    asked = []
    house.read_parts = lambda *a: asked.append(set(a[2])) or Warehouse.read_parts(house, *a)
    assert rows(house.profile("silver", "t")) == scanned(house)
    assert asked == [set(house.layout("silver", "t").parts) - counted]


@pytest.mark.parametrize("part_by", [(), ("k",)])
def test_changed_checks_are_counted_anew(spark, settings, house, part_by):
    house.overwrite("silver", "t", frame(spark, random_rows(random.Random(11), range(60))), part_by=part_by)
    other = {"n_negative": "n < 5"}
    changed = Warehouse(spark, checks={"t": other}, **settings)
    assert rows(changed.profile("silver", "t")) == scanned(house, other)
    changed.merge("silver", "t", frame(spark, [(5, "", -3)]), ["k"], source_is_unique=True)
    assert rows(changed.profile("silver", "t")) == scanned(house, other)
    assert rows(house.profile("silver", "t")) == scanned(house)


def test_many_columns_fit_into_the_properties(spark, house):
    wide = spark.range(3).select("id", *[F.lit(None).cast("int").alias(f"column_{n:04d}") for n in range(300)])
    house.overwrite("silver", "wide", wide)
    report = dict(rows(house.profile("silver", "wide")))
    assert len(report) == 302 and report["rows"] == 3 and report["nulls:id"] == 0
    assert report["nulls:column_0299"] == 3


RETRIED = """
import sys
from pyspark import TaskContext
from tidemark.operators.profiling import one_pass
from tidemark.session import build_session
from tidemark.warehouse import Warehouse

spark = build_session("retried", master="local[2,3]", **{
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "3",
    "spark.sql.warehouse.dir": sys.argv[1] + "/warehouse",
})

def late_failure(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost after its last row")

rows = spark.range(0, 5000, 1, 3).selectExpr("id AS k", "IF(id % 7 = 0, NULL, id - 50) AS n")
rows = rows.mapInPandas(late_failure, "k bigint, n bigint")
house = Warehouse(spark, root=sys.argv[1] + "/root", checks={"t": {"negative": "n < 0"}})
for part_by in ((), ("k",)):
    house.overwrite("silver", "t", rows, part_by=part_by)
    held = one_pass(house.read("silver", "t"), {"negative": "n < 0"})
    assert house.rows("silver", "t") == 5000
    assert sorted(held.collect()) == sorted(house.profile("silver", "t").collect())
spark.stop()
print("counted once")
"""


def test_retried_tasks_are_counted_once(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", RETRIED, str(tmp_path)],
        cwd=Path(__file__).resolve().parents[1],
        capture_output=True,
        text=True,
        timeout=180,
    )
    assert "counted once" in done.stdout, done.stderr[-3000:]
