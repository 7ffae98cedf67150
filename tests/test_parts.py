"""Merges that write only the parts they touch, and what is known about each part."""

import random
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import plan_of, rows, ts
from tidemark import warehouse as warehouse_module
from tidemark.layout import Layout, Part, parts_touched
from tidemark.operators.upsert import effective
from tidemark.operators.watermark import Watermark, latest_mark, read_watermark
from tidemark.plans.bronze import MERGED, UNCHANGED, ingest
from tidemark.plans.silver import refine
from tidemark.sources import FrameSource
from tidemark.specs import TABLES, Rule
from tidemark.warehouse import Warehouse

SCHEMA = "k int, v string, updated_at timestamp_ntz"


@pytest.fixture
def house(spark, tmp_path):
    return Warehouse(spark, root=str(tmp_path), namespace=f"p{uuid.uuid4().hex[:8]}_", parts=8)


def frame(spark, *data):
    return spark.createDataFrame([(k, v, ts(f"2020-01-{day:02d}")) for k, v, day in data], SCHEMA)


def filled(spark, house, n=200):
    df = spark.range(n).selectExpr("CAST(id AS INT) AS k", "'a' AS v", "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS updated_at")
    house.overwrite("silver", "t", df, mark="updated_at", part_by=("k",))
    return df


def files_by_part(house, table="t"):
    found = {}
    for path in house.read("silver", table).inputFiles():
        part = path.split("__part=")[1].split("/")[0]
        found.setdefault(int(part), set()).add(path)
    return found


def test_one_key_leaves_all_other_parts_as_they_were(spark, house):
    filled(spark, house)
    before = files_by_part(house)
    assert len(before) == 8
    published = house.merge("silver", "t", frame(spark, (17, "b", 2)), ["k"], mark="updated_at", source_is_unique=True)
    after = files_by_part(house)
    assert published.rows == 200
    changed = {part for part in before if before[part] != after[part]}
    assert changed == set(parts_touched(frame(spark, (17, "b", 2)), house.layout("silver", "t")))
    assert len(changed) == 1
    assert rows(house.read("silver", "t").filter("v = 'b'"), "k") == [(17,)]
    assert house.watermark("silver", "t", "updated_at") == read_watermark(house.read("silver", "t"))


def test_merges_equal_a_whole_rewrite(spark, house, monkeypatch):
    """Random change sets, deletions and NULL keys, with few runs kept."""
    monkeypatch.setattr(warehouse_module, "RUNS_KEPT", 3)
    rng, model = random.Random(1), {}
    first = [(k if k else None, "a", 1) for k in range(60)]
    house.overwrite("silver", "t", frame(spark, *first), mark="updated_at", part_by=("k",))
    model = {k: (k, v, ts("2020-01-01")) for k, v, _ in first}
    for step in range(2, 8):
        keys = rng.sample([None, *range(1, 80)], 3)
        source = frame(spark, *[(k, f"s{step}", step) for k in keys])
        gone = rng.sample([k for k in model if k not in keys], 2)
        gone_keys = spark.createDataFrame([(k,) for k in gone], "k int")
        published = house.merge(
            "silver", "t", source, ["k"], "updated_at", null_safe=True, source_is_unique=True, gone=gone_keys
        )
        model = {k: row for k, row in model.items() if k not in gone}
        model |= {k: (k, f"s{step}", ts(f"2020-01-{step:02d}")) for k in keys}
        assert rows(house.read("silver", "t")) == sorted(model.values(), key=repr)
        assert published.rows == len(model) == house.rows("silver", "t")
        assert len(house.layout("silver", "t").runs()) <= 3
        assert house.watermark("silver", "t", "updated_at") == read_watermark(house.read("silver", "t"))
    stale = house.drop_old_snapshots("silver", "t")
    assert stale and rows(house.read("silver", "t")) == sorted(model.values(), key=repr)


def test_the_mark_falls_with_the_rows_that_held_it(spark, house):
    house.overwrite("silver", "t", frame(spark, (1, "a", 9), (2, "a", 3)), mark="updated_at", part_by=("k",))
    house.merge("silver", "t", frame(spark, (1, "b", 2)), ["k"], "updated_at", source_is_unique=True)
    assert house.watermark("silver", "t", "updated_at").text.startswith("2020-01-03")


def test_a_run_that_dies_before_publishing_is_repeated(spark, house, monkeypatch):
    filled(spark, house)
    before = rows(house.read("silver", "t")), house.state("silver", "t")
    change = frame(spark, (3, "b", 2), (500, "b", 2))

    def lost(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(Warehouse, "_point_to_parts", lost)
        with pytest.raises(OSError):
            house.merge("silver", "t", change, ["k"], "updated_at", source_is_unique=True)
    assert (rows(house.read("silver", "t")), house.state("silver", "t")) == before
    assert house.merge("silver", "t", change, ["k"], "updated_at", source_is_unique=True).rows == 201
    assert rows(house.read("silver", "t").filter("v = 'b'"), "k") == [(3,), (500,)]
    assert len(house.drop_old_snapshots("silver", "t")) == 1  # what the dead run left


def test_only_rows_with_an_effect_decide_what_is_written(spark, house):
    df = filled(spark, house)
    source = df.filter("k < 50").withColumn("v", F.when(F.col("k") == 7, "new").otherwise(F.col("v")))
    changes = house.changes("silver", "t", source, ["k"])
    assert rows(changes, "k", "v", "__known") == [(7, "new", True)]
    before = files_by_part(house)
    house.merge("silver", "t", changes, ["k"], "updated_at")
    assert sum(before[p] != files_by_part(house)[p] for p in before) == 1
    assert house.changes("silver", "t", source, ["k"]).isEmpty()


def test_a_small_source_moves_no_target_row(spark, tmp_path):
    spark.range(1000).selectExpr("CAST(id AS INT) AS k", "'a' AS v").write.parquet(f"{tmp_path}/t")
    spark.range(5).selectExpr("CAST(id AS INT) AS k", "'b' AS v").write.parquet(f"{tmp_path}/s")
    target, source = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")
    for unique in (True, False):
        found = effective(target, source, ["k"], source_is_unique=unique)
        plan = plan_of(found)
        assert "SortMergeJoin" not in plan
        for scan in [line for line in plan.splitlines() if f"{tmp_path}/t" in line]:
            above = plan.splitlines()[: plan.splitlines().index(scan)]
            # Between the scan and its join stands nothing but projections and filters.
            nearest = next(x for x in reversed(above) if "Join" in x or "Exchange hash" in x)
            assert "BroadcastHashJoin" in nearest
        assert found.count() == 5


def test_a_part_may_hold_a_hot_key(spark, house):
    df = spark.range(3000).selectExpr(
        "CAST(IF(id % 3 = 0, 1, id) AS INT) AS k", "'a' AS v", "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS updated_at"
    )
    house.overwrite("silver", "t", df, mark="updated_at", part_by=("k",))
    house.merge("silver", "t", frame(spark, (1, "b", 2)), ["k"], "updated_at")
    assert house.read("silver", "t").filter("v = 'b'").count() == 1001
    assert house.rows("silver", "t") == 3000


def test_tables_written_without_parts_are_merged_as_a_whole(spark, house):
    house.overwrite("silver", "t", frame(spark, (1, "a", 1)))
    assert house.layout("silver", "t") is None
    assert house.merge("silver", "t", frame(spark, (2, "b", 2)), ["k"]).rows == 2


@settings(max_examples=50, deadline=None)
@given(
    st.dictionaries(st.integers(0, 500), st.tuples(st.sampled_from(["r1", "r2", "r3"]), st.integers(0, 9), st.none() | st.text(max_size=30))),
    st.sets(st.integers(0, 500)),
)
def test_layouts_survive_their_properties(parts, touched):
    layout = Layout(501, ("a", "b"), {p: Part(*held) for p, held in parts.items()}, frozenset({"r2"}))
    properties = layout.to_properties()
    assert Layout.from_properties(properties | {"other": "x"}) == layout
    assert all(len(v) <= 3500 for v in properties.values())
    after = layout.replaced(touched, {p: Part("new", 1) for p in touched})
    assert after.differing(layout) == touched
    assert layout.without_facts().differing(layout) == set()


@pytest.mark.parametrize(
    ("texts", "dtype", "highest"),
    [
        (["9", "10", "-3"], "int", "10"),
        (["2020-01-01 00:00:00", "2020-01-01 00:00:00.5"], "timestamp_ntz", "2020-01-01 00:00:00.5"),
        (["1.0E10", "9.5"], "double", "1.0E10"),
        (["b", "a", "é"], "string", "é"),
        (["2020-02-01"], "date", "2020-02-01"),
        ([], "int", None),
    ],
)
def test_highest_mark(spark, texts, dtype, highest):
    assert latest_mark(spark, texts, dtype) == highest


def test_marks_move_back(spark):
    mark = Watermark("c", "timestamp_ntz", "2020-03-01 12:00:00")
    assert mark.earlier(spark, "INTERVAL '2' DAY").text == "2020-02-28 12:00:00"
    assert mark.earlier(spark, None) is mark
    assert Watermark("c", "bigint", "100").earlier(spark, "30").text == "70"
    assert Watermark("c", "date", "2020-03-01").earlier(spark, "INTERVAL '1' DAY").text == "2020-02-29"


# -- runs ----------------------------------------------------------------------------

PAYMENTS = TABLES["order_payments"]


def payments(spark, *data):
    made = [(o, s, " card ", i, "1.00", ts(f"2020-01-{d:02d}")) for o, s, i, d in data]
    schema = "order_id string, payment_sequential int, payment_type string, payment_installments int, value string, updated_at timestamp_ntz"
    return spark.createDataFrame(made, schema).selectExpr(
        "order_id", "payment_sequential", "payment_type", "payment_installments",
        "CAST(value AS DECIMAL(12,2)) AS payment_value", "updated_at")


def load(house, df, **settings):
    how = ingest(house, FrameSource({"order_payments": df}), PAYMENTS, lookback=settings.get("lookback"))
    return how, refine(house, PAYMENTS, **settings)


def listed(house):
    return rows(house.read("quarantine", "order_payments"), "order_id", "payment_installments")


def test_unchanged_inputs_are_not_refined_again(spark, house):
    df = payments(spark, ("a", 1, 1, 1), ("b", 1, 0, 2))
    assert load(house, df)[1] is True
    assert load(house, df) == (UNCHANGED, False)
    assert refine(house, PAYMENTS, force=True) is True
    changed = PAYMENTS.__class__(**{**PAYMENTS.__dict__, "rules": (*PAYMENTS.rules, Rule("never", "false"))})
    assert refine(house, changed) is True
    assert refine(house, changed) is False
    assert load(house, payments(spark, ("a", 1, 2, 3), ("b", 1, 0, 2))) == (MERGED, True)


def test_static_tables_are_rebuilt_for_changed_inputs_or_rules_only(spark, house):
    spec = TABLES["sellers"]
    schema = "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string"

    def source(city):
        return FrameSource({"sellers": spark.createDataFrame([("s", 1, city, "x")], schema)})

    ingest(house, source("c"), spec)
    assert refine(house, spec) and not refine(house, spec)
    state = house.state("silver", "sellers")
    ingest(house, source("d"), spec, refresh=True)
    assert refine(house, spec) and house.state("silver", "sellers") != state


def test_repaired_rows_leave_quarantine_on_request(spark, house):
    """Bad, good, bad and good again; a row without an order id too."""
    for clear in (True, False):
        table = Warehouse(house.spark, root=f"{house.root}/{clear}", namespace=f"{house.namespace}{clear}_", parts=4)
        load(table, payments(spark, ("x", 1, 0, 1), (None, 1, -1, 1), ("stays", 1, 0, 1), ("ok", 1, 1, 1)), clear_repaired=clear)
        both = [(None, -1), ("stays", 0), ("x", 0)]
        assert listed(table) == sorted(both, key=repr)
        load(table, payments(spark, ("x", 1, 2, 2), (None, 1, 2, 2)), clear_repaired=clear)
        assert listed(table) == ([("stays", 0)] if clear else sorted(both, key=repr))
        load(table, payments(spark, ("x", 1, -5, 3)), clear_repaired=clear)
        assert ("x", -5) in listed(table)
        assert ("x", 2) in rows(table.read("silver", "order_payments"), "order_id", "payment_installments")
        load(table, payments(spark, ("x", 1, 3, 4)), clear_repaired=clear)
        assert ("x", -5) not in listed(table) if clear else ("x", -5) in listed(table)
        assert ("x", 3) in rows(table.read("silver", "order_payments"), "order_id", "payment_installments")


def test_late_rows_arrive_with_lookback_only(spark, house):
    load(house, payments(spark, ("a", 1, 1, 10), ("same", 1, 1, 8)))
    late = payments(spark, ("a", 1, 1, 10), ("same", 1, 1, 8), ("late", 1, 1, 9), ("older", 1, 1, 2))
    assert load(house, late) == (UNCHANGED, False)
    state = house.layout("bronze", "order_payments")
    assert load(house, late, lookback="INTERVAL '3' DAY") == (MERGED, True)
    assert rows(house.read("silver", "order_payments"), "order_id") == [("a",), ("late",), ("same",)]
    # What was stored already costs no rewrite: one row, one part.
    assert len(house.layout("bronze", "order_payments").differing(state)) == 1
    assert load(house, late, lookback="INTERVAL '3' DAY") == (UNCHANGED, False)
