"""MERGE semantics against a brute-force model."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.helpers import plan_of, rows
from tidemark.operators.upsert import SchemaMismatch, has_effect, upsert

SCHEMA = "k int, j int, v string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def model(target, source, null_safe):
    def same(a, b):
        if a is None or b is None:
            return null_safe and a is b
        return a == b

    def match(t, s):
        return same(t[0], s[0]) and same(t[1], s[1])

    out = []
    for t in target:
        found = [s for s in source if match(t, s)]
        if len(found) > 1:
            return None
        out.append(found[0] if found else t)
    out += [s for s in source if not any(match(t, s) for t in target)]
    return sorted(out, key=repr)


def test_plain_equality(spark):
    target = frame(spark, [(1, 1, "a"), (2, 1, "b"), (None, 1, "n")])
    source = frame(spark, [(2, 1, "B"), (3, 1, "c"), (None, 1, "m"), (None, 1, "m")])
    assert rows(upsert(target, source, ["k", "j"])) == sorted(
        [(1, 1, "a"), (2, 1, "B"), (3, 1, "c"), (None, 1, "n"), (None, 1, "m"), (None, 1, "m")],
        key=repr,
    )


def test_null_safe(spark):
    target = frame(spark, [(1, None, "a"), (None, None, "n")])
    source = frame(spark, [(None, None, "m"), (1, None, "A"), (1, 2, "x")])
    assert rows(upsert(target, source, ["k", "j"], null_safe=True)) == sorted(
        [(1, None, "A"), (None, None, "m"), (1, 2, "x")], key=repr
    )


def test_updates_can_set_null(spark):
    target, source = frame(spark, [(1, 1, "a")]), frame(spark, [(1, 1, None)])
    for unique in (True, False):
        assert rows(upsert(target, source, ["k", "j"], source_is_unique=unique)) == [(1, 1, None)]


def test_one_source_row_updates_many_targets(spark):
    target = frame(spark, [(1, 1, "a"), (1, 1, "b"), (2, 2, "c")])
    source = frame(spark, [(1, 1, "z")])
    assert rows(upsert(target, source, ["k", "j"])) == [(1, 1, "z"), (1, 1, "z"), (2, 2, "c")]


def test_ambiguous_match_raises(spark):
    target = frame(spark, [(1, 1, "a")])
    source = frame(spark, [(1, 1, "x"), (1, 1, "y")])
    with pytest.raises(Exception, match="several source rows"):
        upsert(target, source, ["k", "j"]).collect()


def test_repeated_source_key_without_match_is_inserted(spark):
    target = frame(spark, [(9, 9, "a")])
    source = frame(spark, [(1, 1, "x"), (1, 1, "y")])
    assert upsert(target, source, ["k", "j"]).count() == 3


def test_columns_are_matched_by_name(spark):
    target = frame(spark, [(1, 1, "a")])
    shuffled = frame(spark, [(1, 1, "b")]).select("v", "j", "k")
    assert rows(upsert(target, shuffled, ["k", "j"])) == [(1, 1, "b")]
    with pytest.raises(SchemaMismatch):
        upsert(target, shuffled.drop("v"), ["k", "j"])
    with pytest.raises(SchemaMismatch):
        upsert(target, shuffled.selectExpr("*", "1 AS extra"), ["k", "j"])


def test_has_effect(spark):
    target = frame(spark, [(1, 1, "a"), (2, 1, "b"), (None, 1, "n")])
    assert not has_effect(target, frame(spark, [(1, 1, "a"), (2, 1, "b")]), ["k", "j"])
    assert not has_effect(target, frame(spark, []), ["k", "j"])
    assert has_effect(target, frame(spark, [(1, 1, "A")]), ["k", "j"])
    assert has_effect(target, frame(spark, [(3, 1, "a")]), ["k", "j"])
    # Identical rows, but ambiguous: the merge has to run and raise.
    assert has_effect(target, frame(spark, [(1, 1, "a"), (1, 1, "a")]), ["k", "j"])
    null_key = frame(spark, [(None, 1, "n")])
    assert has_effect(target, null_key, ["k", "j"])
    assert not has_effect(target, null_key, ["k", "j"], null_safe=True)


def test_has_effect_counts_every_row_of_a_key(spark):
    target = frame(spark, [(1, 1, "a"), (1, 1, "b"), (2, 1, "c")])
    assert has_effect(target, frame(spark, [(1, 1, "a")]), ["k", "j"])
    assert not has_effect(target, frame(spark, [(2, 1, "c")]), ["k", "j"])
    twice = frame(spark, [(2, 1, "c"), (2, 1, "c")])
    assert has_effect(target, twice, ["k", "j"])  # the merge must raise
    assert has_effect(target, frame(spark, [(9, 9, "x"), (9, 9, "x")]), ["k", "j"])  # inserts


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    target=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 1), st.sampled_from("ab")), max_size=6),
    source=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 1), st.sampled_from("ab")), max_size=4),
)
def test_has_effect_equals_the_model(spark, target, source):
    merged = model(target, source, False)
    expected = merged is None or sorted(merged) != sorted(target)
    assert has_effect(frame(spark, target), frame(spark, source), ["k", "j"]) == expected


def test_empty_sides(spark):
    some, none = frame(spark, [(1, 1, "a")]), frame(spark, [])
    assert rows(upsert(some, none, ["k", "j"])) == [(1, 1, "a")]
    assert rows(upsert(none, some, ["k", "j"])) == [(1, 1, "a")]


key = st.one_of(st.none(), st.integers(0, 2))
table = st.lists(st.tuples(key, key, st.sampled_from("abc")), max_size=8)


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(target=table, source=table, null_safe=st.booleans())
def test_matches_the_model(spark, target, source, null_safe):
    expected = model(target, source, null_safe)
    result = upsert(frame(spark, target), frame(spark, source), ["k", "j"], null_safe=null_safe)
    if expected is None:
        with pytest.raises(Exception, match="several source rows"):
            result.collect()
    else:
        assert rows(result) == expected


def test_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    spark.range(1000).selectExpr("id AS k", "id AS j", "'a' AS v").write.parquet(f"{tmp_path}/t")
    spark.range(5).selectExpr("id AS k", "id AS j", "'b' AS v").write.parquet(f"{tmp_path}/s")
    target, source = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")
    merged = upsert(target, source, ["k", "j"], source_is_unique=True)
    plan = plan_of(merged)
    outer = plan[plan.index("LeftOuter") :]
    first_scan = outer[: outer.index("FileScan")]
    assert "BroadcastHashJoin" in plan
    assert "Exchange" not in first_scan
    assert merged.count() == 1000
