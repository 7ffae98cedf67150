"""Leases and what is cleaned up beside readers, dead runs and live ones."""

import uuid

import pytest

from tests.helpers import rows
from tidemark import shared
from tidemark.plans.pipeline import run_pipeline
from tidemark.plans.together import StepsFailed
from tidemark.retention import DAY, Lease, clean_up, clean_up_folders, kept_since
from tidemark.warehouse import Warehouse

START = 1_700_000_000


@pytest.fixture
def clock(spark, tmp_path, monkeypatch):
    """A clock to be set by hand, and a shared folder without other tests' leases."""
    at = {"now": START}
    monkeypatch.setattr(shared, "now", lambda: at["now"])
    monkeypatch.setattr(shared, "shared_folder", lambda spark: str(tmp_path / "shared"))
    return at


@pytest.fixture
def house(spark, tmp_path, clock):
    return Warehouse(spark, root=str(tmp_path), namespace=f"r{uuid.uuid4().hex[:8]}_", parts=3)


def publish(house, n, part_by=()):
    house.overwrite("silver", "t", house.spark.range(n), part_by=part_by)
    return house.snapshot("silver", "t")


def names(dropped):
    return [name.split(".")[-1] for name in dropped]


@pytest.mark.parametrize("part_by", [(), ("id",)])
def test_a_reader_keeps_what_it_reads(spark, house, clock, part_by):
    first = publish(house, 5, part_by)
    clock["now"] += 10 * DAY
    with Lease(spark, seconds=9 * DAY):
        seen = house.read("silver", "t")
        clock["now"] += 1
        second = publish(house, 6, part_by)
        clock["now"] += 1
        third = publish(house, 7, part_by)
        clock["now"] += 5 * DAY
        assert clean_up(house) == []
        assert seen.count() == 5
    assert set(names(clean_up(house))) == {first, second}
    assert house.runs_shown("silver", "t") == {third}
    assert house.read("silver", "t").count() == 7


def test_what_was_replaced_before_the_lease_goes(spark, house, clock):
    first = publish(house, 5)
    clock["now"] += 1
    publish(house, 6)
    clock["now"] += 2 * DAY
    with Lease(spark):
        assert names(clean_up(house)) == [first]


def test_age_counts_from_the_replacement(spark, house, clock):
    """A table published for a month may have been opened just before it was replaced."""
    publish(house, 5)
    clock["now"] += 30 * DAY
    publish(house, 6)
    clock["now"] += DAY
    assert clean_up(house, keep=DAY) == []
    clock["now"] += 1
    assert len(clean_up(house, keep=DAY)) == 1


def lose(house, monkeypatch, **settings):
    """A write whose driver is lost before it publishes."""

    def lost(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(Warehouse, "_show", lost)
        with pytest.raises(OSError):
            house.overwrite("silver", settings.get("table", "t"), house.spark.range(3), part_by=("id",))


def test_dead_and_live_runs(spark, house, clock, monkeypatch):
    publish(house, 5, ("id",))
    lose(house, monkeypatch)
    lose(house, monkeypatch, table="never_published")
    dead = Lease(spark, seconds=3600)  # its driver is gone, nobody releases it
    clock["now"] += 2 * DAY
    with Lease(spark, seconds=5 * DAY):
        lose(house, monkeypatch)  # begun by the live run, not yet published
        live = max(house.run_tables("silver", "t"))
        clock["now"] += 2 * DAY
        dropped = names(clean_up(house))
        assert len(dropped) == 2 and live not in dropped
        assert any(name.startswith("never_published__") for name in dropped)
        assert house.exists("silver", live)
    assert rows(house.read("silver", "t")) == [(n,) for n in range(5)]
    assert names(clean_up(house)) == [live]
    dead.release()


def test_merges_keep_the_runs_of_untouched_parts(spark, house, clock):
    house.overwrite("silver", "t", spark.range(50), part_by=("id",))
    for n in (100, 101, 102, 103):
        clock["now"] += DAY
        house.merge("silver", "t", spark.range(n, n + 1), ["id"], source_is_unique=True)
    clock["now"] += 3 * DAY
    clean_up(house)
    assert set(house.run_tables("silver", "t")) == house.runs_shown("silver", "t")
    assert rows(house.read("silver", "t")) == sorted(((n,) for n in [*range(50), 100, 101, 102, 103]), key=repr)
    # Records of dropped runs go with the next swap.
    house.merge("silver", "t", spark.range(1), ["id"], source_is_unique=True)
    tables = set(house.run_tables("silver", "t"))
    assert set(house.retired("silver", "t")) <= tables


def test_leases_are_renewed_released_and_run_out(spark, clock):
    lease = Lease(spark, seconds=100)
    clock["now"] += 90
    lease.renew()
    clock["now"] += 90
    assert kept_since(spark, keep=0) == START
    assert len(shared.names_in(spark, f"{shared.shared_folder(spark)}/leases")) == 1
    clock["now"] += 11
    assert kept_since(spark, keep=5) == clock["now"] - 5
    lease.renew()
    assert kept_since(spark, keep=0) == START
    lease.release()
    lease.release()
    assert kept_since(spark, keep=0) == clock["now"]


def test_staged_folders(spark, clock):
    root = shared.shared_folder(spark)
    old = shared.new_folder(spark, "staged")
    other = shared.new_folder(spark, "tokens")
    clock["now"] += DAY
    with Lease(spark, seconds=10 * DAY):
        used = shared.new_folder(spark, "staged")
        for folder in (old, other, used):
            spark.range(3).write.parquet(folder)
        clock["now"] += 3 * DAY
        assert clean_up_folders(spark) == [old.rsplit("/", 1)[1]]
        assert spark.read.parquet(used).count() == 3
    assert clean_up_folders(spark) == [used.rsplit("/", 1)[1]]
    left = [name for name in shared.names_in(spark, root) if name != "leases"]
    assert left == [other.rsplit("/", 1)[1]]


def test_users_tables_stay(spark, house, clock):
    publish(house, 2)
    for name in ("t__other", "t__0123456789ab"):
        spark.range(1).write.saveAsTable(house.name("silver", name))
    clock["now"] += 9 * DAY
    assert clean_up(house) == []


def test_the_pipeline_holds_a_lease_and_lets_it_go(spark, house, clock):
    held = []

    class Failing:
        def read(self, spec):
            held.append(kept_since(spark, keep=0))
            raise OSError("no source")

    clock["now"] += 5
    with pytest.raises(StepsFailed):
        run_pipeline(house, Failing())
    assert held and set(held) == {START + 5}
    assert shared.names_in(spark, f"{shared.shared_folder(spark)}/leases") == []
