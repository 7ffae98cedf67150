"""JDBC read options. No database is started: only what is asked of it is checked."""

import duckdb
import pytest

from tidemark.operators.watermark import Watermark
from tidemark.sources import FrameSource, JdbcHexSplit, JdbcQuantileSplit, JdbcSource, JdbcSplit
from tidemark.sources.jdbc import delta_query, identifier
from tidemark.specs import TABLES

MARK = Watermark("updated_at", "timestamp_ntz", "2020-01-01 00:00:00.5")


class FakeReader:
    def __init__(self):
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen |= options
        return self

    def load(self):
        return self.seen

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "table": table, "predicates": predicates, "properties": properties}


class FakeSession:
    @property
    def read(self):
        return FakeReader()


def source(**settings):
    options = {"driver": "org.postgresql.Driver", "user": "u", "password": "p"}
    return JdbcSource(FakeSession(), "jdbc:postgresql://h:1/d?sslmode=require", options, **settings)


def test_whole_table():
    seen = source().read(TABLES["orders"])
    assert seen["format"] == "jdbc"
    assert seen["dbtable"] == '"public"."orders"'
    assert seen["driver"] == "org.postgresql.Driver"
    assert seen["fetchsize"] == "10000"
    assert seen["preferTimestampNTZ"] == "true"
    assert "numPartitions" not in seen


def test_parallel_read():
    split = JdbcSplit("updated_at", "2016-01-01", "2020-01-01", 64)
    seen = source(splits={"orders": split}).read(TABLES["orders"])
    assert seen["partitionColumn"] == "updated_at"
    assert (seen["lowerBound"], seen["upperBound"]) == ("2016-01-01", "2020-01-01")
    assert seen["numPartitions"] == "64"


def test_parallel_slice_starts_at_the_mark():
    split = JdbcSplit("updated_at", "2016-01-01", "2020-06-01", 64)
    seen = source(splits={"orders": split}).read_since(TABLES["orders"], MARK)
    assert (seen["lowerBound"], seen["upperBound"]) == (MARK.text, "2020-06-01")
    other = JdbcSplit("id", "1", "9", 8)
    assert source(splits={"orders": other}).read_since(TABLES["orders"], MARK)["lowerBound"] == "1"


def test_slice_bounds_follow_the_mark():
    for upper, expected in (("2020-06-01", "2020-06-01"), (MARK.text, MARK.text), ("2018-01-01", MARK.text)):
        split = JdbcSplit("updated_at", "2016-01-01", upper, 64).above(MARK)
        assert (split.lower, split.upper) == (MARK.text, expected)
    number = JdbcSplit("id", "1", "900", 8).above(Watermark("id", "bigint", "1000"))
    assert (number.lower, number.upper) == ("1000", "1000")
    assert JdbcSplit("id", "1", "900", 8).above(Watermark("id", "bigint", "20")).upper == "900"


def test_hex_keys_are_read_by_prefix(spark):
    split = JdbcHexSplit("order_id", digits=1)
    seen = source(splits={"orders": split}).read_since(TABLES["orders"], MARK)
    assert len(seen["predicates"]) == 16
    assert seen["predicates"][0] == """("order_id" < '1' OR "order_id" IS NULL)"""
    assert "dbtable" not in seen["properties"] and seen["properties"]["fetchsize"] == "10000"
    keys = [None, "", "0a", "1", "ff", "zz", *[f"{i * 37 % 256:02x}" for i in range(99)]]
    df = spark.createDataFrame([(k,) for k in keys], "order_id string")
    found = [df.filter(p).count() for p in JdbcHexSplit("order_id", 2).predicates("order_id")]
    assert len(found) == 256 and sum(found) == len(keys)


def test_identifiers_are_quoted():
    assert identifier('a"b') == '"a""b"'
    assert delta_query("s", "t", MARK, quote="`").startswith("(SELECT * FROM `s`.`t` WHERE `updated_at` >= ")


def test_delta_is_selected_by_the_database():
    query = delta_query("public", "orders", MARK)
    assert query == (
        '(SELECT * FROM "public"."orders" WHERE "updated_at" >= '
        "TIMESTAMP '2020-01-01 00:00:00.5') AS changed_rows"
    )
    assert source().read_since(TABLES["orders"], MARK)["dbtable"] == query


def test_no_mark_reads_the_whole_table():
    assert source().read_since(TABLES["orders"], None)["dbtable"] == '"public"."orders"'


def test_frame_source(spark):
    df = spark.range(5).withColumnRenamed("id", "updated_at")
    frames = FrameSource({"orders": df})
    assert frames.read(TABLES["orders"]).count() == 5
    assert frames.read_since(TABLES["orders"], Watermark("updated_at", "bigint", "3")).count() == 2


TEXTS = ["", "a", "A", "b", "B", "it's", "é", "z", "Z", "10", "9", None]
KEYS = {
    "VARCHAR": TEXTS,
    "VARCHAR COLLATE NOCASE": TEXTS,
    "BIGINT": [*range(-5, 40), 7, 7, 7, None],
    "DECIMAL(10,2)": ["1.10", "-2.00", "3.33", None, "0.00"],
    "TIMESTAMP": [f"2020-01-{d:02d} 00:00:00.{d:03d}" for d in range(1, 20)] + [None],
    "DATE": [f"2020-01-{d:02d}" for d in range(1, 9)],
    "INTEGER": [None, None],
    "SMALLINT": [],
}


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_quantile_ranges_hold_every_row_once(spark, kind, partitions):
    """The query and the ranges as a database answers them: an engine within this process."""
    values = KEYS[kind]
    database = duckdb.connect()
    database.execute(f'CREATE TABLE "a table" ("the key" {kind})')
    for value in values:
        database.execute('INSERT INTO "a table" VALUES (?)', [value])
    split = JdbcQuantileSplit("the key", partitions)
    column = identifier("the key")
    answer = database.execute(f"SELECT stretch, cut FROM {split.cuts_query(identifier('a table'), column)}").fetchall()
    dtype = {"VARCHAR": "string", "VARCHAR COLLATE NOCASE": "string", "TIMESTAMP": "timestamp_ntz", "INTEGER": "int",
             "SMALLINT": "smallint"}.get(kind, kind.lower())
    cuts = split.cuts(spark.createDataFrame(answer, f"stretch long, cut {dtype}"))
    assert len(cuts) <= partitions
    predicates = split.predicates(column, cuts)
    assert len(predicates) <= max(1, partitions)
    counts = [database.execute(f'SELECT count(*) FROM "a table" WHERE {p}').fetchone()[0] for p in predicates]
    matched = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in predicates)
    assert database.execute(f'SELECT count(*) FROM "a table" WHERE {matched} <> 1').fetchone()[0] == 0
    assert sum(counts) == len(values)
    if kind == "TIMESTAMP" and partitions == 3:
        assert max(counts) <= 8  # 19 values and a NULL in three ranges
