from collections import Counter

import corpus_pipeline
from tidemark.llm.secret_scan import MASK

DATA = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    clean = docs.where("lang = 'en' AND length(text) > 1000").orderBy("doc_id").limit(1)
    planted = clean.selectExpr("9999L AS doc_id", "reverse(text) || ' token = abcdef123456' AS text", "lang", "source")
    docs = docs.unionByName(planted.selectExpr("*", "CAST(length(text) AS BIGINT) AS n_chars"))
    start = docs.count()
    columns = docs.columns
    counts = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts[name] = docs.count()
        if name != "packing":
            assert docs.columns == columns
            texts = docs
    assert start > counts["quality_rules"] >= counts["near_dedup"] == counts["secret_scan"] > start // 2
    assert texts.where(f"contains(text, '{MASK}')").count() > 0
    assert texts.where("length(text) <> n_chars").count() == 0
    assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} == {r["doc_id"] for r in texts.collect()}
    ran = corpus_pipeline.run(spark, DATA)
    key = lambda rows: Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert key(ran.collect()) == key(docs.where("doc_id <> 9999").collect())


def test_empty_null_and_clashing_tables(spark, tmp_path):
    """Every stage, and all of them in a row, on no rows, on nulls everywhere and with columns more."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    nulls = spark.createDataFrame([(None,) * 5, (1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0)], docs.schema)
    more = ("'x' AS kept", "1 AS component_id", "'y' AS spans", "2 AS n_words", "0 AS sequence_id", "'z' AS `row`")
    table = docs.orderBy("doc_id").limit(40).selectExpr("*", *more).unionByName(nulls.selectExpr("*", *more)).coalesce(1)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, table, DATA)
        assert out.count() > 0
        assert name == "packing" or out.columns == table.columns
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    ran = corpus_pipeline.run(spark, str(tmp_path))
    assert ran.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert ran.count() == 0
