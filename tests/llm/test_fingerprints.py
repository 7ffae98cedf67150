import hashlib
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from tidemark.llm.fingerprints import differences, edited, fingerprint_edits, fingerprint_texts, likeness, passages, subtract_fingerprints, text_differences


def exact(a, b):
    a, b = set(passages(a).tolist()), set(passages(b).tolist())
    return len(a & b) / len(a | b) if a | b else 1.0


def test_likeness_equals_sets():
    rng = np.random.default_rng(1)
    left = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (0, 1, 5, 40, 300, 5000)]
    right = [a[: len(a) // 3] for a in left]
    right[4] = rng.integers(0, 2**63, 7).astype(np.uint64)
    expected = [len(set(a) & set(b)) / len(set(a) | set(b)) if len(a) else 1.0 for a, b in zip(left, right)]
    assert likeness(left, right) == pytest.approx(expected)


def test_differences_are_the_digests():
    rng = np.random.default_rng(2)
    sets = [(rng.integers(0, 2**64, a, np.uint64), rng.integers(0, 2**64, b, np.uint64), rng.integers(0, 2**64, c, np.uint64)) for a, b, c in [(0, 0, 0), (9, 0, 0), (5, 1, 0), (50, 3, 4), (500, 0, 9), (3000, 800, 1), (0, 70, 90)]]
    left, right = [np.concatenate([a, b]) for a, b, _ in sets], [np.concatenate([a, c]) for a, _, c in sets]
    pair, keys, sign = differences(left, right)
    for i, (_, gone, new) in enumerate(sets):
        assert set(keys[(pair == i) & (sign > 0)].tolist()) == set(gone.tolist())
        assert set(keys[(pair == i) & (sign < 0)].tolist()) == set(new.tolist())


def test_stored_fingerprints_subtract(spark):
    """Fingerprints alone tell what changed, up to their size; whole texts tell everything."""
    rng = random.Random(5)
    line = lambda: " ".join(rng.choices("abcdefgh", k=6)) + "."
    rows = [(0, None, "a b."), (1, "", ""), (2, "x.", None), (3, "same.", "same.")]
    for n in range(4, 60):
        shared = [line() for _ in range(40)]
        rows.append((n, "\n".join([*shared, *(line() for _ in range(n // 8))]), "\n".join([*(line() for _ in range(n % 5)), *shared])))
    for n in range(60, 64):
        rows.append((n, "\n".join(line() for _ in range(400)), "\n".join(line() for _ in range(300))))
    df = spark.createDataFrame(rows, "id long, old string, new string")
    marked = fingerprint_texts(df, "old").withColumnRenamed("fingerprint", "was")
    marked = fingerprint_texts(marked, "new").withColumnRenamed("fingerprint", "is").drop("old", "new")
    wanted = {}
    for n, old, new in rows:
        a, b = set(passages(old or "").view(np.int64).tolist()), set(passages(new or "").view(np.int64).tolist())
        wanted[n] = (sorted(a - b), sorted(b - a))
    stored = subtract_fingerprints(marked, "was", "is").collect()
    assert all((r["removed"], r["added"]) == (wanted[r["id"]] if r["whole"] else (None, None)) for r in stored)
    assert all(r["whole"] for r in stored if sum(map(len, wanted[r["id"]])) <= 6)
    assert not any(r["whole"] for r in stored if r["id"] >= 60)
    whole = text_differences(df, "old", "new").collect()
    assert all(r["whole"] and (r["removed"], r["added"]) == wanted[r["id"]] for r in whole)
    odd = marked.limit(2).select("id", F.when(F.col("id") == 0, F.col("was")).alias("was"), F.lit("AAAA").alias("is"))
    assert [(r["removed"], r["added"], r["whole"]) for r in subtract_fingerprints(odd, "was", "is").collect()] == [(None, None, False)] * 2
    assert subtract_fingerprints(marked.limit(0), "was", "is").count() == text_differences(df.limit(0), "old", "new").count() == 0


def test_edit():
    assert edited("abcde", "XYZ") == "abcXY"
    assert edited("abcdef", "X") == "abcX"
    assert edited("", "X") == ""


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_frame_equals_brute_force(spark, parts):
    rng = random.Random(3)
    words = ["one", "two", "three", "é", "four.", "five\n", "six!"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60))), 0.5) for i in rng.sample(range(1000), 60)]
    rows += [(2000, None, 0.5), (2001, "", None), (2002, "w " * 100_000, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, near_next double").repartition(parts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        out = {r["doc_id"]: r for r in fingerprint_edits(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    texts = {i: t or "" for i, t, _ in rows}
    order = sorted(texts, reverse=True)
    assert set(out) == set(texts)
    for i, following in zip(order, [*order[1:], order[0]]):
        changed = edited(texts[i], texts[following])
        row = out[i]
        assert row["n_chars"] == len(texts[i])
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert row["near_edited"] == pytest.approx(exact(texts[i], changed))
        assert row["near_next"] == pytest.approx(exact(texts[i], texts[following]))
        assert (row["fingerprint"] == row["edited_fingerprint"]) == (set(passages(texts[i])) == set(passages(changed)))
    by_text = {r["doc_id"]: r["fingerprint"] for r in fingerprint_texts(df).collect()}
    assert by_text == {i: out[i]["fingerprint"] for i in out}


def test_edge_frames(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (None, None)], "doc_id long, text string")
    assert fingerprint_edits(df).count() == 4
    assert fingerprint_edits(df.limit(0)).count() == 0
    alone = fingerprint_edits(df.where("text = 'c'")).collect()
    assert alone[0]["near_next"] == 1.0
