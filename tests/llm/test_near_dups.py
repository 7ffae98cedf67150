import random
from collections import defaultdict

import pytest

from tidemark.llm.components import connected
import corpus_pipeline
from tidemark.llm.near_dups import drop_near_duplicates, forest, missed, near_duplicates, shingles


def word_sets(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows, percent=85):
    sets = {i: word_sets(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for i, s in sets.items():
        for j in {j for x in s for j in where[x] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets.items())


def made_rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=30)
    rows = []

    def add(words):
        rows.append((len(rows) * 3, " ".join(words)))

    for _ in range(60):
        add(rng.choices(vocabulary, k=rng.randint(1, 200)))
    for _ in range(60):
        add(passage + rng.choices(vocabulary, k=rng.randint(0, 60)))
    base = rng.choices(vocabulary, k=150)
    for _ in range(150):  # edited copies that resemble the original more than each other
        copy = list(base)
        for _ in range(rng.randint(1, 3)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        add(copy)
    add(base)
    for _ in range(30):
        add(w.upper() for w in base)
    for _ in range(5):
        chain = rng.choices(vocabulary, k=120)
        for _ in range(8):  # each resembles the one before
            add(chain)
            chain = [*chain[4:], *rng.choices(vocabulary, k=4)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = made_rows(seed)
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in out.collect()) == brute_force(rows)


def edited_pairs(seed, percents, words=300):
    """Pairs of texts, each pair with words of its own, whose sets have these similarities or a little more."""
    rng = random.Random(seed)
    rows = []
    for n, percent in enumerate(percents):
        base = [f"p{n}w{i}" for i in range(words)]
        size = words - 4
        both = -(-2 * size * percent // (100 + percent))  # shingles of each that the other has
        at = rng.randint(0, both - 4)
        copy = base[: at + 4] + [f"p{n}x{i}" for i in range(size - both - 4)] + base[at + size - both :] if size - both > 4 else base
        rows += [(2 * n, " ".join(base)), (2 * n + 1, " ".join(copy))]
    return rows


@pytest.mark.parametrize("percent", [60, 80])
def test_links_at_other_similarities(spark, percent):
    rows = edited_pairs(percent, [percent + n % 6 for n in range(400)] + [percent - 5] * 20)
    wanted = brute_force(rows, percent)
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent)
    found = sorted(tuple(r) for r in out.collect())
    assert sum(not r[3] for r in wanted) >= 390
    assert sum(a != b for a, b in zip(found, wanted)) <= 1  # of 400 links, 0.4 may be missed
    if percent == corpus_pipeline.SIMILAR:
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        kept = corpus_pipeline.near_dedup_stage(spark, docs, "").count()
        assert kept <= len(rows) - 390


def test_forests():
    assert forest(85)[:2] == (32, 4) and forest(85).lookalike == 88  # op4's
    rng = random.Random(5)
    for percent in range(10, 101):
        shape = forest(percent)
        assert missed(percent / 100, shape.trees, shape.shallow) <= 0.001
    ring = lambda: [all(rng.random() < 0.8 for _ in range(4)) for _ in range(32)]
    tries = [ring() for _ in range(20_000)]
    rate = sum(not any(a and b for a, b in zip(r, [*r[1:], r[0]])) for r in tries) / len(tries)
    assert abs(rate - missed(0.8, 32, 4)) < 0.003
    with pytest.raises(ValueError):
        forest(5)


def test_edge_rows(spark):
    rows = [(1, None, "n"), (2, "", None), (3, " \n", "n"), (5, "A b", "n"), (4, "a  B", "n"), (6, "a b c", "n"), (6, "a b c", "n"), (None, "x y", "n"), (7, "long " * 30_000, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    out = sorted((tuple(r) for r in near_duplicates(df).collect()), key=str)
    assert out == sorted(
        [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (5, 1, 4, False), (4, 1, 4, True), (6, 1, 6, True), (6, 1, 6, True), (None, 1, None, True), (7, 1, 7, True)],
        key=str,
    )
    assert sorted(str(r["doc_id"]) for r in drop_near_duplicates(df).collect()) == ["1", "2", "3", "4", "6", "6", "7", "None"]
    assert near_duplicates(df.limit(0)).count() == 0
    # Of two texts under one id only the copy goes.
    twice = spark.createDataFrame([(1, "a b c d e f"), (8, "a b c d e f"), (8, "quite another text here now")], "doc_id long, text string")
    assert sorted(tuple(r) for r in drop_near_duplicates(twice).collect()) == [(1, "a b c d e f"), (8, "quite another text here now")]


def test_stage_keeps_one_row_of_each_group(spark):
    words = " ".join(f"v{i}" for i in range(100))
    rows = [
        (6, "a b c", "n", 3), (6, "a b c", "n", 2), (6, "a b c", "m", 2), (7, "A  b c", "n", 3),  # a repeated row and a copy
        (8, words, "n", 9), (8, words + " more", "n", 9), (9, words + " less", "n", 9), (8, "quite another text here now", "n", 9),  # near-equal texts under one id
        (None, "x y", "n", 1), (None, "x y", "n", 1), (None, "X Y", "n", 1),  # without ids
        (None, "p q r", "n", 1), (11, "p q r", "n", 1),
        (12, None, "n", 1), (13, None, "n", 1), (14, " ", None, 1), (14, " ", None, 1),  # without words
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    out = corpus_pipeline.near_dedup_stage(spark, df, "")
    assert out.columns == df.columns
    found = [tuple(r) for r in out.collect()]
    assert len(found) == 8
    assert [r for r in found if r[0] == 6] == [(6, "a b c", "m", 2)]
    assert sorted(r[1] for r in found if r[0] == 8) in (["quite another text here now", words], ["quite another text here now", words + " more"])
    assert [r[1].lower() for r in found if r[0] is None] == ["x y"]
    assert {r[0] for r in found} == {6, 8, None, 11, 12, 13, 14}
    assert sorted(map(str, out.collect())) == sorted(map(str, corpus_pipeline.near_dedup_stage(spark, df.repartition(7), "").collect()))
    # Without repeated rows, ids are enough.
    plain = spark.createDataFrame([(1, "a b c d e f"), (8, "a b c d e f")], "doc_id long, text string")
    assert [tuple(r) for r in corpus_pipeline.near_dedup_stage(spark, plain, "").collect()] == [(1, "a b c d e f")]
    assert corpus_pipeline.near_dedup_stage(spark, df.limit(0), "").count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    found = {r["node"]: r["root"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}


def test_shingle_counts():
    for text in ("", "a", "a b c d", "a b c d e", "a b c d e f", "a a a a a a a", None):
        assert len(shingles(text)) == len(word_sets(text))
