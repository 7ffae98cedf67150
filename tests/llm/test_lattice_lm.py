import itertools
import math
import zlib
from collections import Counter

import public_tokenizers
import pytest

from tidemark.llm.lattice_lm import START, Lattice, score_documents

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(lattice, text):
    total = 0.0
    for cuts in itertools.product((0, 1), repeat=len(text) - 1):
        parts, start = [], 0
        for at, cut in enumerate([*cuts, 1], 1):
            if cut:
                parts.append(text[start:at])
                start = at
        chance = 1.0
        for part in parts:
            if part in lattice.pieces:
                chance *= math.exp(lattice.pieces[part])
            elif len(part) == 1:
                chance *= math.exp(sum(lattice.byte_pieces[b] for b in part.encode()))
            else:
                chance = 0.0
        total += chance
    return total


def test_forward_sums_all_segmentations():
    pieces = {p: math.log(w) for p, w in {START: 0.1, START + "a": 0.2, "a": 0.1, "ab": 0.05, "b": 0.1, "aba": 0.02}.items()}
    lattice = Lattice(pieces, [math.log(0.0001)] * 256, math.log(0.1))
    for word in ("", "a", "abab", "é", "abéaba"):
        assert math.exp(lattice.word(word)) == pytest.approx(all_segmentations(lattice, START + word))


ROWS = [(i, t, 1.0) for i, t in enumerate(["The cat sat.", "the CAT ran", None, "", "a b Éa éa x\ty", "the " * 300, "zzz " + "q" * 3000] * 4)]
ROWS += [(None, "the end", None), (3, "", 1.0), (3, "", 1.0)]


@pytest.mark.parametrize("share", [1 / 20_000, 1 / 10])
def test_frame_equals_brute_force(spark, share, monkeypatch):
    monkeypatch.setattr("tidemark.llm.lattice_lm.FREQUENT_SHARE", share)
    df = spark.createDataFrame(ROWS, "doc_id long, text string, score double")
    out = score_documents(df, VOCABULARY).collect()
    assert len(out) == len(ROWS)
    tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t, _ in ROWS]
    train = Counter(w for i, ws in tokens if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2 for w in ws)
    n, v = sum(train.values()), len(train)
    expected = sorted(
        (-1 if i is None else i, len(ws), sum(train[w] > 0 for w in ws), round(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in ws), 6))
        for i, ws in tokens
    )
    found = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in out)
    assert found == expected
    assert {r["train_tokens"] for r in out} == {n}
    assert {r["doc_id"] for r in out if r["held_out"]} == {i for i, _ in tokens if i is not None and zlib.crc32(str(i).encode()) % 7 == 2}
    texts = {i: t or "" for i, t, _ in ROWS}
    scores: dict[str, set] = {}
    for r in out:
        scores.setdefault(texts[r["doc_id"]], set()).add(round(r["score"], 6))
    assert all(len(s) == 1 for s in scores.values())  # equal texts, equal scores


def test_scores_are_the_sum_over_words(spark):
    df = spark.createDataFrame([(0, ""), (1, "ab cd"), (3, "ab"), (4, "cd"), (5, "ab ab cd")], "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in score_documents(df, VOCABULARY).collect()}
    ab, cd = score[3] - score[0], score[4] - score[0]
    assert score[1] - score[0] == pytest.approx(ab + cd)
    assert score[5] - score[0] == pytest.approx(2 * ab + cd)
    assert ab < 0 and cd < 0


def test_empty_table(spark):
    assert score_documents(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY).count() == 0
