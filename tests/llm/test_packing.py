import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import word_tokens
from tidemark.llm.packing import best_fit, pack_documents
from tidemark.llm.word_tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = WordEncoder(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=6), st.sampled_from([" ", "\n", "'s", "'LL", "It's", "<|endoftext|>", "<|", "É", "é", "é", "ß", "İ", "Σ", " ", " ", "x1y22", "!!'t", "ª", "µ×", "\x1c", "中文", "😀"])), max_size=12).map("".join))
def test_word_by_word_equals_the_library(text):
    text = text.encode("utf-8", "replace").decode()
    assert np.frombuffer(ENCODER.encode([text])[0], "<u4").tolist() == library_ids(text)


def test_small_store(monkeypatch):
    monkeypatch.setattr(word_tokens, "WORDS_KEPT", 5)
    texts = ["a b c d", None, "e f g h i j k a b", "The End. of it!"] * 60
    assert [np.frombuffer(i, "<u4").tolist() for i in WordEncoder(PATH).encode(texts)] == [library_ids(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit(lengths):
    bins = best_fit(lengths, 20)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    fills = sorted(sum(lengths[i] for i in b) for b in bins)
    assert all(f <= 20 for f in fills)
    assert len(fills) < 2 or fills[0] + fills[1] > 20  # no two bins could be one


@pytest.mark.parametrize("items", [20_000, 40])
def test_frame(spark, items):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["the", "cat", "Sat!", "über", "42"], k=rng.choice([0, 3, 30, 60, 90, 400]))), i) for i in range(300)]
    rows += [(1000, None, 1), (1001, "", 1), (None, "null id", 1), (7, "again", 1), (7, "again", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece int").repartition(6)
    out = pack_documents(df, PATH, size=128, items=items).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for doc_id, text, _ in rows:
        ids = np.array([*library_ids(text), 0], "<u4")
        total += len(ids)
        if doc_id != 7:
            found = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces[doc_id])
            assert found == [(n, s, len(ids[s : s + 128]), zlib.crc32(ids[s : s + 128].tobytes())) for n, s in enumerate(range(0, len(ids), 128))]
    assert len(pieces[7]) == 2 + 1 + (len(library_ids(rows[7][1])) // 128)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
    assert len(sequences) <= 1.03 * total / 128 + 1


def test_items_that_never_fit_together(spark):
    df = spark.createDataFrame([(i, "cat " * 70) for i in range(90)], "doc_id long, text string")
    for worth in (0.5, 1.0):
        out = pack_documents(df, PATH, size=128, items=10, worth=worth)
        assert out.select("sequence_id").distinct().count() == 90
    assert pack_documents(df.limit(0), PATH).count() == 0


def test_long_words_are_not_kept():
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from tidemark.llm import word_tokens

    path = public_tokenizers.path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), word_tokens.WordEncoder(path)
    texts = [f"{n} " + "".join(chr(97 + (n * i * i + i) % 26) for i in range(3000)) + ", end. é" + "ü" * 99 for n in range(20)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert encoder.words and all(len(word) <= word_tokens.LONG for word in encoder.words)
    assert all(len(part) <= word_tokens.LONG for part in encoder.parts)


def test_plain_words_need_no_patterns(monkeypatch):
    monkeypatch.setattr(word_tokens, "_COMMON", None)
    monkeypatch.setattr(word_tokens, "_PART", None)
    texts = ["Plain WORDS in\nlines", "and more words " + "x" * 300]
    assert [np.frombuffer(i, "<u4").tolist() for i in WordEncoder(PATH).encode(texts)] == [library_ids(t) for t in texts]
