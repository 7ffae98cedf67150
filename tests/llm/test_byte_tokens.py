import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import byte_tokens
from tidemark.llm.byte_tokens import ChunkEncoder, decode_documents, encode_documents, token_digests

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PIECES = [
    " ", "  ", "\n", "\n\n ", "\t", "the", " cat", "It's", "'ll", "é", "́", " ", " ", "\x1c", "!!", "42", "<|endoftext|>", "<|",
    "中文", "😀", "x" * 40, " word and more words. " * 5, "\r\n",
]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=5)), max_size=40).map("".join), st.sampled_from([1, 7, 0x1FF]))
def test_equals_the_library(text, mask):
    text = text.encode("utf-8", "replace").decode()
    before = byte_tokens.MASK
    byte_tokens.MASK = mask
    try:
        encoder = ENCODER
        encoder.chunks.clear()
        ids = encoder.encode(text)
    finally:
        byte_tokens.MASK = before
    expected = LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == expected
    assert encoder.decode(ids) == LIBRARY.decode(expected, skip_special_tokens=False)


ENCODER = ChunkEncoder(PATH)


def test_shared_passages_share_chunks():
    rng = np.random.default_rng(2)
    passage = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"], 2000))
    cuts = byte_tokens.cut_points(passage.encode())
    moved = byte_tokens.cut_points(("something else before " + passage).encode())
    assert len(cuts) > 5
    assert set(np.array(cuts[1:]) + 22) <= set(moved)


def test_decodes_broken_utf8_as_the_library():
    for ids in ([255, 220], [144, 112], [50256, 64, 50256], list(range(1000, 1200)), list(range(188, 256))):
        raw = np.array(ids, "<u4").tobytes()
        assert ENCODER.decode(raw) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_small_store(monkeypatch):
    monkeypatch.setattr(byte_tokens, "UNITS_KEPT", 3)
    monkeypatch.setattr(byte_tokens, "CHUNK_BYTES_KEPT", 10)
    encoder = ChunkEncoder(PATH)
    for text in ("a b c d e f g. " * 300, "h i j"):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_frame(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "Some text.\nAnd more of it", None), (3, "Some text.\nAnd more of it", None), (4, "long words " * 50_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    out = token_digests(df, PATH).collect()
    assert len(out) == 5
    for r in out:
        ids = LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert token_digests(df.limit(0), PATH).count() == 0
    back = decode_documents(encode_documents(df, PATH), PATH).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)


def test_long_units_are_not_kept():
    encoder = ChunkEncoder(PATH)
    texts = [f"{n} " + "".join(chr(97 + (n * i * i + i) % 26) for i in range(3000)) + " end." for n in range(20)]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert all(len(unit) <= byte_tokens.LONG for unit in encoder.units)


def test_new_units_of_a_text_are_encoded_together():
    class Counted:
        calls = 0

        def encode_batch_fast(self, texts, **options):
            self.calls += bool(texts)
            return LIBRARY.encode_batch_fast(texts, **options)

    encoder = ChunkEncoder(PATH)
    encoder.library = Counted()
    text = " ".join(f"{chr(97 + n % 26)}{chr(97 + n // 26)}x, (no{n}) été{n}!" for n in range(600))
    assert len(byte_tokens.cut_points(text.encode())) > 10
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert encoder.library.calls <= 2  # those between firm boundaries, all others
