import base64
import hashlib
import time
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import rank_queue
from tidemark.llm.rank_queue import RankEncoder, RankQueue, decode_documents, encode_documents, token_digests

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = RankEncoder(PATH, PATTERN)
PIECES = [
    " ", "  ", "\n", "\n\n ", "\t", "the", " cat", "It's", "'ll", "é", "́", " ", " ", "\x1c", "\x85", "!!", "42", "<|endoftext|>",
    "中文", "日本語の", "😀", "x" * 40, "Привет", " word and more words. " * 5, "\r\n", "0" * 30, "ab" * 20,
]


def ids(raw: bytes) -> list[int]:
    return np.frombuffer(raw, "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=6)), max_size=40).map("".join), st.sampled_from([1, 9, 1_000_000]))
def test_equals_the_library(text, block):
    text = text.encode("utf-8", "replace").decode()
    before, rank_queue.BLOCK = rank_queue.BLOCK, block
    try:
        (raw,) = ENCODER.encode([text])
    finally:
        rank_queue.BLOCK = before
    assert ids(raw) == LIBRARY.encode_ordinary(text)
    assert ENCODER.decode(raw) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 9000), st.integers(0, 50)), max_size=60))
def test_queue_gives_lowest_rank_then_leftmost(steps):
    queue, held = RankQueue(9001), []

    def take():
        rank = queue.lowest()
        position = heappop(queue.buckets[rank])
        if not queue.buckets[rank]:
            queue.drop(rank)
        return rank, position

    for add, rank, position in steps:
        if add or not held:
            if queue.buckets[rank] is None:
                queue.fill(rank, [position])
            else:
                heappush(queue.buckets[rank], position)
            held.append((rank, position))
        else:
            assert take() == min(held)
            held.remove(min(held))
    while held:
        assert take() == min(held)
        held.remove(min(held))
    assert queue.root == 0 and not any(queue.leaf) and not any(queue.middle)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.binary(min_size=2, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), st.none(), max_size=25), st.data())
def test_any_ranks(tmp_path_factory, words, data):
    """Also vocabularies in which a merge makes a pair of a lower rank than its own."""
    ranks = {bytes([97 + i]): i for i in range(3)} | {w: i + 3 for i, w in enumerate(words)}
    path = tmp_path_factory.mktemp("ranks") / "small.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(w) + b" %d" % r for w, r in ranks.items()))
    encoder = RankEncoder(str(path), "(?s).+")
    for _ in range(5):
        text = data.draw(st.text("abc", min_size=1, max_size=30)).encode()
        parts = [text] if text in ranks else [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, at = min((ranks.get(parts[i] + parts[i + 1], 10**9), i) for i in range(len(parts) - 1))
            if rank == 10**9:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        assert encoder.merge([text])[0] == [ranks[p] for p in parts]


@pytest.mark.parametrize("unit", ["a", "ab", "é", "0", "=", "中", "abcdefghijklmnopqrstuvwxyz"])
def test_very_long_pre_tokens(unit):
    text = unit * (100_000 // len(unit))
    assert ids(next(ENCODER.encode([text]))) == LIBRARY.encode_ordinary(text)


def test_long_pre_tokens_take_time_in_proportion():
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("abcdefgh"), 400_000))
    start = time.perf_counter()
    ENCODER.merge([text[:50_000].encode()])
    short = time.perf_counter() - start
    ENCODER.merge([text.encode()])
    assert time.perf_counter() - start - short < 40 * short


def test_small_store(monkeypatch):
    monkeypatch.setattr(rank_queue, "KEPT", 3)
    monkeypatch.setattr(rank_queue, "LONG", 4)
    encoder = RankEncoder(PATH, PATTERN)
    texts = ["a b c d e f g. longest " * 300, "h i j", None, "", "a b"]
    for block in (1_000_000, 8):
        monkeypatch.setattr(rank_queue, "BLOCK", block)
        assert [ids(raw) for raw in encoder.encode(texts)] == [LIBRARY.encode_ordinary(t or "") for t in texts]
    assert all(len(key) <= 4 for key in encoder.kept)


def test_frame(spark):
    rows = [
        (1, None, 5), (2, "", 5), (3, "Some text.\nAnd more of it", None), (3, "Some text.\nAnd more of it", None),
        (4, "long words " * 50_000, 1), (None, "x" * 60_000, 2),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    out = token_digests(df, PATH, PATTERN).collect()
    assert len(out) == 6
    for r in out:
        expected = LIBRARY.encode_ordinary(r["text"] or "")
        assert r["n_tokens"] == len(expected)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, expected)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert token_digests(df.limit(0), PATH, PATTERN).count() == 0
    clash = df.withColumnRenamed("n_tokens", "ids").withColumn("Decoded", df.doc_id)
    back = decode_documents(encode_documents(clash, PATH, PATTERN), PATH, PATTERN)
    assert back.columns == ["doc_id", "text", "ids", "decoded"]
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in back.collect())


def test_query_on_given_documents(spark):
    from tidemark.llm.queries import llm_queries

    folder = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    found = llm_queries()["op11_byte_bpe"](spark, folder)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = found.collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = LIBRARY.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(expected)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, expected)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
