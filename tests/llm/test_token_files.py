import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import token_files
from tidemark.llm.token_files import BLOCK, read_frame, read_token_digests, read_token_files, write_frame, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def raw(ids):
    return np.array(ids, "<u4").tobytes()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)), st.lists(st.integers(0, 0xFFFF), max_size=40).map(raw)), max_size=6))
def test_round_trip(documents):
    assert read_frame(write_frame(documents)) == documents


@pytest.mark.parametrize("n", [1, BLOCK - 1, BLOCK, BLOCK + 1, 5 * BLOCK + 7])
@pytest.mark.parametrize("kind", ["random", "same", "periodic", "skewed"])
def test_round_trip_of_blocks(n, kind):
    rng = np.random.default_rng(n)
    ids = {
        "random": rng.integers(0, 0x10000, n),
        "same": np.full(n, 65535),
        "periodic": np.arange(n) % 17,
        "skewed": np.minimum(rng.zipf(1.3, n), 49407),
    }[kind]
    frame = write_frame([(5, raw(ids))])
    assert read_frame(frame) == [(5, raw(ids))]
    if n > 4 * BLOCK and kind in ("same", "periodic"):
        assert len(frame) < n / 8
    if n > 4 * BLOCK and kind == "skewed":
        assert len(frame) < 0.9 * len(zlib.compress(ids.astype("<u2").tobytes(), 9))


def test_damage_is_found():
    frame = bytearray(write_frame([(1, raw(range(3000)))]))
    frame[-1500] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        read_frame(bytes(frame))
    with pytest.raises(ValueError, match="65,535"):
        write_frame([(1, raw([70000]))])


def test_every_flipped_bit_and_cut_is_found():
    documents = [(7, raw(range(40))), (None, raw([5, 6])), (-3, b"")]
    frame = write_frame(documents)
    tables = 16 + 3 * token_files._DOC.itemsize + token_files._BLOCK.itemsize
    for at in range(8 * tables):
        damaged = bytearray(frame)
        damaged[at // 8] ^= 1 << at % 8
        with pytest.raises(ValueError):
            read_frame(bytes(damaged))
    for size in range(tables):
        with pytest.raises(ValueError):
            read_frame(frame[:size])
    for at in range(8 * tables, 8 * len(frame)):  # behind the tables: right ids or an error
        damaged = bytearray(frame)
        damaged[at // 8] ^= 1 << at % 8
        try:
            assert read_frame(bytes(damaged)) == documents
        except ValueError:
            pass


@pytest.mark.parametrize("frame", [token_files.FRAME, 500])
def test_files_equal_brute_force(spark, tmp_path, monkeypatch, frame):
    monkeypatch.setattr(token_files, "FRAME", frame)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["the", "cat", "sat.", "über"], k=rng.randint(0, 200))), i) for i in rng.sample(range(500), 80)]
    rows += [(900, None, 0), (901, "", 0), (902, "", 0), (903, "long " * 20_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start long").repartition(5)
    write_token_files(df, str(tmp_path / "t"), PATH)
    out = {r["doc_id"]: r for r in read_token_digests(spark, str(tmp_path / "t")).collect()}
    whole = {r["doc_id"]: (r["start"], bytes(r["ids"])) for r in read_token_files(spark, str(tmp_path / "t")).collect()}
    at = 0
    assert len(out) == len(rows)
    for doc_id, text, _ in sorted(rows):
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]
        assert (out[doc_id]["start"], out[doc_id]["n_tokens"], out[doc_id]["ids_crc32"]) == (at, len(ids), zlib.crc32(raw(ids)))
        assert whole[doc_id] == (at, raw(ids))
        at += len(ids)


def test_edge_frames(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, None)], "doc_id long, text string")
    write_token_files(df, str(tmp_path / "e"), PATH)
    out = read_token_digests(spark, str(tmp_path / "e")).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in out][:2] == [(1, 0, 2), (1, 2, 2)]
    assert sum(r["n_tokens"] for r in out) == 7 and [r["doc_id"] for r in out][2:] == [None, None]
    write_token_files(df.limit(0), str(tmp_path / "n"), PATH)
    assert read_token_digests(spark, str(tmp_path / "n")).count() == 0
