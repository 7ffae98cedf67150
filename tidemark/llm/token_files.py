"""Compressed files of token ids: an adaptive context-mixing range coder.

A frame holds whole documents; its ids are cut into blocks of 2,048 that are
coded on their own, each with a fresh model and a checksum, so a damaged block
spoils no other; the document table and the blocks' heads have a checksum, too. A
block's model predicts the next id in three orders: the id
that last followed the two ids before it, the one that last followed the id
before it, and adaptive frequencies of ids, in four steps of four bits. Whether
the predicted id comes is coded first, with a probability mixed from adaptive
counts of several contexts; the mixing weights follow how well each did lately.
An id that is not the predicted one is coded by the frequencies.

All arithmetic is in integers. A frame's blocks advance in step, one id of every
block at a time, as arrays: the same code models encoding and decoding.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.shared import new_folder

from .frames import record_batch, shuffle_width
from .word_tokens import encoder

BLOCK = 2048  # ids
FRAME = 2048 * BLOCK  # ids from which a frame is closed
END = 1  # id behind every document

_MAGIC = b"TKF2"
_HEAD = struct.Struct("<III")  # documents, blocks, checksum of these two, the table and the heads
_DOC = np.dtype([("doc_id", "<i8"), ("known", "?"), ("length", "<u4")])
_BLOCK = np.dtype([("length", "<u2"), ("words", "<u2"), ("crc", "<u4")])
_SLOTS = 1024  # of a block's prediction tables
_CERTAIN = 4096  # scale of probabilities
_STEP, _MOST = 24, 6000  # growth of a frequency, and the sum at which a row is halved
_LOW32, _LOW48 = np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFFFFFF)
_16, _32, _48 = np.uint64(16), np.uint64(32), np.uint64(48)


class _Writer:
    """Range coding of one symbol for each of many blocks at once; ranges stay in [2^32, 2^48)."""

    def __init__(self, blocks: int) -> None:
        self.low = np.zeros(blocks, np.uint64)
        self.range = np.full(blocks, 1 << 47, np.uint64)
        self.words = np.zeros((blocks, 5 * BLOCK), np.uint16)
        self.count = np.zeros(blocks, np.int64)

    def code(self, at: np.ndarray, start: np.ndarray, size: np.ndarray, whole: np.ndarray | int) -> None:
        unit = self.range[at] // np.uint64(whole) if isinstance(whole, int) else self.range[at] // whole
        low, span = self.low[at] + start * unit, size * unit
        carried = at[(low >> _48) > 0]
        place = self.count[carried] - 1
        while len(carried):
            self.words[carried, place] += np.uint16(1)
            more = self.words[carried, place] == 0
            carried, place = carried[more], place[more] - 1
        low &= _LOW48
        small = np.flatnonzero(span < (1 << 32))
        if len(small):
            blocks = at[small]
            self.words[blocks, self.count[blocks]] = (low[small] >> _32).astype(np.uint16)
            self.count[blocks] += 1
            low[small] = (low[small] & _LOW32) << _16
            span[small] <<= _16
        self.low[at], self.range[at] = low, span

    def flag(self, at: np.ndarray, chance: np.ndarray, given: np.ndarray) -> np.ndarray:
        chance = chance.astype(np.uint64)
        self.code(at, np.where(given, np.uint64(0), chance), np.where(given, chance, np.uint64(_CERTAIN) - chance), _CERTAIN)
        return given

    def symbol(self, at: np.ndarray, sums: np.ndarray, given: np.ndarray) -> np.ndarray:
        rows = np.arange(len(at))
        upto = sums[rows, given].astype(np.uint64)
        start = np.where(given > 0, sums[rows, given - 1], 0).astype(np.uint64)
        self.code(at, start, upto - start, sums[:, -1].astype(np.uint64))
        return given

    def finished(self) -> list[np.ndarray]:
        blocks = np.arange(len(self.low))
        for shift in (_32, _16, np.uint64(0)):
            self.words[blocks, self.count] = ((self.low >> shift) & np.uint64(0xFFFF)).astype(np.uint16)
            self.count += 1
        return [row[:n] for row, n in zip(self.words, self.count.tolist())]


class _Reader:
    def __init__(self, words: list[np.ndarray]) -> None:
        longest = max(map(len, words)) + 4
        self.words = np.zeros((len(words), longest), np.uint64)
        for row, own in zip(self.words, words):
            row[: len(own)] = own
        self.code = (self.words[:, 0] << _32) | (self.words[:, 1] << _16) | self.words[:, 2]
        self.range = np.full(len(words), 1 << 47, np.uint64)
        self.count = np.full(len(words), 3)

    def _take(self, at: np.ndarray, code: np.ndarray, span: np.ndarray) -> None:
        small = np.flatnonzero(span < (1 << 32))
        if len(small):
            blocks = at[small]
            code[small] = (code[small] << _16) | self.words[blocks, self.count[blocks]]
            self.count[blocks] += 1
            span[small] <<= _16
        self.code[at], self.range[at] = code, span

    def flag(self, at: np.ndarray, chance: np.ndarray, given: None) -> np.ndarray:
        chance = chance.astype(np.uint64)
        unit, code = self.range[at] // np.uint64(_CERTAIN), self.code[at]
        edge = chance * unit
        hit = code < edge
        self._take(at, np.where(hit, code, code - edge), np.where(hit, chance, np.uint64(_CERTAIN) - chance) * unit)
        return hit

    def symbol(self, at: np.ndarray, sums: np.ndarray, given: None) -> np.ndarray:
        sums = sums.astype(np.uint64)
        unit, code = self.range[at] // sums[:, -1], self.code[at]
        found = np.minimum((sums <= (code // unit)[:, None]).sum(axis=1), 15)
        rows = np.arange(len(at))
        start = np.where(found > 0, sums[rows, found - 1], np.uint64(0))
        self._take(at, code - start * unit, (sums[rows, found] - start) * unit)
        return found


def _model(coder: _Writer | _Reader, lengths: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
    """Runs all blocks through the model; ``lengths`` don't rise. Gives the ids (blocks x BLOCK)."""
    blocks = len(lengths)
    out = np.zeros((blocks, int(lengths[0])), np.int64) if ids is None else ids
    guesses = [np.zeros(blocks * _SLOTS, np.int32) for _ in range(2)]  # order 1 and 2
    trusts = [np.zeros(blocks * _SLOTS, np.int8) for _ in range(2)]  # 0 (nothing yet) to 3
    counts = [np.full((blocks, n), _CERTAIN // 2, np.int32) for n in (32, 4, 1)]
    weights = np.full((3, blocks), 1 << 14, np.int64)
    steps = [np.ones((blocks * n, 16), np.uint16) for n in (1, 16, 256, 256)]
    before = np.zeros((2, blocks), np.int64)
    for t in range(int(lengths[0])):
        active = int(np.searchsorted(-lengths, -t))  # blocks longer than t
        lane = np.arange(active)
        one, two = before[0, :active], before[1, :active]
        slots = [lane * _SLOTS + ((one * 40503) >> 4) % _SLOTS, lane * _SLOTS + ((one * 40503 + two * 30011) >> 3) % _SLOTS]
        g1, g2 = (g[slot].astype(np.int64) for g, slot in zip(guesses, slots))
        t1, t2 = trusts[0][slots[0]], trusts[1][slots[1]]
        guess = np.where(t2 > 0, g2, g1)
        known = np.flatnonzero((t1 > 0) | (t2 > 0))
        truth = None if ids is None else ids[:active, t]
        hit = np.zeros(active, bool)
        if len(known):
            contexts = [(t2[known] * 8 + t1[known] * 2 + (g1[known] == g2[known])).astype(np.intp), t2[known].astype(np.intp), 0]
            chances = np.stack([c[known, x] for c, x in zip(counts, contexts)]).astype(np.int64)
            own = weights[:, known]
            mixed = np.clip((own * chances).sum(axis=0) // own.sum(axis=0), 16, _CERTAIN - 16)
            came = coder.flag(known, mixed, None if truth is None else truth[known] == guess[known])
            hit[known] = came
            for c, x, chance in zip(counts, contexts, chances):
                c[known, x] = chance + (((came * (_CERTAIN - 1)) - chance) >> 4)
            weights[:, known] = own - (own >> 4) + np.where(came, chances, _CERTAIN - chances)
        missed = np.flatnonzero(~hit)
        found = guess
        if len(missed):
            high = np.zeros(len(missed), np.int64)
            for number, table in enumerate(steps):
                rows = missed * (len(table) // blocks) + (high & 0xFF)
                frequencies = table[rows]
                sums = np.cumsum(frequencies, axis=1, dtype=np.int64)
                nibble = None if truth is None else (truth[missed] >> (12 - 4 * number)) & 15
                nibble = coder.symbol(missed, sums, nibble)
                frequencies[np.arange(len(missed)), nibble] += _STEP
                large = sums[:, -1] > _MOST
                if large.any():
                    frequencies[large] = (frequencies[large] + 1) >> 1
                table[rows] = frequencies
                high = (high << 4) | nibble
            found[missed] = high
        if truth is None:
            out[:active, t] = found
        for guessed, trust, slot, old, sure in zip(guesses, trusts, slots, (g1, g2), (t1, t2)):
            right = (old == found) & (sure > 0)
            gone = ~right & (sure <= 1)
            trust[slot] = np.where(right, np.minimum(sure + 1, 3), np.where(gone, 1, sure - 1))
            guessed[slot] = np.where(gone, found, old)
        before[1, :active] = one
        before[0, :active] = found
    return out


def write_frame(documents: list[tuple[int | None, bytes]]) -> bytes:
    """A frame of (document id, its ids as little-endian unsigned 32-bit numbers)."""
    joined = np.frombuffer(b"".join(ids for _, ids in documents), "<u4")
    if len(joined) and int(joined.max()) > 0xFFFF:
        raise ValueError("ids above 65,535 don't fit this format")
    table = np.array([(doc_id or 0, doc_id is not None, len(ids) // 4) for doc_id, ids in documents], _DOC)
    blocks = -(-len(joined) // BLOCK)
    heads = np.zeros(blocks, _BLOCK)
    payload = b""
    if blocks:
        padded = np.zeros(blocks * BLOCK, np.int64)
        padded[: len(joined)] = joined
        padded = padded.reshape(blocks, BLOCK)
        heads["length"] = BLOCK
        heads["length"][-1] = len(joined) - BLOCK * (blocks - 1)
        coder = _Writer(blocks)
        _model(coder, heads["length"].astype(np.int64), padded)
        words = coder.finished()
        heads["words"] = [len(w) for w in words]
        heads["crc"] = [zlib.crc32(joined[BLOCK * i : BLOCK * (i + 1)].tobytes()) for i in range(blocks)]
        payload = np.concatenate(words).astype("<u2").tobytes()
    tables = table.tobytes() + heads.tobytes()
    return b"".join([_MAGIC, _HEAD.pack(len(table), blocks, _tables_crc(len(table), blocks, tables)), tables, payload])


def _tables_crc(n_docs: int, blocks: int, tables: bytes) -> int:
    return zlib.crc32(tables, zlib.crc32(struct.pack("<II", n_docs, blocks)))


def read_frame(frame: bytes) -> list[tuple[int | None, bytes]]:
    """The documents of a frame; raises ValueError when a checksum is wrong or the frame is cut."""
    at = len(_MAGIC) + _HEAD.size
    if frame[:4] != _MAGIC or len(frame) < at:
        raise ValueError("not a frame of token ids")
    n_docs, blocks, crc = _HEAD.unpack_from(frame, 4)
    behind = at + n_docs * _DOC.itemsize + blocks * _BLOCK.itemsize
    if len(frame) < behind or _tables_crc(n_docs, blocks, frame[at:behind]) != crc:
        raise ValueError("the document table or the blocks' heads are damaged")
    table = np.frombuffer(frame, _DOC, n_docs, at)
    heads = np.frombuffer(frame, _BLOCK, blocks, at + table.nbytes)
    at = behind
    joined = b""
    if blocks:
        ends = np.cumsum(heads["words"], dtype=np.int64)
        words = np.split(np.frombuffer(frame, "<u2", int(ends[-1]), at), ends[:-1])
        ids = _model(_Reader(words), heads["length"].astype(np.int64), None).astype("<u4")
        parts = [row[:n].tobytes() for row, n in zip(ids, heads["length"].tolist())]
        for number, (part, crc) in enumerate(zip(parts, heads["crc"].tolist())):
            if zlib.crc32(part) != crc:
                raise ValueError(f"block {number} is damaged")
        joined = b"".join(parts)
    documents, start = [], 0
    for doc_id, known, length in table.tolist():
        documents.append((doc_id if known else None, joined[start : start + 4 * length]))
        start += 4 * length
    return documents


_WRITTEN = "part int, number int, first long, n_tokens long, frame binary"
FIELDS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_token_files(df: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = END) -> None:
    """Writes all documents' ids below ``folder``, in ascending order of their ids.

    A document's ids are those of the tokenizer file, without special tokens,
    then ``end``; a null or empty text is just an end. Null ids come last,
    documents of one id follow each other by their text's hash. Each range of
    documents becomes a part of numbered frames; ``first`` is where a frame
    starts in its part. An empty table writes files without rows; a document
    longer than a frame makes one longer frame. Other columns are left out.
    """
    keys = (F.col("doc_id").asc_nulls_last(), F.col("tie"))
    documents = (
        df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(shuffle_width(df), *keys)
        .sortWithinPartitions(*keys)
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    last = np.array([end], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, bytes]] = []
        part = number = first = size = 0

        def close() -> pa.RecordBatch:
            nonlocal held, number, first, size
            frame = {"part": [part], "number": [number], "first": [first], "n_tokens": [size], "frame": [write_frame(held)]}
            held, number, first, size = [], number + 1, first + size, 0
            return record_batch(_WRITTEN, frame)

        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"]
            if ids:
                part = batch["part"][0].as_py()
            for at in range(0, len(ids), 200):
                for doc, tokens in zip(ids[at : at + 200], encoder(tokenizer).encode(texts[at : at + 200].to_pylist())):
                    held.append((doc, tokens + last))
                    size += len(tokens) // 4 + 1
                    if size >= FRAME:
                        yield close()
        if held:
            yield close()

    documents.mapInArrow(write, _WRITTEN).write.parquet(folder)


def read_token_files(spark, folder: str) -> DataFrame:
    """(doc_id, start, ids): every document's ids and how many come before them in all."""
    frames = _with_starts(spark.read.parquet(folder))
    return _documents(frames, "doc_id long, start long, ids binary", lambda ids: {"ids": ids})


def read_token_digests(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    frames = _with_starts(spark.read.parquet(folder))
    return _documents(
        frames, FIELDS, lambda ids: {"n_tokens": [len(i) // 4 for i in ids], "ids_crc32": [zlib.crc32(i) for i in ids]}
    )


def _with_starts(frames: DataFrame) -> DataFrame:
    # One row for each part, however many frames it has.
    parts = frames.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    return frames.join(base, "part").select((F.col("base") + F.col("first")).alias("start"), "frame")


def _documents(frames: DataFrame, fields: str, columns) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, frame in zip(batch["start"].to_pylist(), batch["frame"].to_pylist()):
                documents = read_frame(frame)
                ids = [i for _, i in documents]
                sizes = np.array([len(i) // 4 for i in ids], np.int64)
                yield record_batch(
                    fields,
                    {"doc_id": [d for d, _ in documents], "start": (start + np.cumsum(sizes) - sizes).tolist(), **columns(ids)},
                )

    return frames.mapInArrow(read, fields)


def token_digests(df: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the documents' ids to files in the shared folder and digests what is read back.

    Every row gives a row, repeated rows, null ids and null texts included (an
    end only); an empty table gives none.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "tokens")
    write_token_files(df, folder, tokenizer)
    return read_token_digests(spark, folder)
