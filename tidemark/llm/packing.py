"""Packs documents' tokens into sequences of a fixed size: hierarchical best fit.

Every task best-fits the documents it reads, longest first. Bins that are nearly
full are done; underfull bins are single items of the next round, in which fewer
tasks best-fit what is left, and so on: a tree of merges with a bounded number
of items in every task. The rounds end when one task has seen all that was left,
or when merging no longer helps.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.shared import staged

from .frames import record_batch
from .word_tokens import encoder

SIZE = 2048
END = 0  # id behind every document
NEARLY_FULL = 0.995  # of a sequence
ITEMS = 20_000  # that a task packs at once
WORTH = 0.98  # another round needs the underfull bins to have become at most this part of those before

_PIECE = np.dtype(
    [("doc_id", "<i8"), ("known", "?"), ("piece", "<i4"), ("start", "<i8"), ("length", "<i4"), ("crc", "<u4")]
)
_BIN = "filled int, content binary"
FIELDS = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of item numbers: items from the longest down, each into the fullest bin that holds it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0  # bit r: some bin has room r
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        length = lengths[item]
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[number].append(item)
        else:
            room, number = size, len(bins)
            bins.append([item])
        left = room - length
        if left:
            by_room[left].append(number)
            rooms |= 1 << left
    return bins


def _packed(items: list[tuple[int, bytes]], size: int) -> pa.RecordBatch:
    bins = best_fit([length for length, _ in items], size)
    return record_batch(
        _BIN,
        {
            "filled": [sum(items[i][0] for i in b) for b in bins],
            "content": [b"".join(items[i][1] for i in b) for b in bins],
        },
    )


def _first_round(documents: DataFrame, path: str, size: int, end: int) -> DataFrame:
    last = np.array([end], "<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[tuple[int, bytes]] = []
        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"]
            for at in range(0, len(ids), 500):
                for doc_id, tokens in zip(ids[at : at + 500], encoder(path).encode(texts[at : at + 500].to_pylist())):
                    tokens += last
                    for piece, start in enumerate(range(0, len(tokens) // 4, size)):
                        part = tokens[4 * start : 4 * (start + size)]
                        row = (doc_id or 0, doc_id is not None, piece, start, len(part) // 4, zlib.crc32(part))
                        items.append((len(part) // 4, np.array([row], _PIECE).tobytes()))
                if len(items) >= ITEMS:
                    yield _packed(items, size)
                    items = []
        yield _packed(items, size)

    return documents.mapInArrow(pack, _BIN)


def _next_round(bins: DataFrame, tasks: int, size: int) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[tuple[int, bytes]] = []
        for batch in batches:
            items += zip(batch["filled"].to_pylist(), batch["content"].to_pylist())
        yield _packed(items, size)

    return bins.repartition(tasks, F.xxhash64("content")).mapInArrow(pack, _BIN)


def pack_documents(
    df: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    end: int = END,
    items: int = ITEMS,
    worth: float = WORTH,
) -> DataFrame:
    """One row for each piece of a document: where it lies in which sequence.

    A document's tokens are those of the tokenizer file, without special tokens,
    then ``end``; a null or empty text is just an end. Only longer documents are
    cut, into pieces of ``size`` tokens. ``start`` is a piece's place in its
    document, ``offset`` its place in the sequence, ``ids_crc32`` the CRC of its
    ids as little-endian unsigned 32-bit numbers. Null and repeated ids keep one
    set of rows for each input row. Other columns are left out. An empty table
    gives no rows; a text of any length is cut like others.

    A round in which ``tasks`` pack apart ends the rounds when it leaves more
    than ``worth`` of the underfull bins it was given, since bins that hardly fit
    each other anywhere won't in fewer tasks either. ``worth=1`` goes on until
    one task has packed all that is left or a round saves nothing. Every document
    is packed either way; only the number of sequences depends on it.
    """
    documents = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    full = F.col("filled") >= math.ceil(NEARLY_FULL * size)
    bins = staged(_first_round(documents, tokenizer, size, end))
    done = [bins.where(full)]
    left, count = bins.where(~full), bins.where(~full).count()
    while count:
        tasks = math.ceil(count / items)
        bins = staged(_next_round(left, tasks, size))
        left, before, count = bins.where(~full), count, bins.where(~full).count()
        done.append(bins.where(full))
        if tasks == 1 or count >= before or count > worth * before:
            break
    sequences = done[0]
    for more in (*done[1:], left):
        sequences = sequences.unionByName(more)

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            columns: dict[str, list] = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")}
            for content in batch["content"].to_pylist():
                rows = np.frombuffer(content, _PIECE)
                columns["doc_id"] += [i if known else None for i, known in zip(rows["doc_id"].tolist(), rows["known"].tolist())]
                for name, field in (("piece", "piece"), ("start", "start"), ("length", "length"), ("ids_crc32", "crc")):
                    columns[name] += rows[field].tolist()
                columns["sequence_id"] += [number] * len(rows)
                columns["offset"] += (np.cumsum(rows["length"], dtype=np.int64) - rows["length"]).tolist()
                number += 1
            yield record_batch(FIELDS, columns)

    return sequences.mapInArrow(unfold, FIELDS)
