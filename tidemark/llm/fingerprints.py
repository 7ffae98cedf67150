"""Document fingerprints that tell two versions' differing passages.

A text is a set of passages (lines, cut at sentence ends and, where sentences
are long, at words chosen by their content), each a 64-bit digest. The
fingerprint is an invertible Bloom lookup sketch of the set: every digest is
added to one cell of each of three tables, a cell holding the number, the XOR
of digests and the XOR of check values. Subtracting two sketches leaves the
digests in which the sets differ; peeling cells that hold a single one recovers
them. If peeling gets stuck, larger sketches of both are made and tried again.
Sketches of a batch of documents are built and peeled together in arrays.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.shared import staged

from .frames import names_of, record_batch, shuffle_width, with_fields

TABLES = 3
CELLS = 8  # of each table of the fingerprint; a power of two
LONG_SENTENCE = 16  # words
GROUP = 256  # documents whose sketches are worked on together

_SENTENCE = re.compile(rb"\n|(?<=[.!?]) ")
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def passages(text: str) -> np.ndarray:
    """Distinct 64-bit digests of a text's passages; the n-th repetition has its own."""
    seen: dict[bytes, int] = {}
    digests = []

    def add(piece: bytes) -> None:
        count = seen[piece] = seen.get(piece, -1) + 1
        digests.append(xxhash.xxh3_64_intdigest(b"%b\0%d" % (piece, count) if count else piece))

    for sentence in _SENTENCE.split(text.encode("utf-8", "surrogatepass")):
        words = sentence.split()
        if len(words) <= LONG_SENTENCE:
            if words:
                add(b" ".join(words))
            continue
        start = 0
        for at, word in enumerate(words, 1):
            if zlib.crc32(word) & 7 == 0 or at == len(words):
                add(b" ".join(words[start:at]))
                start = at
    return np.unique(np.array(digests, np.uint64))  # a digest that occurs twice could not be peeled


def _mixed(keys: np.ndarray, salt: int, number: int) -> np.ndarray:
    x = (keys + _ODD[3:] * np.uint64(salt + 1)) * _ODD[number]
    return (x ^ (x >> np.uint64(29))) * _ODD[(number + 1) % 3] >> np.uint64(24)


class _Sketches:
    """Sketches of several sets side by side, each with its own number of cells."""

    def __init__(self, cells: np.ndarray, salt: int = 0, check_bits: int = 64) -> None:
        self.cells, self.salt = cells.astype(np.int64), salt
        self.mask = np.uint64((1 << check_bits) - 1)
        self.offsets = np.concatenate([[0], np.cumsum(self.cells * TABLES)])
        size = int(self.offsets[-1])
        self.owner = np.repeat(np.arange(len(cells)), self.cells * TABLES)
        self.counts = np.zeros(size, np.int32)
        self.keys = np.zeros(size, np.uint64)
        self.checks = np.zeros(size, np.uint64)

    def add(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray | int) -> None:
        checks = _mixed(keys, self.salt, 2) & self.mask
        for table in range(TABLES):
            place = _mixed(keys, self.salt + 7 * table, table % 2).astype(np.int64) & (self.cells[owner] - 1)
            place += self.offsets[owner] + table * self.cells[owner]
            np.add.at(self.counts, place, sign)
            np.bitwise_xor.at(self.keys, place, keys)
            np.bitwise_xor.at(self.checks, place, checks)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Owners, digests and signs of what was recovered, and for each set whether that is all of it."""
        nothing = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32)
        rounds = [nothing]
        for _ in range(64 * 64):
            pure = np.flatnonzero(np.abs(self.counts) == 1)
            pure = pure[_mixed(self.keys[pure], self.salt, 2) & self.mask == self.checks[pure]]
            if not len(pure):
                break
            owner, keys = self.owner[pure], self.keys[pure]
            _, one = np.unique(keys ^ (owner.astype(np.uint64) * _ODD[1]), return_index=True)
            owner, keys, sign = owner[one], keys[one], self.counts[pure[one]]
            self.add(owner, keys, -sign)
            rounds.append((owner, keys, sign))
        owner, keys, sign = (np.concatenate(part) for part in zip(*rounds))
        left = (self.counts != 0) | (self.keys != 0) | (self.checks != 0)
        stuck = np.bincount(self.owner[left], minlength=len(self.cells)) > 0
        return owner, keys, sign, ~stuck

    def bytes(self) -> list[bytes]:
        """Each sketch as bytes: counts modulo 2^16, digests, 32 bits of the check values."""
        made = []
        for a, b in zip(self.offsets[:-1], self.offsets[1:]):
            parts = (self.counts[a:b].astype("<i2"), self.keys[a:b].astype("<u8"), self.checks[a:b].astype("<u4"))
            made.append(b"".join(p.tobytes() for p in parts))
        return made

    @classmethod
    def difference(cls, left: Sequence[bytes], right: Sequence[bytes]) -> _Sketches:
        """Stored sketches (see ``bytes``) less others, cell by cell."""
        made = cls(np.full(len(left), CELLS), check_bits=32)
        a, b = (np.frombuffer(b"".join(side), _STORED).reshape(-1) for side in (left, right))
        made.counts = (a["counts"] - b["counts"]).reshape(-1).astype(np.int32)
        made.keys = (a["keys"] ^ b["keys"]).reshape(-1).astype(np.uint64)
        made.checks = (a["checks"] ^ b["checks"]).reshape(-1).astype(np.uint64)
        return made


#: A stored sketch.
_STORED = np.dtype([("counts", "<i2", CELLS * TABLES), ("keys", "<u8", CELLS * TABLES), ("checks", "<u4", CELLS * TABLES)])


def _flat(sets: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    return owner, np.concatenate([np.zeros(0, np.uint64), *sets])


def sketch_sets(sets: Sequence[np.ndarray]) -> list[bytes]:
    """The fingerprint of each set of passages."""
    made = _Sketches(np.full(len(sets), CELLS))
    made.add(*_flat(sets), 1)
    return made.bytes()


def differences(left: Sequence[np.ndarray], right: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What sets of passages differ in, for many pairs: numbers of pairs, digests, signs (1: only left, -1: only right).

    The first try subtracts sketches of the fingerprint's size; pairs that get
    stuck are tried again with cells for all their passages, then ever more.
    """
    sizes = np.array([len(a) + len(b) for a, b in zip(left, right)], np.int64)
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32))]
    todo, cells, attempt = np.arange(len(sizes)), np.full(len(sizes), CELLS), 0
    while len(todo):
        difference = _Sketches(cells, salt=attempt)
        difference.add(*_flat([left[i] for i in todo]), 1)
        difference.add(*_flat([right[i] for i in todo]), -1)
        owner, keys, sign, done = difference.peel()
        whole = done[owner]
        parts.append((todo[owner[whole]], keys[whole], sign[whole]))
        todo, cells, attempt = todo[~done], cells[~done], attempt + 1
        enough = 2 ** np.ceil(np.log2(np.maximum(sizes[todo], CELLS) * 0.55)).astype(np.int64)
        cells = np.maximum(cells * 2, enough)
    pair, keys, sign = (np.concatenate(part) for part in zip(*parts))
    return pair, keys, sign


def likeness(left: Sequence[np.ndarray], right: Sequence[np.ndarray]) -> np.ndarray:
    """Shared passages over all passages of two sets, for many pairs, by the digests they differ in."""
    sizes = np.array([len(a) + len(b) for a, b in zip(left, right)], np.int64)
    apart = np.bincount(differences(left, right)[0], minlength=len(sizes))
    return np.where(sizes > 0, (sizes - apart) / np.maximum(sizes + apart, 1), 1.0)


def _by_pair(count: int, pair: np.ndarray, keys: np.ndarray, chosen: np.ndarray) -> list[list[int]]:
    """Sorted digests, as signed numbers, of each pair."""
    digests = keys[chosen].view(np.int64)
    order = np.lexsort((digests, pair[chosen]))
    ends = np.cumsum(np.bincount(pair[chosen], minlength=count))[:-1]
    return [part.tolist() for part in np.split(digests[order], ends)] if count else []


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


#: Digests stay bytes until the end: they are written once in between.
FIELDS = (
    "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)
#: While documents are walked in order: also the first and the last of each range, with their texts.
_WALK_FIELDS = FIELDS + ", part int, role string, text string"


def _compared(ids: list, texts: list[str], following: list[str]) -> Iterator[dict[str, list]]:
    """Result columns for documents and the texts of their followers, in groups."""
    for at in range(0, len(ids), GROUP):
        own, behind = texts[at : at + GROUP], following[at : at + GROUP]
        changed = [edited(a, b) for a, b in zip(own, behind)]
        own_sets, changed_sets = [passages(t) for t in own], [passages(t) for t in changed]
        next_sets = [
            own_sets[i + 1] if i + 1 < len(own) and own[i + 1] is text else passages(text) for i, text in enumerate(behind)
        ]
        yield {
            "doc_id": ids[at : at + GROUP],
            "n_chars": [len(t) for t in own],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in changed],
            "fingerprint": sketch_sets(own_sets),
            "edited_fingerprint": sketch_sets(changed_sets),
            "near_edited": likeness(own_sets, changed_sets).tolist(),
            "near_next": likeness(own_sets, next_sets).tolist(),
        }


def fingerprint_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``fingerprint`` (an input column of that name is replaced); null counts as empty."""

    @F.pandas_udf("binary")
    def sketch(texts: pd.Series) -> pd.Series:
        return pd.Series(sketch_sets([passages(t or "") for t in texts]), dtype=object)

    return df.withColumn("fingerprint", F.base64(sketch(F.col(f"`{text}`"))))


DIFFERENCE_FIELDS = "removed array<long>, added array<long>, whole boolean"


def subtract_fingerprints(df: DataFrame, before: str, after: str) -> DataFrame:
    """``df`` with the passages' digests that two stored fingerprints differ in.

    ``before`` and ``after`` name columns as ``fingerprint_texts`` makes them; no
    text is read. ``removed`` has the digests only in the first, ``added`` those
    only in the second, in ascending order, as signed numbers. ``whole`` is false
    when the fingerprints differ in more than they can tell (about half as many
    passages as they have cells): both are null then, and ``text_differences``
    makes larger sketches. Nulls in a fingerprint, or one of another
    size, give nulls and false. Input columns of these names are replaced.
    """
    schema = T._parse_datatype_string(DIFFERENCE_FIELDS)

    @F.pandas_udf(schema)
    def subtract(before: pd.Series, after: pd.Series) -> pd.DataFrame:
        removed, added, whole = [None] * len(before), [None] * len(before), np.zeros(len(before), bool)
        fit = [i for i, (a, b) in enumerate(zip(before, after)) if a is not None and b is not None and len(a) == len(b) == _STORED.itemsize]
        for at in range(0, len(fit), GROUP):
            rows = fit[at : at + GROUP]
            owner, keys, sign, done = _Sketches.difference([before[i] for i in rows], [after[i] for i in rows]).peel()
            lost, new = _by_pair(len(rows), owner, keys, sign > 0), _by_pair(len(rows), owner, keys, sign < 0)
            for number, row in enumerate(rows):
                if done[number]:
                    removed[row], added[row], whole[row] = lost[number], new[number], True
        return pd.DataFrame({"removed": pd.Series(removed, dtype=object), "added": pd.Series(added, dtype=object), "whole": whole})

    return with_fields(df, subtract(F.unbase64(F.col(f"`{before}`")), F.unbase64(F.col(f"`{after}`"))), schema.names)


def text_differences(df: DataFrame, before: str, after: str) -> DataFrame:
    """As ``subtract_fingerprints``, from two columns of whole texts: larger sketches are made until all is recovered.

    Null texts are empty, so ``whole`` is always true.
    """
    schema = T._parse_datatype_string(DIFFERENCE_FIELDS)

    @F.pandas_udf(schema)
    def subtract(before: pd.Series, after: pd.Series) -> pd.DataFrame:
        removed, added = [], []
        for at in range(0, len(before), GROUP):
            left, right = ([passages(t or "") for t in side.iloc[at : at + GROUP]] for side in (before, after))
            pair, keys, sign = differences(left, right)
            removed += _by_pair(len(left), pair, keys, sign > 0)
            added += _by_pair(len(left), pair, keys, sign < 0)
        return pd.DataFrame({"removed": pd.Series(removed, dtype=object), "added": pd.Series(added, dtype=object), "whole": True})

    return with_fields(df, subtract(F.col(f"`{before}`"), F.col(f"`{after}`")), schema.names)


def fingerprint_edits(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness.

    The next document is the one with the next smaller id; after the last comes
    the first; a document alone is followed by itself. Null texts are empty,
    null ids come last, documents of one id are ordered by their text's hash.
    Every row gives a row, repeated rows included; other columns are left out. An
    empty table gives no rows; texts of any length are read whole.

    One range exchange puts documents in order. A document whose follower lies
    in the next range is finished in a second step over one row for each range.
    """
    width = shuffle_width(df)
    ordered = df.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    keys = (F.col("doc_id").desc_nulls_last(), F.col("tie"))
    ranges = (
        ordered.repartitionByRange(width, *keys).sortWithinPartitions(*keys).select("doc_id", "text", F.spark_partition_id().alias("part"))
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last document, which waits for its follower
        part = 0
        for batch in batches:
            ids, texts = batch["doc_id"].to_pylist(), batch["text"].to_pylist()
            if not ids:
                continue
            if held is None:
                part = batch["part"][0].as_py()
                edge = {"doc_id": ids[:1], "text": texts[:1], "part": [part], "role": ["first"]}
                yield record_batch(_WALK_FIELDS, edge)
            else:
                ids, texts = [held[0], *ids], [held[1], *texts]
            held = (ids[-1], texts[-1])
            for columns in _compared(ids[:-1], texts[:-1], texts[1:]):
                yield record_batch(_WALK_FIELDS, columns | {"role": ["done"] * len(columns["doc_id"])})
        if held is not None:
            edge = {"doc_id": [held[0]], "text": [held[1]], "part": [part], "role": ["last"]}
            yield record_batch(_WALK_FIELDS, edge)

    walked = staged(ranges.mapInArrow(walk, _WALK_FIELDS))

    # One row for each non-empty range: which range follows it.
    by_part = Window.orderBy("part")
    parts = walked.where("role = 'first'").select("part")
    follows = parts.select(
        "part",
        F.coalesce(
            F.lead("part").over(by_part),
            F.first("part").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("next_part"),
    )
    pairs = (
        walked.where("role = 'last'")
        .select("part", "doc_id", "text")
        .join(follows, "part")
        .join(walked.where("role = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following")), "next_part")
        .select("doc_id", "text", "following")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in _compared(*(batch[c].to_pylist() for c in ("doc_id", "text", "following"))):
                yield record_batch(FIELDS, columns)

    done = walked.where("role = 'done'").select(*names_of(FIELDS))
    return done.unionByName(pairs.mapInArrow(finish, FIELDS)).select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        F.base64("fingerprint").alias("fingerprint"),
        F.base64("edited_fingerprint").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
