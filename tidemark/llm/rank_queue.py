"""Byte-level BPE ids by a rank queue over linked pieces, and their decoding.

A text is split by the vocabulary's pattern; every match (pre-token) is merged
on its own. The pieces of a pre-token form a linked list. Each pair of
neighbours that the vocabulary knows waits in the bucket of its rank, by the
position of its left piece. A bitmap of three levels says which buckets hold
anything: three find-first-set steps give the lowest rank, whose leftmost
position is merged next. A merge puts at most two new pairs into buckets; what
it makes untrue stays where it is and is skipped when its turn comes. So a
pre-token of n bytes takes O(n log n) steps, however long it is.

Pre-tokens repeat far more often than not, so each worker keeps the ids of short
ones, and drops those that were not used for the longest time.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import with_fields

KEPT = 400_000  # pre-tokens in each of two generations: about 170 MB in a worker
LONG = 64  # characters; longer pre-tokens are not kept
LONG_MERGE = 100_000  # bytes; beyond, positions are held in less memory
BLOCK = 1_000_000  # characters that are split at once
FIELDS = "n_tokens long, ids_sha256 string, decoded_sha256 string"

#: No match of the pattern reaches from a visible character over the space behind it.
_CUT = regex.compile(r"\S(?=\s)")


def _packed(values) -> array:
    return array("q", values)


class RankQueue:
    """Positions in buckets by rank. Buckets are heaps, so that the leftmost position comes first."""

    def __init__(self, ranks: int) -> None:
        self.buckets: list[list[int] | None] = [None] * ranks
        self.leaf = [0] * (ranks // 64 + 1)
        self.middle = [0] * (ranks // 4096 + 1)
        self.root = 0

    def fill(self, rank: int, positions: list[int]) -> None:
        """A bucket for a rank that has none; positions in ascending order."""
        self.buckets[rank] = positions
        self.leaf[rank >> 6] |= 1 << (rank & 63)
        self.middle[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.root |= 1 << (rank >> 12)

    def lowest(self) -> int:
        """The lowest rank that has a bucket; there must be one."""
        top = (self.root & -self.root).bit_length() - 1
        bits = self.middle[top]
        group = top << 6 | (bits & -bits).bit_length() - 1
        bits = self.leaf[group]
        return group << 6 | (bits & -bits).bit_length() - 1

    def drop(self, rank: int) -> None:
        """Remove an empty bucket."""
        self.buckets[rank] = None
        self.leaf[rank >> 6] &= ~(1 << (rank & 63))
        if not self.leaf[rank >> 6]:
            self.middle[rank >> 12] &= ~(1 << (rank >> 6 & 63))
            if not self.middle[rank >> 12]:
                self.root &= ~(1 << (rank >> 12))


class RankEncoder:
    """Ids of texts by a file of ranks (base64 of the token, blank, rank) and a split pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        size = max(self.ranks.values()) + 1
        self.shown = [b""] * size
        for token, rank in self.ranks.items():
            self.shown[rank] = token
        self.byte_ids = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)])
        self.pair_ranks = np.full(65_536, -1)
        for token, rank in self.ranks.items():
            if len(token) == 2:
                self.pair_ranks[token[0] << 8 | token[1]] = rank
        self.split = regex.compile(pattern).findall
        self.queue = RankQueue(size)
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, tokens: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token (not empty).

        All go through the queue together: a gap between two keeps them apart,
        and the merges of one rank share the search for it.
        """
        known = self.ranks.get
        whole = [known(token) for token in tokens]
        apart = [token for token, rank in zip(tokens, whole) if rank is None]
        made = iter(self._merge_apart(apart) if apart else ())
        return [next(made) if rank is None else [rank] for rank in whole]

    def _merge_apart(self, tokens: list[bytes]) -> list[list[int]]:
        data = b"\0" + b"\0".join(tokens) + b"\0"
        size = len(data)
        gap = bytearray(size)
        starts, at = [], 0
        for token in tokens:
            gap[at] = 1
            starts.append(at + 1)
            at += len(token) + 1
        gap[at] = 1
        values = np.frombuffer(data, np.uint8)
        apart = np.frombuffer(gap, np.uint8)
        ranks = np.where(apart[:-1] | apart[1:], -1, self.pair_ranks[values[:-1].astype(np.int64) << 8 | values[1:]])
        kind = list if size < LONG_MERGE else _packed
        waiting = kind([*ranks.tolist(), -1])  # rank of the pair that starts here
        ids = kind(self.byte_ids[values].tolist())
        following = kind(range(1, size + 1))
        previous = kind(range(-1, size - 1))

        queue, known = self.queue, self.ranks.get
        buckets, fill = queue.buckets, queue.fill
        places = np.flatnonzero(ranks >= 0)
        places = places[np.argsort(ranks[places], kind="stable")]
        cuts = np.flatnonzero(np.diff(ranks[places])) + 1
        for group in np.split(places, cuts) if len(places) else ():
            fill(int(ranks[group[0]]), group.tolist())

        while queue.root:
            rank = queue.lowest()
            bucket = buckets[rank]
            while bucket:
                at = heappop(bucket)
                if waiting[at] != rank:
                    continue  # one of the two pieces has changed since
                gone = following[at]
                behind = following[at] = following[gone]
                ids[at] = rank
                waiting[at] = waiting[gone] = -1
                lower = False
                if not gap[behind]:
                    previous[behind] = at
                    new = known(data[at : following[behind]])
                    if new is not None:
                        waiting[at] = new
                        if buckets[new] is None:
                            fill(new, [at])
                        else:
                            heappush(buckets[new], at)
                        lower = new < rank
                before = previous[at]
                if not gap[before]:
                    new = known(data[before:behind])
                    if new is None:
                        waiting[before] = -1
                    else:
                        waiting[before] = new
                        if buckets[new] is None:
                            fill(new, [before])
                        else:
                            heappush(buckets[new], before)
                        lower = lower or new < rank
                if lower:
                    break
            if not bucket:
                queue.drop(rank)

        made = []
        for at in starts:
            own = []
            while not gap[at]:
                own.append(ids[at])
                at = following[at]
            made.append(own)
        return made

    def _blocks(self, text: str):
        """Stretches of the text that can be split on their own."""
        start = 0
        while len(text) - start > BLOCK:
            cut = _CUT.search(text, start + BLOCK - 1)
            if cut is None:
                break
            yield text[start : cut.end()]
            start = cut.end()
        yield text[start:] if start else text

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers; null has none.

        Texts are taken together up to a block's size, longer ones in blocks.
        """
        held: list[tuple[str, bool]] = []  # blocks, and whether they end a text
        size, open_ids = 0, b""
        for text in texts:
            blocks = list(self._blocks((text or "").encode("utf-8", "replace").decode()))
            for number, block in enumerate(blocks, 1):
                if size + len(block) > BLOCK:
                    for ids, (_, ends) in zip(self._encode_blocks([b for b, _ in held]), held):
                        open_ids += ids
                        if ends:
                            yield open_ids
                            open_ids = b""
                    held, size = [], 0
                held.append((block, number == len(blocks)))
                size += len(block)
        for ids, (_, ends) in zip(self._encode_blocks([b for b, _ in held]), held):
            open_ids += ids
            if ends:
                yield open_ids
                open_ids = b""

    def _encode_blocks(self, blocks: list[str]) -> list[bytes]:
        matches = [self.split(block) for block in blocks]
        new = set().union(*matches).difference(self.kept)
        if len(self.kept) + len(new) > KEPT:
            self.older, self.kept = self.kept, {}
            new = set().union(*matches)
        unknown = []
        for match in new:
            found = self.older.get(match)
            if found is None:
                unknown.append(match)
            else:
                self.kept[match] = found
        for match, ids in zip(unknown, self.merge([m.encode() for m in unknown])):
            self.kept[match] = array("I", ids).tobytes()
        made = [b"".join(map(self.kept.__getitem__, found)) for found in matches]
        for match in unknown:
            if len(match) > LONG:
                del self.kept[match]
        return made

    def decode(self, ids: bytes) -> bytes:
        shown = self.shown
        return b"".join([shown[i] for i in np.frombuffer(ids, "<u4").tolist()])


@lru_cache(maxsize=2)
def rank_encoder(path: str, pattern: str) -> RankEncoder:
    """One encoder for each worker, file and pattern."""
    return RankEncoder(path, pattern)


def encode_documents(df: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids``, the array of the text's ids (replaces a column of that name); null has none.

    No string in a text counts as a special token. A pre-token needs about 100
    bytes of memory for each of its own while it is merged, a text some 40.
    """

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        model = rank_encoder(ranks, pattern)
        return pd.Series([np.frombuffer(ids, "<u4").astype(np.int32) for ids in model.encode(texts)], dtype=object)

    return with_fields(df, F.struct(encode(F.col(f"`{text}`")).alias("ids")), ["ids"])


def decode_documents(df: DataFrame, ranks: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the bytes of the ids (replaces a column of that name); null ids give none.

    Bytes, not text: ids cut out of a text may end within a character.
    """

    @F.pandas_udf("binary")
    def decode(rows: pd.Series) -> pd.Series:
        model = rank_encoder(ranks, pattern)
        made = [model.decode(np.array([] if row is None else row, "<u4").tobytes()) for row in rows]
        return pd.Series(made, dtype=object)

    return with_fields(df, F.struct(decode(F.col(f"`{ids}`")).alias("decoded")), ["decoded"])


def token_digests(df: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with the number and digest of its ids, and the digest of their decoding.

    Null and empty texts have no ids; repeated rows count each. Every row is
    encoded whole and alike; input columns named like a result are replaced.
    """
    schema = T.StructType.fromDDL(FIELDS)

    @F.pandas_udf(schema)
    def digest(texts: pd.Series) -> pd.DataFrame:
        model = rank_encoder(ranks, pattern)
        decimal = [str(i) for i in range(len(model.shown))].__getitem__
        rows = []
        for ids in model.encode(texts):
            listed = ",".join(map(decimal, np.frombuffer(ids, "<u4").tolist()))
            rows.append((len(ids) // 4, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(model.decode(ids)).hexdigest()))
        return pd.DataFrame(rows, columns=schema.names)

    return with_fields(df, digest(F.col(f"`{text}`")), schema.names)
