"""Byte-level BPE ids by content-defined chunks, and their decoding.

A text is cut where a rolling hash of the last 16 bytes hits a pattern, so
passages that documents share fall into the same chunks wherever they stand. A
chunk is encoded once and its ids are kept for the documents that follow in the
worker. A cut may fall into a token; so at each join the stretch between the
nearest firm boundary on either side is encoded again and replaces what the
chunks had there. Firm boundaries - a printable ASCII mark before ASCII white
space - end a token whatever lies around them, so at both ends of the stretch
the new ids and the chunks' own agree exactly. A chunk without a firm boundary
becomes part of the stretch, which grows until it has one.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import with_fields

MASK = 0x1FF  # a cut every 512 bytes on average
UNITS_KEPT = 600_000  # about 150 MB in a worker
LONG = 64  # bytes; longer units are not kept
CHUNK_BYTES_KEPT = 16_000_000

_GEAR = np.random.default_rng(77).integers(0, 2**32, 256, np.uint32)
_FIRM = re.compile(rb"(?<=[\x21-\x7e])(?=[\x20\x09-\x0d])")
#: A word and the marks behind it, which the tokenizer's pattern always parts.
_MARKED = re.compile(rb"( [A-Za-z]+)([!-&(-/:-@\[-`{-~]+)")
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Text before the first firm boundary; ids from there to the last, or units that wait
#: for theirs; text behind it, None if there is no firm boundary.
_Entry = list
FIELDS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``, never inside a character of UTF-8."""
    values = np.frombuffer(data, np.uint8)
    hashed = _GEAR[values]
    for step in (1, 2, 4, 8):  # sums of 2, 4, 8, 16 shifted bytes
        hashed[step:] += hashed[:-step] << np.uint32(step)
    cuts = np.flatnonzero(((hashed[:-1] >> np.uint32(16)) & np.uint32(MASK)) == 0) + 1
    cuts = cuts[(values[cuts] & 0xC0) != 0x80]
    return [*cuts.tolist(), len(data)]


def _bytes_of_chars() -> dict[str, int]:
    """The visible characters in which byte-level vocabularies are written."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class ChunkEncoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.units: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, _Entry] = {}
        self.chunk_bytes = 0
        chars = _bytes_of_chars()
        added = {number for number in self.library.get_added_tokens_decoder()}
        self.shown: list[bytes] = [b""] * self.library.get_vocab_size()
        for token, number in self.library.get_vocab().items():
            if number in added or not all(c in chars for c in token):
                self.shown[number] = token.encode()
            else:
                self.shown[number] = bytes(chars[c] for c in token)
        self.sizes = np.array([len(shown) for shown in self.shown])

    def _learn(self, units: set[bytes]) -> None:
        """Keep the ids of units; those of a word with marks are its own and the marks'."""
        marked = {u: m.groups() for u in units if len(u) <= LONG and (m := _MARKED.fullmatch(u))}
        known = self.units
        self._encode(units.difference(marked).union(p for pair in marked.values() for p in pair if p not in known))
        for unit, (word, marks) in marked.items():
            known[unit] = known[word] + known[marks]

    def _encode(self, units: set[bytes]) -> None:
        """Have the library encode units.

        Those that start and end at firm boundaries are encoded as one text: its
        tokens end where they do, which the tokens' bytes tell.
        """
        inner = [u for u in units if u[0] in _SPACE and 0x21 <= u[-1] <= 0x7E]
        if inner:
            text = b"".join(inner).decode("utf-8", "replace")
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends, wanted = np.cumsum(self.sizes[ids]), np.cumsum(list(map(len, inner)))
            last = np.searchsorted(ends, wanted)
            assert np.array_equal(ends[last], wanted), "a firm boundary ends a token"
            raw, start = ids.tobytes(), 0
            for unit, stop in zip(inner, (4 * last + 4).tolist()):
                self.units[unit] = raw[start:stop]
                start = stop
        others = list(units.difference(inner))
        texts = [u.decode("utf-8", "replace") for u in others]
        for unit, encoded in zip(others, self.library.encode_batch_fast(texts, add_special_tokens=False)):
            self.units[unit] = np.array(encoded.ids, "<u4").tobytes()

    def _resolve(self, entries: list[_Entry]) -> None:
        """Put ids in the place of the entries' units; new units of all of them are encoded together."""
        every = set().union(*[entry[1] for entry in entries])
        new = every.difference(self.units)
        if new:
            if len(self.units) + 2 * len(new) > UNITS_KEPT:  # words of marked units are kept, too
                self.units.clear()
                new = every
            self._learn(new)
        find = self.units.__getitem__
        for entry in entries:
            entry[1] = b"".join(map(find, entry[1]))
        for unit in new:
            if len(unit) > LONG:
                del self.units[unit]

    def _chunk(self, data: bytes) -> _Entry:
        """A chunk's entry; that of a new chunk still has units."""
        first = _FIRM.search(data)
        if first is None:
            return [data, b"", None]
        last = len(data)
        while not _FIRM.match(data, last):
            last = max(map(data[:last].rfind, (b" ", b"\n", b"\t", b"\r", b"\v", b"\f")))
        middle = data[first.start() : last]
        return [data[: first.start()], _FIRM.split(middle) if middle else b"", data[last:]]

    def encode(self, text: str | None) -> bytes:
        """A text's ids as little-endian unsigned 32-bit numbers; null has none."""
        data = (text or "").encode("utf-8", "replace")
        if not data:
            return b""
        parts: list[_Entry] = []
        waiting: list[_Entry] = []
        open_text, start = b"", 0

        def stretch() -> None:
            if open_text:
                parts.append([b"", _FIRM.split(open_text), b""])
                waiting.append(parts[-1])

        for end in cut_points(data):
            chunk = data[start:end]
            start = end
            entry = self.chunks.get(chunk)
            if entry is None:
                if self.chunk_bytes > CHUNK_BYTES_KEPT:
                    self.chunks.clear()
                    self.chunk_bytes = 0
                entry = self.chunks[chunk] = self._chunk(chunk)
                self.chunk_bytes += 3 * len(chunk)
                if entry[1]:
                    waiting.append(entry)
            open_text += entry[0]
            if entry[2] is None:
                continue
            stretch()
            parts.append(entry)
            open_text = entry[2]
        stretch()
        self._resolve(waiting)
        return b"".join([entry[1] for entry in parts])

    def decode(self, ids: bytes) -> str:
        shown = self.shown
        return b"".join([shown[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    """One encoder for each worker and file."""
    return ChunkEncoder(path)


def encode_documents(df: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids``, the array of the text's ids (replaces a column of that name); null has none."""

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(chunk_encoder(tokenizer).encode(t), "<u4").astype(np.int32) for t in texts], dtype=object)

    return df.withColumn("ids", encode(F.col(f"`{text}`")))


def decode_documents(df: DataFrame, tokenizer: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the text of the ids, special tokens included; null ids give an empty text."""

    @F.pandas_udf("string")
    def decode(rows: pd.Series) -> pd.Series:
        made = [chunk_encoder(tokenizer).decode(np.array([] if row is None else row, "<u4").tobytes()) for row in rows]
        return pd.Series(made, dtype=object)

    return df.withColumn("decoded", decode(F.col(f"`{ids}`")))


def token_digests(df: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``df`` with the number and digest of its ids, and the digest of their decoding.

    Null and empty texts have no ids. Every row is encoded whole and alike;
    input columns named like a result are replaced.
    """
    schema = T.StructType.fromDDL(FIELDS)

    @F.pandas_udf(schema)
    def digest(texts: pd.Series) -> pd.DataFrame:
        model = chunk_encoder(tokenizer)
        decimal = [str(i) for i in range(len(model.shown))].__getitem__
        rows = []
        for value in texts:
            ids = model.encode(value)
            listed = ",".join(map(decimal, np.frombuffer(ids, "<u4").tolist()))
            decoded = model.decode(ids).encode("utf-8", "surrogatepass")
            rows.append((len(ids) // 4, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        return pd.DataFrame(rows, columns=schema.names)

    return with_fields(df, digest(F.col(f"`{text}`")), schema.names)
