"""Ids of the word-end BPE tokenizer for whole texts, word by word.

The tokenizer drops white space and never lets a token reach over it, so a
text's ids are those of its words (cut at ASCII white space) in a row. Texts
repeat words far more often than not: each worker keeps the ids of words it has
met, and hands only new ones to the library - their letter and mark parts in
one call, since normalising is most of the library's work. Anything but common
Latin text goes through the library's whole chain.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np

WORDS_KEPT = 450_000  # about 90 MB in a worker, 150 MB if all are of the greatest length
LONG = 64  # bytes; longer words and parts of words are not kept
#: What the fast way takes: lower-case ASCII and Latin-1 letters, digits and
#: ASCII marks; the cuts are those of the tokenizer's own pattern.
_COMMON = re.compile(r"[a-z0-9ß-öø-ÿ!-/:-@\[-`{-~]+")
_PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class WordEncoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.whole = Tokenizer.from_file(path)
        self.whole.no_padding()
        self.whole.no_truncation()
        self.bare = Tokenizer(self.whole.model)
        self.bare.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        ends = np.zeros(self.whole.get_vocab_size(), bool)
        for token, number in self.whole.get_vocab(with_added_tokens=False).items():
            ends[number] = token.endswith("</w>")
        self.ends = ends
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _learn_parts(self, parts: set[str]) -> None:
        new = [p for p in parts if p not in self.parts]
        for at in range(0, len(new), 1000):
            group = new[at : at + 1000]
            ids = np.array(self.bare.encode(group, is_pretokenized=True, add_special_tokens=False).ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            assert len(stops) == len(group), "a part's last token ends it, no other does"
            raw, start = ids.tobytes(), 0
            for part, stop in zip(group, (4 * stops).tolist()):
                self.parts[part] = raw[start:stop]
                start = stop

    def _learn(self, words: set[bytes]) -> None:
        if len(self.words) + len(words) > WORDS_KEPT:
            self.words.clear()
        if len(self.parts) > WORDS_KEPT:
            self.parts.clear()
        cut: dict[bytes, list[str]] = {}
        plain: dict[bytes, str] = {}
        listed = list(words)
        # No word has a line end in it, so all are lower-cased in one go.
        for word, low in zip(listed, b"\n".join(listed).decode("utf-8", "replace").lower().split("\n")):
            if low.isascii() and low.isalpha():
                plain[word] = low
            elif _COMMON.fullmatch(low) and "<|" not in low:
                cut[word] = _PART.findall(low)
            else:
                found = self.whole.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
                self.words[word] = np.array(found, "<u4").tobytes()
        self._learn_parts(set(chain(plain.values(), *cut.values())))
        find = self.parts.__getitem__
        for word, part in plain.items():
            self.words[word] = find(part)
        for word, parts in cut.items():
            self.words[word] = b"".join(map(find, parts))
        long = {p for word, parts in cut.items() if len(word) > LONG for p in parts}
        long.update(part for word, part in plain.items() if len(word) > LONG)
        for part in long:
            if len(part) > LONG:
                del self.parts[part]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers; null has none."""
        split = [(t or "").encode("utf-8", "replace").split() for t in texts]
        out = []
        for at in range(0, len(split), 100):
            group = split[at : at + 100]
            new = set().union(*group).difference(self.words)
            if new:
                if len(self.words) + len(new) > WORDS_KEPT:
                    new = set().union(*group)  # the words kept so far make room
                self._learn(new)
            find = self.words.__getitem__
            out += [b"".join(map(find, words)) for words in group]
            for word in new:
                if len(word) > LONG:
                    del self.words[word]
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each worker and file."""
    return WordEncoder(path)
