"""Quality rules: base counts and divergence from a language's usual text.

For each document two histograms are built: character classes of the whole
text, and common words (function words of all known languages, plus one bin for
every other word). The references are made of all documents of a language, each
counting once: the median share of each character class, which a minority of
junk can't move, and the mean share of each common word. A document is rejected when its Jensen-Shannon
distance to its language's reference is above a limit; a guard leaves out a
histogram of too few characters or words to be compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import with_fields

#: Function words by language.
COMMON_WORDS = {
    "de": (
        "der die und in zu den von das mit sich für des auf im ist nicht dem eine ein als auch es an "
        "werden aus er hat dass sie nach"
    ).split(),
    "en": (
        "the of and to a in is that for it on was with be as this by at are from an he or not have "
        "his but they which you"
    ).split(),
    "es": (
        "de la que el los se en y del un por las con una no para lo su es al como más pero sus le ya "
        "o este sí porque"
    ).split(),
    "fr": (
        "de la et le les des en un du une que est au pour dans qui par pas sur avec il ne se plus ce "
        "son je aux mais ou"
    ).split(),
}
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_CHAR_DISTANCE = 0.2
MAX_WORD_DISTANCE = 0.45
MIN_CHARS = 200
MIN_COMMON = 100

_BIN = {w: i + 1 for i, w in enumerate(sorted({w.encode() for words in COMMON_WORDS.values() for w in words}))}
_WORD_BINS = len(_BIN) + 1

# Character classes by byte: lower, upper, digit, blank, line end, sentence
# marks, other ASCII marks, symbols, control, start of a non-ASCII character.
# Continuation bytes fall into the last class, which is cut off.
_CHAR_BINS = 10
_CLASS = np.full(256, 6, np.uint8)
_CLASS[:32] = 8
for _text, _class in (
    ("abcdefghijklmnopqrstuvwxyz", 0),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1),
    ("0123456789", 2),
    (" \t", 3),
    ("\n\r", 4),
    (".,;:?'\"", 5),
    (SYMBOLS, 7),
):
    _CLASS[np.frombuffer(_text.encode(), np.uint8)] = _class
_CLASS[0x7F] = 8
_CLASS[0xC0:] = 9
_CLASS[0x80:0xC0] = _CHAR_BINS

_SCALE = 1_000_000  # shares are summed as integers, so sums don't depend on order
_LEVELS = 500  # steps of the square root of a share, for medians

BASE_FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
FIELDS = f"{BASE_FIELDS}, char_distance double, word_distance double, kept boolean"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)
    pairs = pd.factorize(ids[:-1] * n + ids[1:])[0].astype(np.int64)
    windows = pd.factorize(pairs[:-1] * n + ids[2:])[0]
    again = np.bincount(windows)[windows] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


def histograms(text: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by character class and by common word (bin 0: every other word)."""
    classes = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=_CHAR_BINS + 1)[:_CHAR_BINS]
    find = _BIN.get
    bins = np.fromiter((find(w, 0) for w in words), np.intp, len(words))
    return classes, np.bincount(bins, minlength=_WORD_BINS)


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of the rows of ``p`` to ``q``."""
    p, q = np.broadcast_arrays(p, q)
    middle = (p + q) / 2

    def against(x: np.ndarray) -> np.ndarray:
        ratio = np.divide(x, middle, out=np.ones_like(middle), where=(x > 0))
        return (x * np.log2(ratio)).sum(axis=-1)

    return np.sqrt(np.clip((against(p) + against(q)) / 2, 0, 1))


def _texts(column: pd.Series) -> Iterator[bytes]:
    for text in column:
        yield b"" if text is None else text.encode("utf-8", "surrogatepass")


def language_references(df: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Usual histograms of each known language over all its documents.

    Documents below the length guards are left out. The driver receives at most
    one row for each known language, class and level (20,000), and one for each
    language and common word.
    """
    known = sorted(COMMON_WORDS)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words_of: dict[str, np.ndarray] = {}
            levels_of: dict[str, np.ndarray] = {}
            for language, data in zip(batch.iloc[:, 0], _texts(batch.iloc[:, 1])):
                words = data.lower().split()
                if len(words) < MIN_COMMON or len(data) < MIN_CHARS:
                    continue
                classes, common = histograms(data, words)
                levels = (np.sqrt(classes / classes.sum()) * _LEVELS).astype(int)
                if language not in words_of:
                    words_of[language] = np.zeros(_WORD_BINS, np.int64)
                    levels_of[language] = np.zeros((_CHAR_BINS, _LEVELS + 1), np.int64)
                words_of[language] += common * _SCALE // common.sum()
                levels_of[language][np.arange(_CHAR_BINS), levels] += 1
            for language, sums in words_of.items():
                yield pd.DataFrame({"lang": language, "bin": np.arange(_WORD_BINS), "level": -1, "total": sums})
                bins, levels = levels_of[language].nonzero()
                yield pd.DataFrame(
                    {"lang": language, "bin": bins, "level": levels, "total": levels_of[language][bins, levels]}
                )

    rows = (
        df.select(F.col(f"`{lang}`").alias("l"), F.col(f"`{text}`").alias("t"))
        .where(F.col("l").isin(known))
        .mapInPandas(partial, "lang string, bin int, level int, total long")
        .groupBy("lang", "bin", "level")
        .agg(F.sum("total").alias("total"))
        .toPandas()
    )
    made = {}
    for language, own in rows.groupby("lang"):
        words = np.zeros(_WORD_BINS)
        common = own[own["level"] < 0]
        words[common["bin"]] = common["total"]
        counts = np.zeros((_CHAR_BINS, _LEVELS + 1))
        graded = own[own["level"] >= 0]
        counts[graded["bin"], graded["level"]] = graded["total"]
        half = np.cumsum(counts, axis=1) * 2 >= counts.sum(axis=1, keepdims=True)
        chars = (half.argmax(axis=1) / _LEVELS) ** 2
        made[language] = (chars / chars.sum(), words / words.sum())
    return made


def rate_quality(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """``df`` with the base counts, both distances and ``kept``.

    Words are runs of anything but ASCII white space. A null text counts as one
    without words. ``base_failed``: fewer than 50 words, or over half of them in
    repeated three-word windows. ``kept`` is false then, else true unless a
    distance is over its limit. A distance is null below its guard (200
    characters, 100 words) or if no reference exists. A null or unknown
    language is compared with every reference and takes the nearest. Rows are
    rated one by one: repeated rows get equal results, an empty table gives an
    empty one, input columns named like a result are replaced.
    """
    known = language_references(df, text, lang)
    order = sorted(known)
    char_refs = np.array([known[k][0] for k in order]).reshape(len(order), _CHAR_BINS)
    word_refs = np.array([known[k][1] for k in order]).reshape(len(order), _WORD_BINS)
    place = {k: i for i, k in enumerate(order)}
    schema = T._parse_datatype_string(FIELDS)

    @F.pandas_udf(schema)
    def rate(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
        rows, chars, commons = [], [], []
        for data in _texts(texts):
            words = data.split()
            classes, common = histograms(data, data.lower().split())
            repeats = repeated_words(words)
            rows.append(
                (
                    len(words),
                    len(b"".join(words).decode("utf-8", "surrogatepass")),
                    int(classes[7]),
                    repeated_lines(data),
                    repeats,
                    len(words) < MIN_WORDS or 100 * repeats > 50 * len(words),
                )
            )
            chars.append(classes)
            commons.append(common)
        out = pd.DataFrame(rows, columns=schema.names[:6])
        for name, counted, refs, least in (
            ("char_distance", chars, char_refs, MIN_CHARS),
            ("word_distance", commons, word_refs, MIN_COMMON),
        ):
            counts = np.array(counted, float).reshape(len(rows), -1)
            total = counts.sum(axis=1)
            values = np.full(len(rows), np.nan)
            if order and len(rows):
                all_of = _distance((counts / np.maximum(total, 1)[:, None])[:, None, :], refs[None])
                own = np.array([place.get(x, -1) for x in langs])
                values = np.where(own >= 0, all_of[np.arange(len(rows)), own], all_of.min(axis=1))
                values[total < least] = np.nan
            out[name] = values
        far = (out["char_distance"] > max_char_distance) | (out["word_distance"] > max_word_distance)
        out["kept"] = ~out["base_failed"].astype(bool) & ~far
        return out.astype(object).where(out.notna(), None)

    return with_fields(df, rate(F.col(f"`{text}`"), F.col(f"`{lang}`")), schema.names)


def keep_good(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows that pass, with the columns they had."""
    held = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"),
        F.col(f"`{text}`").alias("__text"),
        F.col(f"`{lang}`").alias("__lang"),
    )
    return rate_quality(held, "__text", "__lang").where("kept").select("__row.*")
