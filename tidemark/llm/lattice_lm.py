"""Document probability under a subword lattice.

A piece inventory with scores comes from an existing vocabulary file. Its
scores, which rank the pieces, give prior weights; counts of the pieces in the
training words turn them into probabilities. A text's probability is the sum
over all its segmentations into pieces. No piece reaches over a word's start,
so the forward recursion runs word by word: each distinct word of the corpus is
worked out once, and documents add up their words' values.

Words and counts grow with the corpus and stay distributed: documents' words
are joined to the word table. The few words that make up more than a set share
of all tokens are at most 1 / share many; they are sent to the tasks instead,
so no common word gathers in one task.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.shared import staged

from .frames import record_batch

FOLDS, HELD_OUT = 7, 2
FREQUENT_SHARE = 1 / 20_000  # so at most 20,000 frequent words
COUNT_GROUP = 1_000  # documents whose words are counted together before the exchange
PRIOR_WEIGHT = 20_000.0  # pseudo-counts that the vocabulary's own scores share out
START = "▁"  # how the vocabulary writes the start of a word
LOG10 = math.log(10)


class Lattice:
    """Log probabilities of pieces, and the forward recursion over a word."""

    def __init__(self, pieces: dict[str, float], byte_pieces: list[float], end: float) -> None:
        self.pieces, self.byte_pieces, self.end = pieces, byte_pieces, end
        self.longest = max(map(len, pieces), default=1)

    def word(self, word: str) -> float:
        """Log of the summed probability of all segmentations of a word."""
        text = START + word
        find, longest, bytes_of = self.pieces.get, self.longest, self.byte_pieces
        forward = [0.0]
        for end in range(1, len(text) + 1):
            terms = []
            for start in range(max(0, end - longest), end):
                piece = find(text[start:end])
                if piece is not None:
                    terms.append(forward[start] + piece)
            if find(text[end - 1]) is None:  # a character without a piece is written in bytes
                spelled = sum(bytes_of[b] for b in text[end - 1].encode("utf-8", "surrogatepass"))
                terms.append(forward[end - 1] + spelled)
            top = max(terms)
            forward.append(top + math.log(sum(math.exp(t - top) for t in terms)) if len(terms) > 1 else top)
        return forward[-1]


def _load(vocabulary: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary)


def _is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space


def count_words(documents: DataFrame) -> DataFrame:
    """(word, train, total): occurrences in training documents and in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch["doc_id"], batch["text"]
            for at in range(0, len(ids), COUNT_GROUP):
                train: Counter[bytes] = Counter()
                other: Counter[bytes] = Counter()
                for doc_id, text in zip(ids[at : at + COUNT_GROUP].to_pylist(), texts[at : at + COUNT_GROUP].to_pylist()):
                    (other if _is_held_out(doc_id) else train).update(_words(text))
                for counts, column in ((train, list(train.values())), (other, [0] * len(other))):
                    yield record_batch(_COUNTED, {"word": list(counts), "train": column, "total": list(counts.values())})

    counted = documents.mapInArrow(count, _COUNTED)
    return counted.groupBy("word").agg(F.sum("train").alias("train"), F.sum("total").alias("total"))


_COUNTED = "word binary, train long, total long"


def train_lattice(words: DataFrame, ends: int, vocabulary: str) -> Lattice:
    """Piece probabilities from the training words.

    Counts are of the vocabulary's own segmentation of each distinct word, times
    the word's count; the driver receives one row for each piece at most.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _load(vocabulary)
        counts: Counter[int] = Counter()
        for batch in batches:
            for word, times in zip(batch["word"].to_pylist(), batch["train"].to_pylist()):
                for piece in model.encode(word.decode("utf-8", "replace")):
                    counts[piece] += times
        yield record_batch("piece int, times long", {"piece": list(counts), "times": list(counts.values())})

    found = words.where("train > 0").select("word", "train").mapInArrow(count, "piece int, times long")
    times = {r["piece"]: r["times"] for r in found.groupBy("piece").agg(F.sum("times").alias("times")).collect()}

    model = _load(vocabulary)
    known, spelled = {}, {}
    for number in range(model.get_piece_size()):
        if model.is_control(number) or model.is_unknown(number) or model.is_unused(number):
            continue
        # Scores rank the pieces from 0 downwards: the usual prior of the r-th piece is 1 / (r + 1).
        weight = 1 / (1 + max(0.0, -model.get_score(number)))
        piece = model.id_to_piece(number)
        if model.is_byte(number):
            spelled[int(piece[3:-1], 16)] = (number, 1e-4)
        elif START not in piece[1:]:
            known[piece] = (number, weight)
    prior = PRIOR_WEIGHT / sum(w for _, w in (*known.values(), *spelled.values()))
    weights = {p: times.get(n, 0) + prior * w for p, (n, w) in known.items()}
    in_bytes = [times.get(spelled[b][0], 0) + prior * spelled[b][1] for b in range(256)]
    whole = sum(weights.values()) + sum(in_bytes) + ends + 1
    return Lattice(
        {p: math.log(w / whole) for p, w in weights.items()},
        [math.log(w / whole) for w in in_bytes],
        math.log((ends + 1) / whole),
    )


def _weigh_words(words: DataFrame, lattice: Lattice) -> DataFrame:
    fields = "word binary, train long, marginal double"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch["word"].to_pylist()
            marginal = [lattice.word(w.decode("utf-8", "replace")) / LOG10 for w in found]
            yield record_batch(fields, {"word": found, "train": batch["train"].to_pylist(), "marginal": marginal})

    return words.select("word", "train").mapInArrow(weigh, fields)


_SPREAD = (
    "row long, word binary, times long, doc_id long, held_out boolean, n_tokens long, n_known long, "
    "base_score double, score double, copies long"
)


def score_documents(df: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Log10 probability of every text under the lattice, and a word unigram's.

    Words are lower-cased (A-Z) and end at ASCII white space; each document has
    one end token. ``held_out`` documents (crc32 of the id as text, modulo 7, is
    2; a null id counts as an empty text) are scored but not learned from.
    ``base_score`` sums log10((c + 1) / (N + V + 1)) over the tokens, with a
    token's training count c, all training tokens N and distinct ones V.

    A null or empty text is just an end. Every input row gives a row, repeated
    rows included; other columns are left out; an empty table gives an empty one.
    """
    documents = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT
    words = staged(count_words(documents))
    ends = documents.where(~held_out).count()
    totals = words.agg(
        F.coalesce(F.sum("train"), F.lit(0)).alias("train"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"),
        F.count_if(F.col("train") > 0).alias("distinct"),
    ).first()
    n_train = totals["train"] + ends
    smooth = n_train + totals["distinct"] + (ends > 0) + 1
    lattice = train_lattice(words, ends, vocabulary)

    def base(count: int) -> float:
        return math.log10((count + 1) / smooth)

    least = max(1, math.ceil(totals["total"] * FREQUENT_SHARE))
    frequent = {
        bytes(r["word"]): (r["train"], r["marginal"])
        for r in _weigh_words(words.where(F.col("total") >= least), lattice).collect()
    }
    end_base, end_score = base(ends), lattice.end / LOG10

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each document a row with what its frequent words add, and a row for each rare word."""
        known = {w: (c > 0, base(c), m) for w, (c, m) in frequent.items()}
        for batch in batches:
            rows, ids, texts = (batch[c].to_pylist() for c in ("row", "doc_id", "text"))
            whole: dict[str, list] = {c: [] for c in ("n_tokens", "n_known", "base_score", "score")}
            rare: dict[str, list] = {"row": [], "word": [], "times": []}
            for row, value in zip(rows, texts):
                counts = Counter(_words(value))
                n_known, base_score, score = int(ends > 0), end_base, end_score
                for word, times in counts.items():
                    found = known.get(word)
                    if found:
                        n_known += times * found[0]
                        base_score += times * found[1]
                        score += times * found[2]
                    else:
                        rare["row"].append(row)
                        rare["word"].append(word)
                        rare["times"].append(times)
                for column, number in zip(whole.values(), (sum(counts.values()) + 1, n_known, base_score, score)):
                    column.append(number)
                if len(rare["row"]) > 100_000:
                    yield record_batch(_SPREAD, rare)
                    rare = {"row": [], "word": [], "times": []}
            yield record_batch(_SPREAD, rare)
            # The row's number stands in for a word, so that these rows spread as well.
            names = [row.to_bytes(8, "little", signed=True) for row in rows]
            yield record_batch(
                _SPREAD,
                whole
                | {"row": rows, "doc_id": ids, "word": names, "copies": [1] * len(rows), "held_out": [_is_held_out(i) for i in ids]},
            )

    numbered = documents.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    parts = numbered.mapInArrow(spread, _SPREAD)
    rare = F.col("copies").isNull()
    joined = parts.join(_weigh_words(words.where(F.col("total") < least), lattice), "word", "left").select(
        "row",
        *("doc_id", "held_out", "n_tokens", "copies"),
        F.when(rare, F.when(F.col("train") > 0, F.col("times")).otherwise(0)).otherwise(F.col("n_known")).alias("n_known"),
        F.when(rare, F.col("times") * F.log10((F.col("train") + 1) / F.lit(float(smooth))))
        .otherwise(F.col("base_score"))
        .alias("base_score"),
        F.when(rare, F.col("times") * F.col("marginal")).otherwise(F.col("score")).alias("score"),
    )
    # Equal rows share a number: their sums are divided by the copies, then the row is repeated.
    summed = joined.groupBy("row").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"),
        F.first("held_out", ignorenulls=True).alias("held_out"),
        F.first("n_tokens", ignorenulls=True).alias("n_tokens"),
        F.sum("copies").alias("copies"),
        F.sum("n_known").alias("n_known"),
        F.sum("base_score").alias("base_score"),
        F.sum("score").alias("score"),
    )
    return summed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base_score") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies")).alias("score"),
    )
