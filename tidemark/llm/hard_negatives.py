"""Hard negatives for anchors: different labels that score close below a positive.

Vectors become blocks of whole numbers. Every task holds one block of rows and
meets the anchors group by group, so all pairs are scored (a stated set of
queries against all rows) and none is written that can't matter: first the best
few positives of each; then, when an anchor's positives are known, the best few
negatives under each of them.

What is left is packed into keys (anchor, descending score, id) and put in order
by one secondary-sort shuffle. An iterator then reads each anchor's pairs once:
a positive opens a window, negatives fall into the windows that are open, and a
full or passed window closes. Nothing of an anchor is held but its open windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.shared import staged

from .frames import record_batch, shuffle_width

#: A component's scale; positives and negatives of an anchor; a negative's bounds in percent of the positive's score.
SCALE, POSITIVES, NEGATIVES, LEAST, MOST = 256, 5, 3, 50, 95
CELL_ROWS = 1_000_000  # rows that a task holds at most; 130 MB for 64 components of two bytes
LEAST_ROWS = 4_096  # cells are not made smaller than this to have more tasks
BLOCK_ROWS = 32_768  # rows that are computed with at once
GROUP = 256  # anchors that travel together
CELLS = 4_000_000  # scores that are computed at once

_BLOCK = "kind long, cell long, ids binary, labels binary, size long, width long, parts binary, bounds binary"
_PAIR = "anchor_id long, score long, vec_id long, positive boolean"
_FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_LIMIT = 2**63 - 1
_NONE = -_LIMIT - 1  # stands for no score
_KINDS = {2: "<i2", 4: "<i4", 8: "<f8"}


def usable_vectors(df: DataFrame, anchors: Column, vec_id: str, vector: str, label: str) -> DataFrame:
    """The rows that take part (nothing null, all components finite), and whether they are anchors."""
    rows = df.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
        F.col(f"`{label}`").cast("long").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    ).where("vec_id IS NOT NULL AND vector IS NOT NULL AND label IS NOT NULL")

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return rows.where(F.forall("vector", finite))


def _whole_numbers(vectors: list, width: int) -> np.ndarray:
    """Rows of floor(SCALE * x), in as few bytes as they fit; shorter vectors are filled with zeros."""
    made = np.zeros((len(vectors), width))
    for row, vector in zip(made, vectors):
        row[: len(vector)] = vector
    with np.errstate(over="ignore"):
        made = np.nan_to_num(np.floor(made * SCALE))
    greatest = np.abs(made).max(initial=0)
    return made.astype("<i2" if greatest < 2**15 else "<i4" if greatest < 2**31 else "<f8")


def _packer(kind: int, size: int):
    """Rows by (cell, id) to packed blocks of at most ``size`` rows; the first row of an id counts."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        last = None

        def block() -> pa.RecordBatch:
            width = max(1, *(len(r["vector"]) for r in held))
            columns = {
                "kind": [kind],
                "cell": [held[0]["cell"]],
                "ids": [np.array([r["vec_id"] for r in held], "<i8").tobytes()],
                "labels": [np.array([r["label"] for r in held], "<i8").tobytes()],
                "size": [len(held)],
                "width": [width],
                "parts": [_whole_numbers([r["vector"] for r in held], width).tobytes()],
            }
            if "scores" in held[0]:
                columns["bounds"] = [_padded([r["scores"] for r in held]).tobytes()]
            return record_batch(_BLOCK, columns)

        for batch in batches:
            for row in batch.to_pylist():
                here = (row["cell"], row["vec_id"])
                if here == last:
                    continue
                last = here
                if held and (len(held) == size or row["cell"] != held[0]["cell"]):
                    yield block()
                    held.clear()
                held.append(row)
        if held:
            yield block()

    return pack


def _padded(scores: list[list[int]]) -> np.ndarray:
    """Scores of each anchor's positives; missing ones are the least number, which has no window."""
    made = np.full((len(scores), POSITIVES), -_LIMIT, "<i8")
    for row, own in zip(made, scores):
        row[: len(own)] = own
    return made


class _Block:
    def __init__(self, row: dict) -> None:
        self.ids, self.labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
        kind = _KINDS[len(row["parts"]) // (row["size"] * row["width"])]
        self.parts = np.frombuffer(row["parts"], kind).reshape(row["size"], row["width"])
        self.greatest = float(np.abs(self.parts.astype("<f8")).max())
        self.low = self.high = None
        if row["bounds"] is not None:
            found = np.frombuffer(row["bounds"], "<i8").reshape(-1, POSITIVES).tolist()
            self.low = np.array([[-(-LEAST * p // 100) if p >= 0 else _LIMIT for p in own] for own in found], np.int64)
            self.high = np.array([[MOST * p // 100 if p >= 0 else -_LIMIT for p in own] for own in found], np.int64)


def _scores(anchors: np.ndarray, rows: np.ndarray, greatest: float) -> np.ndarray:
    """Exact inner products: doubles hold whole numbers to 2**53; beyond them long or Python numbers are used."""
    width = min(anchors.shape[1], rows.shape[1])
    anchors, rows = anchors[:, :width], rows[:, :width]
    if greatest * width < 2**53:
        return (anchors.astype("<f8") @ rows.astype("<f8").T).astype(np.int64)
    if greatest * width < 2**62:
        return anchors.astype(np.int64) @ rows.astype(np.int64).T
    exact = [[[int(x) for x in row] for row in side.tolist()] for side in (anchors, rows)]
    made = [[max(-_LIMIT, min(_LIMIT, sum(map(int.__mul__, a, b)))) for b in exact[1]] for a in exact[0]]
    return np.array(made, np.int64).reshape(len(anchors), len(rows))


def _best(scores: np.ndarray, wanted: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, places) of the best scores in turn, the first place among equal ones; takes them out of ``scores``."""
    every = np.arange(len(scores))
    for _ in range(min(wanted, scores.shape[1])):
        places = scores.argmax(axis=1)
        rows = np.flatnonzero(scores[every, places] > _NONE)
        if not len(rows):
            return
        yield rows, places[rows]
        scores[rows, places[rows]] = _NONE


Pairs = tuple[np.ndarray, np.ndarray, np.ndarray]  # the anchor's place in its group, score, id


def _positives(group: _Block, block: _Block) -> Iterator[Pairs]:
    """The best rows of each anchor's own label in a block."""
    for label in np.intersect1d(group.labels, block.labels).tolist():
        own, rows = np.flatnonzero(group.labels == label), np.flatnonzero(block.labels == label)
        for at in range(0, len(own), step := max(1, CELLS // len(rows))):
            some = own[at : at + step]
            scores = _scores(group.parts[some], block.parts[rows], group.greatest * block.greatest)
            left = np.where(group.ids[some][:, None] == block.ids[rows][None, :], _NONE, scores)
            for a, p in _best(left, POSITIVES):
                yield some[a], scores[a, p], block.ids[rows[p]]


def _negatives(group: _Block, block: _Block) -> Iterator[Pairs]:
    """The best rows of other labels in a block under each of an anchor's positives."""
    for at in range(0, len(group.ids), step := max(1, CELLS // len(block.ids))):
        some = slice(at, at + step)
        scores = _scores(group.parts[some], block.parts, group.greatest * block.greatest)
        scores[group.labels[some][:, None] == block.labels[None, :]] = _NONE
        taken = np.zeros(scores.shape, bool)
        for low, high in zip(group.low[some].T, group.high[some].T):
            inside = np.where((scores >= low[:, None]) & (scores <= high[:, None]), scores, _NONE)
            for a, p in _best(inside, NEGATIVES):
                taken[a, p] = True
        a, p = np.nonzero(taken)
        yield a + at, scores[a, p], block.ids[p]


def _first_of_each(anchors: np.ndarray, wanted: int, mask: np.ndarray) -> np.ndarray:
    """The first ``wanted`` places of each anchor that the mask has; places are in order of the anchor."""
    before = np.cumsum(mask) - mask
    starts = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
    base = np.repeat(before[starts], np.diff(np.r_[starts, len(anchors)]))
    return mask & (before - base < wanted)


def _merged(group: _Block, found: list[Pairs], positive: bool) -> Pairs:
    """What the blocks of a cell have found, cut down to the cell's own best."""
    anchors, scores, ids = map(np.concatenate, zip(*found))
    order = np.lexsort((ids, ~scores, anchors))  # ~x falls as x rises, and has no overflow
    anchors, scores, ids = anchors[order], scores[order], ids[order]
    if positive:
        kept = _first_of_each(anchors, POSITIVES, np.ones(len(anchors), bool))
    else:
        kept = np.zeros(len(anchors), bool)
        for low, high in zip(group.low[anchors].T, group.high[anchors].T):
            kept |= _first_of_each(anchors, NEGATIVES, (scores >= low) & (scores <= high))
    return anchors[kept], scores[kept], ids[kept]


def _compared(positive: bool):
    """A cell's blocks of rows (kind 0), then groups of anchors (kind 1): the pairs that may matter."""
    pick = _positives if positive else _negatives

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for batch in batches:
            for at in range(batch.num_rows):  # one by one: a block is some MB
                row = batch.slice(at, 1).to_pylist()[0]
                if row["cell"] != cell:
                    cell, held = row["cell"], []
                if row["kind"] == 0:
                    held.append(_Block(row))
                    continue
                group = _Block(row)
                found = [pairs for block in held for pairs in pick(group, block) if len(pairs[0])]
                if found:
                    anchors, scores, ids = _merged(group, found, positive)
                    yield record_batch(
                        _PAIR,
                        {"anchor_id": group.ids[anchors], "score": scores, "vec_id": ids, "positive": [positive] * len(ids)},
                    )

    return compare


def _packed(rows: DataFrame, cells: int, kind: int, size: int) -> DataFrame:
    """Packed blocks. A row's cell follows from its id, which spreads any label."""
    dealt = rows.withColumn("cell", F.pmod(F.xxhash64("vec_id"), F.lit(cells)))
    placed = dealt.repartitionById(cells, F.col("cell").cast("int"))
    return placed.sortWithinPartitions("cell", "vec_id", "label", "vector").mapInArrow(_packer(kind, size), _BLOCK)


def _scored(blocks: DataFrame, groups: DataFrame, cells: int, positive: bool) -> DataFrame:
    """Pairs of the rows of every cell with every group of anchors."""
    others = [c for c in groups.columns if c not in ("kind", "cell")]
    everywhere = groups.select("kind", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))).alias("cell"), *others)
    placed = blocks.unionByName(everywhere).repartitionById(cells, F.col("cell").cast("int"))
    return placed.sortWithinPartitions("cell", "kind").mapInArrow(_compared(positive), _PAIR)


def _in_order(pairs: DataFrame, parts: int):
    """Pairs by anchor in partitions, in order of (anchor, descending score, positives first, id)."""
    keys = pairs.rdd.map(lambda r: ((r[0], -r[1], not r[3], r[2]), None))
    return keys.repartitionAndSortWithinPartitions(parts, lambda key: crc32(b"%d" % key[0]))


def _first_positives(pairs) -> Iterator[tuple]:
    """The best positives of each anchor, from ordered pairs."""
    anchor, taken = None, 0
    for (own, score, _, vec_id), _ in pairs:
        taken = taken + 1 if own == anchor else 1
        anchor = own
        if taken <= POSITIVES:
            yield own, -score, vec_id, True


def _windows(pairs) -> Iterator[tuple]:
    """Rows of `_FOUND`, from ordered pairs."""
    anchor, opened = None, []
    for (own, score, negative, vec_id), _ in pairs:
        score = -score
        if own != anchor:
            anchor, opened = own, []
        if not negative:
            opened.append([score, vec_id, 0])
            continue
        opened = [w for w in opened if w[2] < NEGATIVES and LEAST * w[0] <= 100 * score]
        for window in opened:
            if 100 * score <= MOST * window[0]:
                window[2] += 1
                yield own, window[1], window[2], vec_id, window[0], score


def mine_hard_negatives(
    rows: DataFrame, anchors: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` says which rows are anchors. A row's score is the inner product
    of the vectors' floor(256 * x). An anchor's positives are its best 5 other
    rows of its label; its negatives under a positive are the best 3 of other
    labels that score 50 to 95 percent of it. Equal scores go by id.

    Rows with a null or a component that is not finite take no part; a shorter
    vector counts as filled with zeros. Of several rows of one id the first by
    label and vector counts. Scores beyond a long become its limits. Anchors
    without positives, and windows without negatives, give no rows; an empty
    table gives none. Other columns are left out.

    Every anchor meets every row, so scoring grows with their product. A task
    holds a million rows at most, the anchors stream by; exchanged are the rows
    once, the anchors once for each million rows, and for each of these at most
    5 positives and 15 negatives an anchor.
    """
    spark, width = rows.sparkSession, shuffle_width(rows)
    usable = usable_vectors(rows, anchors, vec_id, vector, label)
    count, chosen = usable.agg(F.count("*"), F.count_if("anchor")).first()
    cells = max(1, -(-count // CELL_ROWS), min(width, -(-count // LEAST_ROWS)))
    groups = max(1, min(width, -(-chosen // GROUP)))
    own = usable.where("anchor")

    blocks = staged(_packed(usable, cells, kind=0, size=BLOCK_ROWS))
    first = _scored(blocks, _packed(own, groups, kind=1, size=GROUP), cells, positive=True)
    positives = staged(spark.createDataFrame(_in_order(first, width).mapPartitions(_first_positives), _PAIR))

    known = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list("score").alias("scores"))
    bounded = _packed(own.join(known, "vec_id"), groups, kind=1, size=GROUP)
    second = _scored(blocks, bounded, cells, positive=False)
    ordered = _in_order(positives.unionByName(second), width)
    return spark.createDataFrame(ordered.mapPartitions(_windows), _FOUND)
