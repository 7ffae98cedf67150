"""Repair of damaged conversations: faults, cheapest edits, repaired turns.

One range exchange puts all turns in order of (conversation, turn), so a
conversation that holds a third of all rows is spread over many tasks. Most
conversations lie whole within a range: their task parses and repairs them at
once. Of a conversation that a range cuts, each range gives a *stretch*: what it
would cost, and by which edits, to get from each parser state behind it to each
one in front of it. Stretches are small next to the turns; they are put together
by conversation, and only then are the cut conversations' turns read again.

Whether a text was seen earlier is decided before, on digests with map-side
aggregation; the first turn of each text is announced by a row in front of it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.shared import staged

from .frames import names_of, record_batch, shuffle_width
from .role_parser import ACCEPT, LEGAL, NAMES, joined, repair, repaired, transfers

BLANKS = " \t\n\v\f\r"
ENDINGS = ".!?"
#: A stretch ends after so many turns or characters of one conversation, which bounds a task's memory.
TURNS_HELD = 100_000
CHARS_HELD = 16_000_000

_COUNTS = "n_turns long, blank long, duplicate long, truncated long, illegal long"
_PLACES = "least_turn long, greatest_turn long, distinct_turns long, first_role string, last_role string"
_SCAN = f"conv_id long, part long, {_COUNTS}, {_PLACES}, cost long, audit string, repaired_sha256 string, stretch string"
_COSTED = f"conv_id long, gaps long, {_COUNTS}, cost long, audit string"
_TURNS = "conv_id long, position long, turn long, role string, text string, edit string"


def damage_turns(df: DataFrame) -> DataFrame:
    """Turns with faults put in by the crc32 of ``conv_id:turn`` modulo 20 (a null is written as a blank).

    0 drops the turn, 1 empties its text, 2 takes out its sentence ends, 3
    repeats it, 4 gives it the role user; null roles and texts become a blank.
    """

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    role, text = shown("role"), shown("text")
    return (
        df.select("conv_id", "turn", fault.alias("fault"), role.alias("role"), text.alias("text"))
        .where("fault <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("fault") == 1, "")
            .when(F.col("fault") == 2, F.translate("text", ENDINGS, ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.array_repeat(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


def _turns(df: DataFrame) -> DataFrame:
    """Turns with their place within one turn number, and what can be told of each alone."""
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    end = F.substring(bare, -1, 1)
    rows = df.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
    )
    return rows.select(
        "conv_id",
        "turn",
        F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"))).alias("tie"),
        F.when(bare == "", "b").when(end.isin(*ENDINGS), "-").otherwise("t").alias("state"),
        "role",
        "text",
    )


def _in_order(turns: DataFrame) -> DataFrame:
    """Turns by conversation, turn (nulls first) and tie, each first one of its text behind a row of state ``f``."""
    firsts = turns.groupBy("conv_id", "tie").agg(F.min(F.struct("turn")).alias("first"))
    none = F.lit(None).cast("string")
    announced = firsts.select(
        "conv_id", F.col("first.turn").alias("turn"), "tie", F.lit("f").alias("state"), none.alias("role"), none.alias("text")
    )
    rows = turns.unionByName(announced).withColumn("kind", (F.col("state") != "f").cast("int"))
    keys = ["conv_id", "turn", "tie"]
    ordered = rows.repartitionByRange(shuffle_width(turns), *keys).sortWithinPartitions(*keys, "kind")
    return ordered.select("conv_id", "turn", "state", "role", "text")


class _Stretch:
    """Turns of one conversation within a task, read in order."""

    def __init__(self, conv_id: int | None, whole: bool) -> None:
        self.conv_id, self.whole = conv_id, whole
        self.marks: list[str] = []
        self.texts: list[tuple[str, str]] | None = [] if whole else None
        self.chars = 0
        self.counts = {"b": 0, "d": 0, "t": 0, "-": 0}
        self.illegal = 0
        self.least = self.greatest = None
        self.distinct = 0
        self.first_role = self.last_role = ""

    def add(self, turn: int | None, state: str, role: str, text: str) -> None:
        self.counts[state] += 1
        initial = role[:1]
        if self.marks:
            self.illegal += self.last_role + initial not in LEGAL
        else:
            self.first_role = initial
        self.last_role = initial
        mark = initial if initial in NAMES else "x"
        self.marks.append("d" if state in "bd" else mark.upper() if state == "t" else mark)
        if turn is not None and turn != self.greatest:
            self.least = turn if self.least is None else self.least
            self.greatest = turn
            self.distinct += 1
        self.chars += len(text)
        if self.texts is not None:
            self.texts.append((role, text))
            if self.chars > CHARS_HELD:
                self.whole, self.texts = False, None

    def row(self, part: int) -> tuple:
        counts, marks = self.counts, "".join(self.marks)
        made = (None, None, None, json.dumps(transfers(marks)))
        if self.whole:
            cost, audit = repair(marks)
            made = (cost, audit, _digest(repaired(audit, self.texts)), None)
        return (
            self.conv_id, part, len(marks), counts["b"], counts["d"], counts["t"], self.illegal,
            self.least, self.greatest, self.distinct, self.first_role, self.last_role, *made,
        )


def _digest(turns) -> str:
    """sha256 of ``role:text`` lines."""
    digest, mark = hashlib.sha256(), b""
    for row, role, _ in turns:
        digest.update(mark + f"{role}:{row[1] if row else ''}".encode("utf-8", "surrogatepass"))
        mark = b"\n"
    return digest.hexdigest()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each whole conversation of the range, and one for each stretch of a cut one.

    The first and the last conversation may go on in a neighbouring range, so
    they are taken as cut.
    """
    names = names_of(_SCAN)
    part = TaskContext.get().partitionId() << 32
    held: _Stretch | None = None
    out: list[tuple] = []
    announced, first = False, True

    def close(whole: bool) -> None:
        nonlocal part
        held.whole = held.whole and whole
        out.append(held.row(part))
        part += 1

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("conv_id", "turn", "state", "role", "text")]
        for conv_id, turn, state, role, text in zip(*columns):
            if state == "f":
                announced = True
                continue
            if held is None:
                held = _Stretch(conv_id, whole=False)
            elif conv_id != held.conv_id:
                close(whole=not first)
                first = False
                held = _Stretch(conv_id, whole=True)
            elif len(held.marks) >= TURNS_HELD:
                close(whole=False)
                held = _Stretch(conv_id, whole=False)
            if not announced and state != "b":
                state = "d"
            announced = False
            held.add(turn, state, role, text)
        if out:
            yield record_batch(_SCAN, dict(zip(names, map(list, zip(*out)))))
            out = []
    if held is not None:
        close(whole=False)
        yield record_batch(_SCAN, dict(zip(names, map(list, zip(*out)))))


def _put_together(stretches: pa.Table) -> pa.Table:
    """Counts, cost and audit of one cut conversation, from its stretches."""
    rows = sorted(stretches.to_pylist(), key=lambda row: row["part"])
    behind = {0: (0, "")}
    for row in reversed(rows):
        table = json.loads(row["stretch"])
        behind = joined(behind, {int(s): {int(f): (c, a) for f, (c, a) in fronts.items()} for s, fronts in table.items()})
    cost, audit = behind[ACCEPT]
    made = {name: sum(row[name] for row in rows) for name in names_of(_COUNTS)}
    for before, after in zip(rows, rows[1:]):
        made["illegal"] += before["last_role"] + after["first_role"] not in LEGAL
    numbered = [row for row in rows if row["distinct_turns"]]
    distinct = sum(row["distinct_turns"] for row in numbered)
    distinct -= sum(before["greatest_turn"] == after["least_turn"] for before, after in zip(numbered, numbered[1:]))
    made["gaps"] = numbered[-1]["greatest_turn"] - numbered[0]["least_turn"] + 1 - distinct if numbered else 0
    made |= {"conv_id": rows[0]["conv_id"], "cost": cost, "audit": audit}
    return pa.Table.from_batches([record_batch(_COSTED, {name: [value] for name, value in made.items()})])


def _with_audits(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The turns of the conversations that ``audits`` names, in order, each behind its audit."""
    own = turns.alias("t").join(audits.select(F.col("conv_id").alias("named")), F.col("conv_id").eqNullSafe(F.col("named")), "left_semi")
    none = F.lit(None)
    heads = audits.select(
        "conv_id", none.cast("long").alias("turn"), none.cast("binary").alias("tie"), F.lit(0).alias("kind"),
        none.cast("string").alias("role"), F.col("audit").alias("text"),
    )
    rows = own.select("conv_id", "turn", "tie", F.lit(1).alias("kind"), "role", "text").unionByName(heads)
    placed = rows.repartition(shuffle_width(turns), "conv_id").sortWithinPartitions("conv_id", "kind", "turn", "tie")
    return placed.select("conv_id", "kind", "turn", "role", "text")


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator]]:
    """(conversation, its repaired turns) one after another; turns are read as they are asked for."""

    def rows():
        for batch in batches:
            yield from zip(*(batch[c].to_pylist() for c in ("conv_id", "kind", "turn", "role", "text")))

    stream = rows()

    def own(conv_id):
        """Turns up to the next conversation's head."""
        nonlocal head
        for row in stream:
            if row[1] == 0:
                head = row
                return
            yield row[3], row[4], row[2]

    head = next(stream, None)
    while head is not None:
        conv_id, _, _, _, audit = head
        head = None
        turns = own(conv_id)
        yield conv_id, repaired(audit, turns)
        for _ in turns:  # deleted ones at the end
            pass


def repair_conversations(df: DataFrame) -> DataFrame:
    """Faults, cost, edits and a digest of the repaired turns for each conversation.

    Turns (conv_id, turn, role, text) are taken by turn, nulls first, those of
    one number by a digest of role and text. A turn's first fault counts: blank,
    duplicate (role and text seen earlier), truncated (no sentence end). Keeping
    a turn costs 0, giving it another role 3, deleting it 4, putting one in 3;
    3 more for a truncated turn that stays; blank and duplicate turns have to
    go. ``audit`` has the initials of the cheapest edits that lead to the role
    grammar, of equal ones the ASCII-least; ``gaps`` is the number of missing
    turn numbers; ``illegal`` counts neighbours that the grammar forbids.

    Null roles and texts count as one blank. Null ids are one conversation.
    Repeated rows are duplicates. An empty table gives no rows; other columns
    are left out. Texts and conversations may have any length: a task holds
    100,000 turns or 16 million characters of one conversation at most; only its
    audit is one value.
    """
    turns = _turns(df)
    # Written once: whole and cut conversations are both taken from it.
    scanned = staged(_in_order(turns).mapInArrow(_scan, _SCAN))
    counts = names_of(_COUNTS)
    gaps = F.coalesce(F.col("greatest_turn") - F.col("least_turn") + 1 - F.col("distinct_turns"), F.lit(0))
    whole = scanned.where("stretch IS NULL").select(
        "conv_id", gaps.cast("long").alias("gaps"), *counts, "cost", "audit", "repaired_sha256"
    )
    cut = staged(scanned.where("stretch IS NOT NULL").groupBy("conv_id").applyInArrow(_put_together, _COSTED))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv_id, kept in _audited(batches):
            yield record_batch("conv_id long, repaired_sha256 string", {"conv_id": [conv_id], "repaired_sha256": [_digest(kept)]})

    digests = _with_audits(turns, cut).mapInArrow(digest, "conv_id long, repaired_sha256 string")
    named = digests.withColumnRenamed("conv_id", "named")
    whole_cut = cut.join(named, F.col("conv_id").eqNullSafe(F.col("named"))).drop("named")
    return whole.unionByName(whole_cut)


def repaired_turns(df: DataFrame) -> DataFrame:
    """The repaired turns themselves: conv_id, position (from 0), turn, role, text and edit.

    As `repair_conversations` decides; a turn put in has no number and an empty
    text. A conversation is put together in one task, which streams it.
    """
    found = repair_conversations(df).select("conv_id", "audit")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = names_of(_TURNS)
        held = []
        for conv_id, kept in _audited(batches):
            for position, (row, role, edit) in enumerate(kept):
                held.append((conv_id, position, row[2] if row else None, role, row[1] if row else "", edit))
                if len(held) == 1000:
                    yield record_batch(_TURNS, dict(zip(names, map(list, zip(*held)))))
                    held = []
        if held:
            yield record_batch(_TURNS, dict(zip(names, map(list, zip(*held)))))

    return _with_audits(_turns(df), found).mapInArrow(write, _TURNS)
