import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import conversation_repair as cr
from tidemark.llm.queries import llm_queries
from tidemark.llm.role_parser import ACCEPT, joined, parse, repair, transfers

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def moved(last, symbol):
    """The grammar as a plain table of followers."""
    return symbol if symbol in {"": "su", "s": "u", "u": "a", "a": "u"}[last] else None


def cheapest(marks):
    """(cost, audit) by trying all edits from the first turn on, whole audits kept."""

    def with_inserts(best):
        for _ in range(3):
            for last, (cost, audit) in list(best.items()):
                for symbol in "ua":
                    put(best, moved(last, symbol), cost + 3, audit + "I")
        return best

    def put(best, last, cost, audit):
        if last is not None and (last not in best or (cost, audit) < best[last]):
            best[last] = (cost, audit)

    best = with_inserts({"": (0, "")})
    for mark in marks:
        behind = {}
        for last, (cost, audit) in best.items():
            put(behind, last, cost + 4, audit + "D")
            if mark == "d":
                continue
            extra = 3 if mark.isupper() else 0
            if mark.lower() in "sua":
                put(behind, moved(last, mark.lower()), cost + extra, audit + "K")
            for symbol in "ua":
                put(behind, moved(last, symbol), cost + extra + 3, audit + "R")
        best = with_inserts(behind)
    return min(best[last] for last in ("", "a") if last in best)


def test_short_conversations_exhaustively():
    for size in range(5):
        for marks in itertools.product("suaxdSUAX", repeat=size):
            assert repair("".join(marks)) == cheapest(marks)


@settings(max_examples=300, deadline=None)
@given(st.text("suaxdSUAXuauauadd", max_size=60), st.lists(st.integers(0, 60), max_size=4))
def test_long_ones_whole_and_in_stretches(marks, cuts):
    expected = cheapest(marks)
    assert repair(marks) == expected
    cuts = [0, *sorted(min(c, len(marks)) for c in cuts), len(marks)]
    behind = {0: (0, "")}
    for start, end in reversed(list(zip(cuts, cuts[1:]))):
        behind = joined(behind, transfers(marks[start:end]))
    assert behind[ACCEPT] == expected


def test_a_turn_costs_the_same_everywhere():
    cost, audit = parse("s" * 30_000)[ACCEPT]
    assert len(audit) >= 30_000 and cost == 3 * 30_000 + audit.count("D") - 3 * audit.count("K")


def expected_rows(rows):
    """Brute force over (conv_id, turn, role, text) without nulls in role and text."""
    made = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, _tie(r)))
        seen, marks, counts = set(), "", {"b": 0, "d": 0, "t": 0}
        for _, _, role, text in own:
            bare = text.rstrip(WHITE)
            fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            marks += "d" if fault in ("b", "d") and fault else initial.upper() if fault == "t" else initial
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = cheapest(marks)
        lines, at, last = [], 0, ""
        for edit in audit:
            role, text = own[at][2:] if edit != "I" else ("", "")
            at += edit != "I"
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if last == "u" else "user"
            last = role[:1]
            lines.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        made[conv] = (gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit, digest)
    return made


def _tie(row):
    return hashlib.md5(f"{len(row[2])}:{row[2]}:{row[3]}".encode()).digest()


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found_rows(df):
    rows = cr.repair_conversations(df).collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}


def made_up(seed, conversations, turns):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " \t", "Why? ", "Ünder", "ok!\n", "long " * 50 + "."]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, turns)):
            if rng.random() < 0.9:
                role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
                text = rng.choice(texts) if rng.random() < 0.4 else f"Text {rng.random()}."
                rows += [(conv if conv else None, turn if rng.random() < 0.9 else None, role, text)] * rng.choice([1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("held", [3, 100_000])
def test_frames_against_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(cr, "TURNS_HELD", held)
    rows = made_up(3, 60, 12)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found_rows(df) == expected_rows(rows)


def test_one_conversation_with_most_rows(spark):
    """A conversation that several ranges cut."""
    rows = [(7, t, "user" if t % 2 else "assistant", f"Turn {t % 50}." if t % 3 else f"t {t}") for t in range(3000)]
    rows += made_up(5, 8, 5)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert found_rows(df) == expected_rows(rows)


def test_nulls_empty_tables_and_other_columns(spark):
    rows = [(1, 0, None, "a."), (1, 1, "user", None), (1, None, None, None), (None, None, "user", "Hi.")]
    plain = [(c, t, r or " ", x or " ") for c, t, r, x in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found_rows(df.selectExpr("*", "1 AS cost", "2 AS audit", "3 AS tie")) == expected_rows(plain)
    assert found_rows(df.limit(0)) == {}
    assert cr.repaired_turns(df.limit(0)).count() == 0


def test_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(cr, "CHARS_HELD", 1000)
    rows = [(c, t, "ua"[t % 2] and ("user", "assistant")[t % 2], f"{c} {t} " + "word " * 30_000 + ".") for c in range(3) for t in range(4)]
    assert found_rows(spark.createDataFrame(rows, SCHEMA)) == expected_rows(rows)


def test_repaired_turns(spark):
    rows = [
        (1, 0, "assistant", "Hello."), (1, 1, "user", "Hi."), (1, 2, "user", ""), (1, 3, "user", "More?"), (1, 4, "assistant", "Yes."),
        (2, 0, "user", ""), (3, 0, "tool", "Well."),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    found = sorted(tuple(r) for r in cr.repaired_turns(df).where("conv_id = 1").drop("conv_id").collect())
    audit = next(r["audit"] for r in cr.repair_conversations(df).collect() if r["conv_id"] == 1)
    assert len(found) == len(audit) - audit.count("D")
    assert [r[0] for r in found] == list(range(len(found)))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[2][0] for r in found))
    lines = "\n".join(f"{r[2]}:{r[3]}" for r in found)
    digest = next(r["repaired_sha256"] for r in cr.repair_conversations(df).collect() if r["conv_id"] == 1)
    assert hashlib.sha256(lines.encode()).hexdigest() == digest
    assert all((r[1] is None) == (r[4] == "I") for r in found)


def damaged(rows):
    made = []
    for conv, turn, role, text in rows:
        shown = [" " if v is None else v for v in (conv, turn, role, text)]
        fault = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", shown[3]) if fault == 2 else shown[3]
        role = "user" if fault == 4 else shown[2]
        made += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return made


def test_damage(spark):
    rows = [(c, t, None if c == 3 else "assistant", None if c == 4 else "A. b! c?") for c in (None, 1, 3, 4) for t in (None, *range(40))]
    found = cr.damage_turns(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, damaged(rows)))


def test_query_on_given_conversations(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = expected_rows(damaged(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = llm_queries()["op12_conversation_repair"](spark, folder)
    assert found.columns == ["conv_id", *COLUMNS]
    made = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in found.collect()}
    assert made == {conv: expected.get(conv, nothing) for conv in {r[0] for r in rows}}
