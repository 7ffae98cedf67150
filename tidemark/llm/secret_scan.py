"""Secrets in texts: all rules scanned in one byte pass of a combined automaton.

Matches are those that a regex search gives for each rule alone: leftmost, as
long as possible, not overlapping within a rule, too short ones dropped. All
rules are built so that the end of a match follows from the bytes after its
start: a match ends where a maximal stretch of accepting positions ends. What
follows a match and belongs to it (the body of a private key) is read on from
there by an automaton of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .automaton import Automaton
from .frames import with_fields


class Rule(NamedTuple):
    kind: str
    pattern: str
    least: int  # characters of the match; for assignments, of the value
    any_case: bool = False
    tail: str = ""  # what belongs to the match if it follows


_DASHES, _KEY = "----(-|\\x20)", r"([A-Z0-9]+ )*PRIVATE KEY( BLOCK)?(-|\x20)----"
_LINE_END = r"(\x0d?\x0a|\\r\\n|\\n)"
_BASE64 = "[A-Za-z0-9+/]"
_KEY_FIELDS = rf"([\x20\x09]*{_LINE_END}[\x20\x09>#*|]*[A-Za-z0-9-]+:[\x20-\x7e\x09]*)*"  # Proc-Type, DEK-Info, Comment
_BETWEEN = r"""([\x20\x09\x0d\x0a"'+>#*|,;]|\\[nrt])"""  # quoted, commented and escaped keys, too
_PAD = r"""[\x20\x09"'+>#*|,;]"""
_LINE = rf"{_PAD}*{_LINE_END}{_PAD}*(=?[A-Za-z0-9+/._]+=?=?)?"  # a line has no blank between its letters, unlike prose
_LONG_RUN = rf"{_BASE64}{{24}}{_BASE64}*"
#: A private key behind its first line: lines or long runs of base64 up to the last line, or without one the long runs.
_KEY_BODY = (
    rf"{_KEY_FIELDS}({_LINE}|{_PAD}*{_LONG_RUN})*({_PAD}*{_BASE64}*==?)?({_LINE})*{_PAD}*{_DASHES}END {_KEY}"
    rf"|{_KEY_FIELDS}({_BETWEEN}*{_LONG_RUN})+({_BETWEEN}*{_BASE64}*==?)?"
)

#: The rules, in the order in which spans at one place are listed.
#: The run of hex digits has part of its least length in the pattern, since short
#: runs are everywhere; every other rule is rare before its length is known.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        6,
        any_case=True,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]{6}[0-9a-f]*", 24),
    Rule("github", "gh[oprsu]_[A-Za-z0-9]+", 40),
    Rule("google", "AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 60),
    Rule("private_key", f"{_DASHES}BEGIN {_KEY}", 27, tail=_KEY_BODY),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]+", 24),
)
BASE_KINDS = ("assign", "access", "hex")
FIELDS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
MASK = "[secret]"


def _value_length(match: bytes) -> int:
    """Characters of an assignment's value: what follows the sign, blanks and quote."""
    at = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    rest = match[at + 1 :].lstrip(b" ")
    return len(rest) - (rest[:1] in (b'"', b"'"))


def listed(spans: Sequence[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


class Scanner:
    """Compiled rules. Compile once, on the driver; tasks receive the arrays."""

    def __init__(self, rules: Sequence[Rule] = RULES) -> None:
        self.rules = tuple(rules)
        self.forwards = Automaton([(r.pattern, r.any_case) for r in rules])
        self.backwards = [Automaton([(r.pattern, r.any_case)], anywhere=False, backwards=True) for r in rules]
        self.tails = [Automaton([(r.tail, False)], anywhere=False) if r.tail else None for r in rules]

    def find(self, text: str | None) -> list[tuple[int, int, str]]:
        """(start, end, kind) in code points, by start, then order of the rules."""
        if not text:
            return []
        data = text.encode("utf-8", "surrogatepass")
        stretches = self.forwards.stretches(data, len(self.rules))
        if not any(stretches):
            return []
        spans = []
        for number, (rule, own) in enumerate(zip(self.rules, stretches)):
            bound = 0
            for end in own:
                start = self.backwards[number].first_start(data, end, bound)
                if start is None:
                    continue
                if (tail := self.tails[number]) is not None:
                    end = tail.last_end(data, end)
                bound = end
                length = _value_length(data[start:end]) if rule.kind == "assign" else end - start
                if length >= rule.least:
                    spans.append((start, number, end))
        spans.sort()
        if len(data) != len(text):
            points, last, count = {}, 0, 0
            for at in sorted({at for start, _, end in spans for at in (start, end)}):
                count += len(data[last:at].decode("utf-8", "surrogatepass"))
                points[at], last = count, at
            spans = [(points[start], number, points[end]) for start, number, end in spans]
        return [(start, end, self.rules[number].kind) for start, number, end in spans]

    def mask(self, text: str | None) -> str | None:
        """``text`` with every stretch covered by spans replaced by one mask."""
        covered: list[list[int]] = []
        for start, end, _ in self.find(text):
            if covered and start <= covered[-1][1]:
                covered[-1][1] = max(covered[-1][1], end)
            else:
                covered.append([start, end])
        if not covered:
            return text
        parts, at = [], 0
        for start, end in covered:
            parts += [text[at:start], MASK]
            at = end
        return "".join([*parts, text[at:]])


def scan_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts of base kinds, their digest, and all spans as text.

    Null and empty texts have no spans: zero counts, the digest of an empty
    string and empty spans. Rows are scanned one by one, whole and alike; input
    columns named like a result are replaced.
    """
    schema = T._parse_datatype_string(FIELDS)
    scanner = Scanner()

    @F.pandas_udf(schema)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for value in texts:
            spans = scanner.find(value)
            base = [s for s in spans if s[2] in BASE_KINDS]
            digest = hashlib.sha256(listed(base).encode()).hexdigest()
            rows.append((*(sum(s[2] == kind for s in base) for kind in BASE_KINDS), digest, listed(spans)))
        return pd.DataFrame(rows, columns=schema.names)

    return with_fields(df, scan(F.col(f"`{text}`")), schema.names)


def redact_secrets(df: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``df`` with secrets masked in ``text``; ``n_chars``, if there, follows the new text."""

    scanner = Scanner()

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return pd.Series([scanner.mask(value) for value in texts], dtype=object)

    masked = df.withColumn(text, mask(F.col(f"`{text}`")))
    if n_chars and n_chars in df.columns:
        masked = masked.withColumn(n_chars, F.when(F.col(f"`{text}`").isNotNull(), F.char_length(F.col(f"`{text}`")).cast("long")))
    return masked.select(*[F.col(f"`{c}`") for c in df.columns])
