"""How a published table is put together: parts by key hash, each from the run that wrote it."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import quoted

PART = "__part"
#: Characters of one property; some catalogs refuse more than 4,000.
_CHUNK = 3500
_PREFIX = "tidemark.layout."
#: Rows of one part that a task may hold in memory to look keys up in.
HASHED_ROWS = 200_000
#: So few rows in all that Spark broadcasts them by itself.
_BROADCAST_ROWS = 1000


@dataclass(frozen=True)
class Part:
    """Where a part's rows are, how many there are, their highest mark, and further counts."""

    run: str
    rows: int
    mark: str | None = None
    #: What the layout's ``counted`` names, in its order; None if that was not counted.
    counts: tuple[int, ...] | None = None


@dataclass(frozen=True)
class Layout:
    """The manifest of a table. A part that is not listed is empty.

    A part may have a patch: rows of a later run that stand in for the part's own
    rows of equal keys, and new ones. The facts of a part count what is left.
    """

    count: int
    part_by: tuple[str, ...]
    parts: Mapping[int, Part] = field(default_factory=dict)
    #: Runs whose rows carry a verdict; only those without one are shown.
    judged: frozenset[str] = frozenset()
    #: Digest of the measures that ``Part.counts`` holds.
    counted: str = ""
    #: By part: the run that holds its patch, and how many rows that has.
    patches: Mapping[int, tuple[str, int]] = field(default_factory=dict)
    #: Keys of the patches; rows with a NULL in them replace nothing.
    patch_keys: tuple[str, ...] = ()

    def place(self) -> Column:
        """The part of a row. Equal keys of equal types are in the same part of every table."""
        return part_of(self.part_by, self.count)

    def runs(self, parts: Iterable[int] | None = None) -> dict[str, list[int]]:
        """The parts (all, or those asked for) by the runs that hold them or their patches."""
        found: dict[str, list[int]] = {}
        for part in self._listed(parts):
            for run in self._run(part):
                found.setdefault(run, []).append(part)
        return found

    def pieces(self, parts: Iterable[int] | None = None) -> dict[tuple[str, str | None], list[int]]:
        """The parts (all, or those asked for) by their own run and that of their patch, if any."""
        found: dict[tuple[str, str | None], list[int]] = {}
        for part in self._listed(parts):
            patch = self.patches.get(part, (None, 0))[0]
            found.setdefault((self.parts[part].run, patch), []).append(part)
        return found

    def hashed(self, parts: Iterable[int] | None = None) -> bool:
        """Whether a task can hold the keys of its part's patch in memory (see `may_be_hashed`)."""
        return may_be_hashed([self.patches[part][1] for part in self._listed(parts) if part in self.patches])

    def patch_pieces(self, parts: Iterable[int] | None = None) -> dict[str, list[int]]:
        """The patched parts (all, or those asked for) by the run of the patch."""
        found: dict[str, list[int]] = {}
        for part in self._listed(parts):
            if part in self.patches:
                found.setdefault(self.patches[part][0], []).append(part)
        return found

    def patched_since(self, newer: Layout, parts: Iterable[int]) -> bool:
        """Whether in each of these parts a newer layout differs from this one by its patch alone."""
        listed = list(parts)
        same = all(
            part in newer.patches and part in self.parts and self.parts[part].run == newer.parts[part].run
            for part in listed
        )
        before = any(part in self.patches for part in listed)
        return bool(listed) and same and not (before and self.patch_keys != newer.patch_keys)

    def _listed(self, parts: Iterable[int] | None) -> list[int]:
        return sorted(self.parts if parts is None else set(parts) & set(self.parts))

    def replaced(
        self, touched: Iterable[int], written: Mapping[int, Part], judged: bool = False, counted: str = ""
    ) -> Layout:
        """The layout after a run has written the touched parts anew.

        ``counted`` is the digest of what the run counted. Counts of other
        measures can't be added to these, so parts that have such lose them.
        """
        gone = set(touched)
        kept = {part: held for part, held in self.parts.items() if part not in gone}
        if counted != self.counted:
            kept = {part: replace(held, counts=None) for part, held in kept.items()}
        parts = {**kept, **written}
        live = {held.run for held in parts.values()}
        marked = self.judged | ({held.run for held in written.values()} if judged else set())
        patches = {part: patch for part, patch in self.patches.items() if part in kept and part not in written}
        keys = self.patch_keys if patches else ()
        return Layout(self.count, self.part_by, parts, frozenset(marked & live), counted, patches, keys)

    def patched(self, run: str, rows: Mapping[int, int], keys: Sequence[str]) -> Layout:
        """The layout after a run has written patches of so many rows by part, with all that earlier ones had.

        What the facts of these parts count has changed; see `with_facts`. Rows
        for a part that was empty are that part.
        """
        parts = {**self.parts, **{part: Part(run, n) for part, n in rows.items() if part not in self.parts}}
        patches = {**self.patches, **{part: (run, n) for part, n in rows.items() if part in self.parts}}
        return replace(self, parts=parts, patches=patches, patch_keys=tuple(keys))

    def with_facts(self, facts: Mapping[int, Part], counted: str) -> Layout:
        """The same parts with other facts for some."""
        changed = {part: replace(held, run=self.parts[part].run) for part, held in facts.items()}
        kept = self.parts
        if counted != self.counted:
            kept = {part: replace(held, counts=None) for part, held in kept.items()}
        return replace(self, parts={**kept, **changed}, counted=counted)

    def differing(self, other: Layout) -> set[int]:
        """Parts that not both layouts have from the same runs. Both must be split alike."""
        every = set(self.parts) | set(other.parts)
        return {p for p in every if self._run(p) != other._run(p)}

    def split_like(self, other: Layout | None) -> bool:
        return other is not None and (self.count, self.part_by) == (other.count, other.part_by)

    def _run(self, part: int) -> tuple[str, ...]:
        """The runs that make up a part: its own, that of its patch."""
        held, patch = self.parts.get(part), self.patches.get(part)
        return (*((held.run,) if held else ()), *(patch[:1] if patch else ()))

    def without_facts(self) -> Layout:
        """The same parts and runs, without counts and marks."""
        bare = {part: Part(held.run, 0) for part, held in self.parts.items()}
        return replace(self, parts=bare, counted="")

    def to_json(self) -> str:
        runs = {
            run: {str(p): [held.rows, held.mark, held.counts] for p, held in self.parts.items() if held.run == run}
            for run in sorted({held.run for held in self.parts.values()})
        }
        made = {"count": self.count, "by": list(self.part_by), "runs": runs, "judged": sorted(self.judged)}
        if self.patches:
            made["patches"] = {
                run: {str(p): self.patches[p][1] for p in parts} for run, parts in self.patch_pieces().items()
            }
            made["keys"] = list(self.patch_keys)
        return json.dumps(made | {"counted": self.counted}, separators=(",", ":"))

    @classmethod
    def from_json(cls, text: str) -> Layout:
        made = json.loads(text)
        parts = {
            int(p): Part(run, rows, mark, None if counts is None else tuple(counts))
            for run, held in made["runs"].items()
            for p, (rows, mark, counts) in held.items()
        }
        patches = {int(p): (run, rows) for run, held in made.get("patches", {}).items() for p, rows in held.items()}
        judged, keys = frozenset(made["judged"]), tuple(made.get("keys", ()))
        return cls(made["count"], tuple(made["by"]), parts, judged, made["counted"], patches, keys)

    def to_properties(self) -> dict[str, str]:
        return in_chunks(_PREFIX, self.to_json())

    @classmethod
    def from_properties(cls, properties: Mapping[str, str]) -> Layout | None:
        text = from_chunks(_PREFIX, properties)
        return None if text is None else cls.from_json(text)


def in_chunks(prefix: str, text: str) -> dict[str, str]:
    """A text as properties, none of them too long."""
    return {f"{prefix}{n:06d}": text[at : at + _CHUNK] for n, at in enumerate(range(0, len(text), _CHUNK))}


def from_chunks(prefix: str, properties: Mapping[str, str]) -> str | None:
    chunks = sorted(k for k in properties if k.startswith(prefix))
    return "".join(properties[k] for k in chunks) if chunks else None


def part_of(columns: Iterable[str], count: int) -> Column:
    return F.pmod(F.hash(*[quoted(c) for c in columns]), F.lit(count))


def rows_by_part(df: DataFrame, layout: Layout) -> dict[int, int]:
    """How many rows of ``df`` lie in which part: one number for each part at most."""
    return {row[0]: row[1] for row in df.groupBy(layout.place().alias(PART)).count().collect()}


def parts_touched(df: DataFrame, layout: Layout) -> list[int]:
    """The parts in which the rows of ``df`` lie."""
    return sorted(rows_by_part(df, layout))


def may_be_hashed(rows: Iterable[int]) -> bool:
    """Whether so many rows of single parts are better looked up in memory than sorted with the table."""
    listed = list(rows)
    return sum(listed) > _BROADCAST_ROWS and max(listed) <= HASHED_ROWS
