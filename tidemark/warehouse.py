"""Published tables of the four layers.

Plain Spark tables cannot be overwritten while they are read and reject MERGE,
so a table here is a view over immutable tables, each written by one run: a run
writes a new one, then repoints the view. A failed write leaves the old state
published.

A keyed table is split into parts by a hash of its key. The view's properties
hold its layout: which run wrote each part. A merge writes only the parts that
its changes fall into; all others stay as they are, in the files of earlier
runs. If it changes few rows of its parts, it writes only these, as patches: readers
leave out a part's own rows of the keys that its patch has. On request a run also counts NULLs and failed checks in what it writes, by
part, so that a table's profile is known without reading it.

The parts are Spark's own hash partitions of the key, and runs are written
bucketed by it. So tables of one key and as many parts meet, are grouped and are
written again without an exchange; only rows from elsewhere are shuffled, once.

Catalogs with row-level operations use ``MergeWarehouse`` instead, which
changes tables in place.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tidemark import shared
from tidemark.functions.columns import all_not_null, quoted
from tidemark.layout import PART, Layout, Part, from_chunks, in_chunks, may_be_hashed, parts_touched, rows_by_part
from tidemark.operators.profiling import faults, one_pass
from tidemark.operators.quality import REASON, accepted, rejected
from tidemark.operators.upsert import KNOWN, SchemaMismatch, aligned, effective, marked, upsert, with_keys, without_keys
from tidemark.operators.watermark import Watermark, latest_mark, mark_text, read_watermark, text_is_ordered
from tidemark.shared import new_folder, staged

LAYERS = ("bronze", "silver", "quarantine", "gold")
#: Runs that a table may consist of; a merge beyond that also rewrites the parts of the smallest ones.
RUNS_KEPT = 16
#: Largest share of patches in the rows of the parts that a merge touches; beyond it the parts are written anew.
PATCH_SHARE = 1 / 8
#: A run's table: the published table, when the run began (seconds, in hex), a random number.
RUN_NAME = re.compile(r"(.+)__([0-9a-f]{8})[0-9a-f]{8}")
_ROWS = "tidemark.rows"
_MARK = "tidemark.mark."
_SNAPSHOT = "tidemark.snapshot"
_BUILT = "tidemark.built."
_PROFILE = "tidemark.profile."
_COUNT = "tidemark.count."
_RETIRED = "tidemark.retired."
#: Off, unless the session says otherwise: tables split by a part of the key (an order's
#: lines) meet as they are, and unions of them keep the split that their scans have.
CO_PARTITIONED = (
    "spark.sql.requireAllClusterKeysForCoPartition",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled",
)
_FILES = {"compression": "zstd"}


@dataclass(frozen=True)
class Published:
    """What one write put in place, measured on what was written."""

    name: str
    rows: int


@dataclass(frozen=True)
class Arriving:
    """Rows of a merge's source that fall into one part."""

    rows: int
    #: Those that the part lacks, by `KNOWN`; None if the source does not tell.
    inserts: int | None = None
    #: Whether each of the others stands for exactly one row of the part.
    one_each: bool = False
    mark: str | None = None


class Warehouse:
    """Views in the session catalog over the tables that runs have written.

    ``root``      folder for the schemas (the catalog's default if not given).
    ``namespace`` prefix of the schema names, e.g. ``"shop_"``, or ``"shop."``
                  for a catalog with nested names.
    ``parts``     into how many parts keyed tables are split when they are first
                  written (default: the session's number of shuffle partitions).
    ``checks``    named predicates (Spark SQL) by table. If given, even if empty,
                  each write counts the NULLs of all columns and the rows that a
                  check of the table flags, for `profile`.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        namespace: str = "",
        parts: int | None = None,
        checks: Mapping[str, Mapping[str, str]] | None = None,
    ) -> None:
        self.spark = spark
        for setting in CO_PARTITIONED:
            if spark.conf.get(setting, None) is None:
                spark.conf.set(setting, "false")
        self.checks = checks
        self.root = root
        self.namespace = namespace
        self.parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        for layer in LAYERS:
            where = f" LOCATION '{root}/{layer}'" if root else ""
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema(layer)}{where}")

    def schema(self, layer: str) -> str:
        return f"{self.namespace}{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.schema(layer)}.{table}"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def rows(self, layer: str, table: str) -> int:
        """Rows of a published table, as counted when they were written."""
        return int(self._properties(layer, table)[_ROWS])

    def watermark(self, layer: str, table: str, column: str) -> Watermark | None:
        """Mark recorded when the table was published; scans only if there is none."""
        df = self.read(layer, table)
        text = self._properties(layer, table).get(_MARK + column)
        if text is None:
            return read_watermark(df, column)
        return Watermark(column, df.schema[column].dataType.simpleString(), text)

    # -- writing ------------------------------------------------------------------

    def overwrite(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        mark: str | None = None,
        schema_may_change: bool = False,
        part_by: Sequence[str] = (),
        count: int | None = None,
    ) -> Published:
        """Replace the content. Without ``schema_may_change`` other columns or types fail.

        With ``part_by`` the table is split into ``count`` parts by a hash of these
        columns, which must be key columns of every merge into it.
        """
        if not schema_may_change and self.exists(layer, table):
            check_same_schema(df, self.read(layer, table))
        if not part_by:
            return self._publish(layer, table, df, mark)
        layout = Layout(count or self.parts, tuple(part_by))
        run, written = self._write_run(layer, table, df, layout, mark)
        layout = layout.replaced((), written, counted=self._counted(table, df.columns)[0])
        return self._point_to_parts(layer, table, layout, run, df, mark)

    def overwrite_judged(
        self,
        layer: str,
        table: str,
        rows: DataFrame,
        mark: str | None,
        keep_rejected: Callable[[DataFrame], None],
        part_by: Sequence[str] = (),
    ) -> Published:
        """Replace the content with the accepted rows, after keeping the rejected ones.

        One evaluation and one write: the run's table holds all judged rows and
        the published view leaves the rejected out. The filter on the verdict
        column is pushed to the scan. ``keep_rejected`` is given the rejected
        rows before the view appears, so a run that dies in between is repeated
        in full and loses none of them.
        """
        shown = accepted(rows)
        if self.exists(layer, table):
            check_same_schema(shown, self.read(layer, table))
        if not part_by:
            snapshot, facts = self._write_snapshot(layer, table, rows, mark, judged=True)
            keep_rejected(rejected(self.spark.table(self.name(layer, snapshot))))
            return self._point(layer, table, snapshot, facts, shown.columns, where=f"{REASON} IS NULL")
        layout = Layout(self.parts, tuple(part_by))
        run, written = self._write_run(layer, table, rows, layout, mark, judged=True)
        keep_rejected(rejected(self.spark.table(self.name(layer, run)).drop(PART)))
        layout = layout.replaced((), written, judged=True, counted=self._counted(table, shown.columns)[0])
        return self._point_to_parts(layer, table, layout, run, shown, mark, judged=True)

    def staged(self, layer: str, table: str, df: DataFrame, part_by: Sequence[str] = ()) -> DataFrame:
        """Write the rows once, split like a published table, and read them back (see `shared.staged`).

        What is joined to the table after that is not shuffled, nor is the table.
        Until there is one, ``part_by`` tells how it will be split.
        """
        layout = self.layout(layer, table) or (Layout(self.parts, tuple(part_by)) if part_by else None)
        if layout is None:
            return staged(df)
        # Only a table tells its readers how it is split. Its entry in the catalog
        # goes at once, its files are those of any staged folder.
        name = self.name(layer, _run_name(table))
        writer = _split(df, layout).write.format("parquet").options(**_FILES)
        writer = writer.bucketBy(layout.count, *layout.part_by).option("path", new_folder(self.spark, "staged"))
        writer.saveAsTable(name)
        rows = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return rows

    def changes(
        self,
        layer: str,
        table: str,
        source: DataFrame,
        keys: Sequence[str],
        null_safe: bool = False,
        source_is_unique: bool = False,
    ) -> DataFrame:
        """The source rows whose merge would have an effect, for `merge` (see `effective`).

        Only the parts that they fall into are read. ``source`` is read more than
        once and should be staged.
        """
        target = self.read(layer, table)
        source = aligned(source, target)
        layout = self.layout(layer, table)
        hashed = False
        if layout is not None:
            arriving = rows_by_part(source, layout)
            hashed = may_be_hashed(arriving.values())
            if hashed and not null_safe:
                target = self.read_keys(layer, table, arriving, source, keys)
            else:
                target = self.read_parts(layer, table, arriving)
        return effective(target, source, keys, null_safe, source_is_unique, hashed)

    def staged_changes(
        self, layer: str, table: str, source: DataFrame, keys: Sequence[str], source_is_unique: bool = False
    ) -> DataFrame:
        """The source rows whose merge would have an effect, found out once (see `changes`).

        Only their keys are written; the rows are those of ``source``, which must be staged.
        """
        keys = list(keys)
        found = self.changes(layer, table, source, keys, source_is_unique=source_is_unique)
        listed = found.filter(all_not_null(keys)).select(*[quoted(k) for k in keys], KNOWN)
        listed = self.staged(layer, table, listed if source_is_unique else listed.distinct())
        source = aligned(source, self.read(layer, table))
        unkeyed = source.filter(~all_not_null(keys)).withColumn(KNOWN, F.lit(0).cast("bigint"))
        return unkeyed.unionByName(marked(source, listed, keys, KNOWN))

    def merge(
        self,
        layer: str,
        table: str,
        source: DataFrame,
        keys: Sequence[str],
        mark: str | None = None,
        null_safe: bool = False,
        source_is_unique: bool = False,
        gone: DataFrame | None = None,
    ) -> Published | None:
        """Upsert by key into an existing table; rows whose key is in ``gone`` are deleted first.

        None, and nothing is written, if there are neither such keys given nor source rows.

        Only the parts that hold a key of the source or of ``gone`` are written, or
        patched if the source is small beside them and nothing is deleted;
        a change set under Spark's broadcast threshold moves no target row before
        that. A table without parts is written as a whole. ``source`` and
        ``gone`` are read more than once and should be staged.
        """
        keys = list(keys)
        target = self.read(layer, table)
        layout = self.layout(layer, table)
        touched: list[int] = []
        if layout is not None:
            arriving = self._arriving(source, target, layout, mark)
            touched = sorted(arriving)
            if gone is not None:
                touched = sorted({*touched, *parts_touched(gone, layout)})
            elif not touched:
                return None
            elif not null_safe and self._may_be_patched(layout, arriving, keys):
                return self._patch(layer, table, source, layout, arriving, keys, mark, source_is_unique)
            touched = self._with_small_runs(layout, touched)
            target = self.read_parts(layer, table, touched)
        elif gone is None and source.isEmpty():
            return None
        if gone is not None:
            target = without_keys(target, gone, keys)
        merged = upsert(target, source, keys, null_safe, source_is_unique)
        if layout is None:
            return self._publish(layer, table, merged, mark)
        return self._replace(layer, table, merged, layout, touched, mark)

    def replace_parts(
        self, layer: str, table: str, df: DataFrame, parts: Iterable[int], mark: str | None = None
    ) -> Published:
        """Put ``df`` in the place of the given parts. All its rows must fall into them."""
        check_same_schema(df, self.read(layer, table))
        layout = self.layout(layer, table)
        return self._replace(layer, table, df, layout, sorted(parts), mark)

    def _with_small_runs(self, layout: Layout, touched: list[int]) -> list[int]:
        """More parts to rewrite, so that the table doesn't consist of ever more runs."""
        left = layout.replaced(touched, {}).runs()
        for _, parts in sorted(left.items(), key=lambda run: len(run[1]))[: max(0, len(left) + 1 - RUNS_KEPT)]:
            touched = touched + parts
        return sorted(touched)

    def _arriving(self, source: DataFrame, target: DataFrame, layout: Layout, mark: str | None) -> dict[int, Arriving]:
        """What arrives in which part: one row for each, found in one pass."""
        told = KNOWN in source.columns
        highest = mark_text(aligned(source.drop(KNOWN), target), mark) if mark else F.lit(None).cast("string")
        measures = [F.count("*"), highest]
        if told:
            measures += [F.count_if(F.col(KNOWN) == 0), F.count_if(~F.col(KNOWN).isin(0, 1)) == 0]
        casts = {f.name: quoted(f.name).cast(f.dataType) for f in target.schema.fields}
        found = _by_part(source.withColumns(casts).withColumn(PART, layout.place()), *measures)
        return {
            part: Arriving(row[1], *((row[3], row[4]) if told else ()), mark=row[2]) for part, row in found.items()
        }

    def _may_be_patched(self, layout: Layout, arriving: Mapping[int, Arriving], keys: list[str]) -> bool:
        """Whether patches of few rows can hold the source, and the runs don't become too many."""
        if layout.patches and layout.patch_keys != tuple(keys):
            return False
        if len(layout.patched("", dict.fromkeys(arriving, 0), keys).runs()) > RUNS_KEPT:
            return False
        patches = sum(layout.patches[part][1] for part in arriving if part in layout.patches)
        rows = sum(layout.parts[part].rows for part in arriving if part in layout.parts)
        return patches + sum(come.rows for come in arriving.values()) <= rows * PATCH_SHARE

    def _patch(
        self,
        layer: str,
        table: str,
        source: DataFrame,
        layout: Layout,
        arriving: Mapping[int, Arriving],
        keys: list[str],
        mark: str | None,
        source_is_unique: bool,
    ) -> Published:
        """Merge by writing the changed and the new rows alone, with those of the parts' earlier patches.

        A source row that stands for one row of the table, or for none, is written
        as it is; only for others, or if the source doesn't tell, the table is read.
        """
        target = self.read(layer, table)
        as_they_are = all(come.one_each for come in arriving.values())
        if as_they_are:
            rows = aligned(source.drop(KNOWN), target)
        else:
            held = self.read_parts(layer, table, arriving)
            rows = upsert(with_keys(held, source, keys), source, keys, source_is_unique=source_is_unique)
        earlier = [
            without_keys(self._piece(layer, run, held, target.columns), source, keys, null_safe=False)
            for run, held in layout.patch_pieces(arriving).items()
        ]
        run = self._write_rows(layer, table, reduce(DataFrame.unionByName, [rows, *earlier]), layout)
        written = _by_part(self.spark.table(self.name(layer, run)), F.count("*"))
        before = layout
        layout = before.patched(run, {part: row[1] for part, row in written.items()}, keys)
        facts = self._facts_after(before, arriving, run, target, mark) if as_they_are else None
        if facts is None:
            left = self.read_parts(layer, table, arriving, layout).withColumn(PART, layout.place())
            facts = self._facts(table, left, run, target, mark)
        layout = layout.with_facts(facts, self._counted(table, target.columns)[0])
        return self._point_to_parts(layer, table, layout, run, target, mark)

    def _facts_after(
        self, layout: Layout, arriving: Mapping[int, Arriving], run: str, df: DataFrame, mark: str | None
    ) -> dict[int, Part] | None:
        """What parts hold once rows have been put in the place of as many or added; None if the rows must tell.

        A part's highest mark is that of the rows that came, if none was higher
        before; else the row that held it may have been one of those replaced.
        """
        if self.checks is not None:
            return None
        ordered = mark is not None and text_is_ordered(df.schema[mark].dataType.simpleString())
        facts = {}
        for part, come in arriving.items():
            held = layout.parts.get(part, Part(run, 0))
            if mark is not None:
                texts = [text for text in (held.mark, come.mark) if text is not None]
                known = held.rows == 0 or held.mark is not None
                if not (known and ordered and come.mark is not None and max(texts) == come.mark):
                    return None
                if any(text[0] in "+-" for text in texts):
                    return None
            facts[part] = Part(run, held.rows + come.inserts, come.mark)
        return facts

    def _replace(
        self, layer: str, table: str, df: DataFrame, layout: Layout, touched: list[int], mark: str | None
    ) -> Published:
        run, written = self._write_run(layer, table, df, layout, mark)
        layout = layout.replaced(touched, written, counted=self._counted(table, df.columns)[0])
        return self._point_to_parts(layer, table, layout, run, df, mark)

    def _write_run(
        self, layer: str, table: str, df: DataFrame, layout: Layout, mark: str | None, judged: bool = False
    ) -> tuple[str, dict[int, Part]]:
        """Write rows by part as a new table; returns its name and what is in it."""
        run = self._write_rows(layer, table, df, layout)
        # From what a retried task has left in the files.
        return run, self._facts(table, self.spark.table(self.name(layer, run)), run, df, mark, judged)

    def _write_rows(self, layer: str, table: str, df: DataFrame, layout: Layout) -> str:
        """Write rows by part as a new table; returns its name.

        A part is one file, written by one task. Rows that are split by the key
        already, as are those read from tables of the same layout, stay where they are.
        """
        run = _run_name(table)
        placed = _split(df, layout).withColumn(PART, layout.place())
        writer = placed.write.format("parquet").options(**_FILES).partitionBy(PART)
        writer.bucketBy(layout.count, *layout.part_by).saveAsTable(self.name(layer, run))
        return run

    def _facts(
        self, table: str, rows: DataFrame, run: str, df: DataFrame, mark: str | None, judged: bool = False
    ) -> dict[int, Part]:
        """What rows with their part hold of the published columns, one row for each part."""
        shown = F.col(REASON).isNull() if judged else F.lit(True)
        highest = mark_text(df, mark, where=shown) if mark else F.lit(None).cast("string")
        measures = [F.count_if(shown & flaw) for flaw in self._counted(table, _shown(df, judged))[1].values()]
        facts = _by_part(rows, F.count_if(shown), highest, *measures)
        return {part: Part(run, row[1], row[2], tuple(row[3:]) if measures else None) for part, row in facts.items()}

    def _point_to_parts(
        self,
        layer: str,
        table: str,
        layout: Layout,
        run: str,
        df: DataFrame,
        mark: str | None,
        judged: bool = False,
    ) -> Published:
        """Make the published view show the parts of a layout; ``run`` is the one just written."""
        facts = {_ROWS: str(sum(part.rows for part in layout.parts.values()))}
        if mark:
            texts = [part.mark for part in layout.parts.values() if part.mark is not None]
            highest = latest_mark(self.spark, texts, df.schema[mark].dataType.simpleString())
            if highest is not None:
                facts[_MARK + mark] = highest
        facts |= layout.to_properties()
        shown = ", ".join(f"`{c}`" for c in df.columns)
        keys = [f"`{k}` AS __key{i}" for i, k in enumerate(layout.patch_keys)]
        same = " AND ".join(f"`{k}` = __key{i}" for i, k in enumerate(layout.patch_keys))
        hint = "/*+ SHUFFLE_HASH(newer) */ " if layout.hashed() else ""
        pieces = []
        for (held, patch), parts in (layout.pieces() or {(run, None): []}).items():
            within = f"{PART} IN ({', '.join(map(str, parts))})" if parts else "false"
            tests = [within] if len(parts) < layout.count else []
            if held in layout.judged or (judged and held == run):
                tests.append(f"{REASON} IS NULL")
            where = f" WHERE {' AND '.join(tests)}" if tests else ""
            piece = f"SELECT {shown} FROM {self.name(layer, held)}{where}"
            if patch is not None:
                newer = f"SELECT {', '.join(keys)} FROM {self.name(layer, patch)} WHERE {within}"
                piece = f"SELECT {hint}{shown} FROM ({piece}) LEFT ANTI JOIN ({newer}) AS newer ON {same}"
            pieces.append(piece)
        for patch, parts in layout.patch_pieces().items():
            within = f"{PART} IN ({', '.join(map(str, parts))})"
            pieces.append(f"SELECT {shown} FROM {self.name(layer, patch)} WHERE {within}")
        self._show(layer, table, facts | {_SNAPSHOT: run}, " UNION ALL ".join(pieces))
        return Published(self.name(layer, table), int(facts[_ROWS]))

    def _publish(self, layer: str, table: str, df: DataFrame, mark: str | None) -> Published:
        snapshot, facts = self._write_snapshot(layer, table, df, mark)
        return self._point(layer, table, snapshot, facts, df.columns)

    def _write_snapshot(
        self, layer: str, table: str, df: DataFrame, mark: str | None, judged: bool = False
    ) -> tuple[str, dict[str, str]]:
        """Write a new table without parts; returns its name and what was observed."""
        snapshot = _run_name(table)
        counts = F.col(REASON).isNull() if judged else F.lit(True)
        metrics = [F.count_if(counts).alias(_ROWS)]
        if mark:
            metrics.append(mark_text(df, mark, where=counts).alias(_MARK + mark))
        version, flaws = self._counted(table, _shown(df, judged))
        metrics += [F.count_if(counts & flaw).alias(f"{_COUNT}{n}") for n, flaw in enumerate(flaws.values())]
        # Shuffle stages may run again after an executor loss; the observed
        # node is the last one before the write, so its counts are final.
        seen = Observation()
        writer = df.observe(seen, *metrics).write.format("parquet").options(**_FILES)
        writer.saveAsTable(self.name(layer, snapshot))
        found = dict(seen.get)
        counted = [found.pop(f"{_COUNT}{n}") for n in range(len(flaws))]
        facts = {k: str(v) for k, v in found.items() if v is not None}
        if version:
            facts |= in_chunks(_PROFILE, json.dumps([version, counted], separators=(",", ":")))
        return snapshot, facts

    def _counted(self, table: str, columns: Sequence[str]) -> tuple[str, dict[str, Column]]:
        """What writes of a table count, and its digest; nothing without ``checks``."""
        if self.checks is None:
            return "", {}
        checks = dict(self.checks.get(table, {}))
        named = json.dumps([list(columns), checks])
        return hashlib.sha256(named.encode()).hexdigest()[:16], faults(columns, checks)

    def _point(
        self,
        layer: str,
        table: str,
        snapshot: str,
        facts: dict[str, str],
        columns: Sequence[str],
        where: str | None = None,
    ) -> Published:
        """Make the published view show a table without parts."""
        shown = ", ".join(f"`{c}`" for c in columns)
        body = f"SELECT {shown} FROM {self.name(layer, snapshot)}" + (f" WHERE {where}" if where else "")
        self._show(layer, table, facts | {_SNAPSHOT: snapshot}, body)
        return Published(self.name(layer, table), int(facts[_ROWS]))

    def _show(self, layer: str, table: str, properties: Mapping[str, str], body: str) -> None:
        """Swap the view, and note with it since when the runs it no longer shows are out of use."""
        retired = self.retired(layer, table)
        if retired:
            there = self.run_tables(layer, table)
            retired = {run: since for run, since in retired.items() if run in there}
        left = self.runs_shown(layer, table) - _runs_in(properties)
        retired |= dict.fromkeys(sorted(left), shared.now())
        properties = {**properties, **in_chunks(_RETIRED, json.dumps(retired, separators=(",", ":")))}
        listed = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in properties.items())
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(layer, table)} TBLPROPERTIES ({listed}) AS {body}"
        )

    # -- what is published ----------------------------------------------------------

    def layout(self, layer: str, table: str) -> Layout | None:
        """The layout of a table with parts."""
        return Layout.from_properties(self._properties(layer, table))

    def read_parts(
        self, layer: str, table: str, parts: Iterable[int], layout: Layout | None = None
    ) -> DataFrame:
        """Some parts of a table, as published or as in an earlier layout.

        Raises if a run that the layout names has been dropped.
        """
        return self._pieced(layer, table, parts, layout, lambda rows: rows)

    def read_keys(
        self,
        layer: str,
        table: str,
        parts: Iterable[int],
        listed: DataFrame,
        keys: Sequence[str],
        layout: Layout | None = None,
    ) -> DataFrame:
        """The rows of some parts (see `read_parts`) that have one of the listed keys, by plain equality.

        ``listed`` must be `hashed_if` few enough. A part's own rows are looked up
        in it first, so only those found are looked up in the patch.
        """
        return self._pieced(layer, table, parts, layout, lambda rows: with_keys(rows, listed, keys, hashed=True))

    def _pieced(
        self,
        layer: str,
        table: str,
        parts: Iterable[int],
        layout: Layout | None,
        chosen: Callable[[DataFrame], DataFrame],
    ) -> DataFrame:
        columns = self.read(layer, table).columns
        layout = layout or self.layout(layer, table)
        parts = list(parts)
        frames = []
        for (run, patch), held in layout.pieces(parts).items():
            rows = chosen(self._piece(layer, run, held, columns, run in layout.judged))
            if patch is not None:
                newer = self._piece(layer, patch, held, layout.patch_keys)
                rows = without_keys(rows, newer, layout.patch_keys, null_safe=False, hashed=layout.hashed(held))
            frames.append(rows)
        for run, held in layout.patch_pieces(parts).items():
            frames.append(chosen(self._piece(layer, run, held, columns)))
        if not frames:
            return self.read(layer, table).filter("false")
        return reduce(DataFrame.unionByName, frames)

    def patch_rows(
        self, layer: str, table: str, parts: Iterable[int], layout: Layout | None = None
    ) -> DataFrame | None:
        """The rows of some parts' patches, as published or in an earlier layout; None without any."""
        columns = self.read(layer, table).columns
        layout = layout or self.layout(layer, table)
        frames = [self._piece(layer, run, held, columns) for run, held in layout.patch_pieces(parts).items()]
        return reduce(DataFrame.unionByName, frames) if frames else None

    def _piece(
        self, layer: str, run: str, parts: list[int], columns: Sequence[str], judged: bool = False
    ) -> DataFrame:
        """What a run has written for some parts."""
        rows = self.spark.table(self.name(layer, run)).filter(F.col(PART).isin(parts))
        if judged:
            rows = rows.filter(f"{REASON} IS NULL")
        # Under new names: a union takes pieces of one split for such by their plain columns only.
        return rows.select(*[quoted(c).alias(c) for c in columns])

    def holds(self, layer: str, layout: Layout, parts: Iterable[int]) -> bool:
        """Whether the rows of some parts of an earlier layout are still there."""
        return all(self.spark.catalog.tableExists(self.name(layer, run)) for run in layout.runs(parts))

    def profile(self, layer: str, table: str) -> DataFrame:
        """Rows, NULLs per column and violations per check: what `one_pass` finds in the table.

        The counts are those of the writes. Only parts that were written without
        counts, or with other checks or columns, are read; without any counts
        (``checks`` not given) this is `one_pass` over the whole table. A view of
        an empty table counts 0 everywhere.
        """
        df = self.read(layer, table)
        version, flaws = self._counted(table, df.columns)
        checks = (self.checks or {}).get(table)
        if not version:
            return one_pass(df)
        layout = self.layout(layer, table)
        if layout is None:
            noted = json.loads(from_chunks(_PROFILE, self._properties(layer, table)) or "[null, []]")
            if noted[0] != version:
                return one_pass(df, checks)
            return self._as_report(["rows", *flaws], [self.rows(layer, table), *noted[1]])
        same = layout.counted == version
        known = {p: held for p, held in layout.parts.items() if same and held.counts is not None}
        columns = [[held.rows, *held.counts] for held in known.values()] or [[0] * (len(flaws) + 1)]
        report = self._as_report(["rows", *flaws], [sum(column) for column in zip(*columns)])
        unknown = set(layout.parts) - set(known)
        if not unknown:
            return report
        every = report.unionByName(one_pass(self.read_parts(layer, table, unknown), checks))
        return every.groupBy("measure").agg(F.sum("row_count").alias("row_count"))

    def _as_report(self, measures: Sequence[str], counts: Sequence[int]) -> DataFrame:
        listed = ", ".join(f"({_literal(m)}, {n}L)" for m, n in zip(measures, counts))
        return self.spark.sql(f"SELECT * FROM VALUES {listed} AS counted(measure, row_count)")

    def state(self, layer: str, table: str) -> str | None:
        """Changes whenever the published content does; None if that can't be told."""
        return self._properties(layer, table).get(_SNAPSHOT)

    def built_from(self, layer: str, table: str) -> dict | None:
        """What `stamp` has noted since the table was last published."""
        properties = self._properties(layer, table)
        chunks = sorted(k for k in properties if k.startswith(_BUILT))
        return json.loads("".join(properties[k] for k in chunks)) if chunks else None

    def stamp(self, layer: str, table: str, built_from: dict) -> None:
        """Note what the published content was built from. The next write takes the note away."""
        text = json.dumps(built_from, sort_keys=True, separators=(",", ":"))
        old = [k for k in self._properties(layer, table) if k.startswith(_BUILT)]
        name = self.name(layer, table)
        if old:
            self.spark.sql(f"ALTER VIEW {name} UNSET TBLPROPERTIES ({', '.join(map(_literal, old))})")
        chunks = [text[at : at + 3500] for at in range(0, len(text), 3500)]
        listed = ", ".join(f"{_literal(f'{_BUILT}{n:04d}')} = {_literal(c)}" for n, c in enumerate(chunks))
        self.spark.sql(f"ALTER VIEW {name} SET TBLPROPERTIES ({listed})")

    def snapshot(self, layer: str, table: str) -> str:
        """Name of the table that the last run wrote for a published view."""
        return self._properties(layer, table)[_SNAPSHOT]

    def runs_shown(self, layer: str, table: str) -> set[str]:
        """The runs whose tables the published view reads, or the last run wrote."""
        return _runs_in(self._properties(layer, table))

    def retired(self, layer: str, table: str) -> dict[str, int]:
        """Since when runs that the view once showed are out of use (seconds since 1970)."""
        return json.loads(from_chunks(_RETIRED, self._properties(layer, table)) or "{}")

    def run_tables(self, layer: str, table: str | None = None) -> dict[str, tuple[str, int]]:
        """The tables that runs have left, all or one's: published table and begin by name."""
        found = self.spark.sql(f"SHOW TABLES IN {self.schema(layer)} LIKE '{table or '*'}__*'").collect()
        named = [RUN_NAME.fullmatch(row.tableName) for row in found]
        return {
            name[0]: (name[1], int(name[2], 16))
            for name in named
            if name and (table is None or name[1] == table.lower())
        }

    def drop_old_snapshots(self, layer: str, table: str) -> list[str]:
        """Remove every run's table that is not published, at once.

        Run it when no reader is left; `retention.clean_up` can run at any time.
        """
        shown = self.runs_shown(layer, table)
        stale = [run for run in self.run_tables(layer, table) if run not in shown]
        for snapshot in stale:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, snapshot)}")
        return stale

    def _properties(self, layer: str, table: str) -> dict[str, str]:
        if not self.exists(layer, table):
            return {}
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(layer, table)}").collect()
        return {row.key: row.value for row in rows}


class MergeWarehouse(Warehouse):
    """Tables in a format with transactions and MERGE, changed in place.

    A merge rewrites only the files that hold matched rows, so this is the
    layout to use where the cluster has such a format.
    """

    def __init__(self, spark: SparkSession, table_format: str, **settings) -> None:
        self.table_format = table_format
        super().__init__(spark, **settings)

    def watermark(self, layer: str, table: str, column: str) -> Watermark | None:
        return read_watermark(self.read(layer, table), column)

    def rows(self, layer: str, table: str) -> int:
        return self.read(layer, table).count()

    def layout(self, layer: str, table: str) -> Layout | None:
        return None

    def state(self, layer: str, table: str) -> str | None:
        return None  # the format's own history would tell

    def built_from(self, layer: str, table: str) -> dict | None:
        return None

    def stamp(self, layer: str, table: str, built_from: dict) -> None:
        pass

    def overwrite(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        mark: str | None = None,
        schema_may_change: bool = False,
        part_by: Sequence[str] = (),
        count: int | None = None,
    ) -> Published:
        name = self.name(layer, table)
        if not schema_may_change and self.exists(layer, table):
            check_same_schema(df, self.read(layer, table))
        seen = Observation()
        writer = df.observe(seen, F.count("*").alias(_ROWS)).write.format(self.table_format)
        if schema_may_change:
            writer = writer.option("overwriteSchema", "true")
        writer.mode("overwrite").saveAsTable(name)
        return Published(name, int(seen.get[_ROWS]))

    def overwrite_judged(
        self,
        layer: str,
        table: str,
        rows: DataFrame,
        mark: str | None,
        keep_rejected: Callable[[DataFrame], None],
        part_by: Sequence[str] = (),
    ) -> Published:
        rows = staged(rows)
        keep_rejected(rejected(rows))
        return self.overwrite(layer, table, accepted(rows), mark)

    def merge(
        self,
        layer: str,
        table: str,
        source: DataFrame,
        keys: Sequence[str],
        mark: str | None = None,
        null_safe: bool = False,
        source_is_unique: bool = False,
        gone: DataFrame | None = None,
    ) -> Published | None:
        name = self.name(layer, table)
        if gone is None and source.isEmpty():
            return None
        if gone is not None:
            same = " AND ".join(f"{name}.`{k}` <=> gone.`{k}`" for k in keys)
            listed = gone.select(*[f"`{k}`" for k in keys]).distinct().alias("gone")
            listed.mergeInto(name, F.expr(same)).whenMatched().delete().merge()
        equal = "<=>" if null_safe else "="
        condition = " AND ".join(f"{name}.`{k}` {equal} changes.`{k}`" for k in keys)
        seen = Observation()
        changes = aligned(source.drop(KNOWN), self.read(layer, table))
        (
            changes.observe(seen, F.count("*").alias(_ROWS))
            .alias("changes")
            .mergeInto(name, F.expr(condition))
            .whenMatched()
            .updateAll()
            .whenNotMatched()
            .insertAll()
            .merge()
        )
        return Published(name, int(seen.get[_ROWS]))


def _split(df: DataFrame, layout: Layout) -> DataFrame:
    """The rows in a layout's parts; Spark leaves the exchange out where they are in them already."""
    return df.repartition(layout.count, *[quoted(c) for c in layout.part_by])


def _by_part(rows: DataFrame, *measures: Column) -> dict[int, Row]:
    """Measures of rows with their part, which comes first: one row for each part."""
    return {row[0]: row for row in rows.groupBy(PART).agg(*measures).collect()}


def _run_name(table: str) -> str:
    return f"{table}__{shared.now():08x}{uuid.uuid4().hex[:8]}"


def _runs_in(properties: Mapping[str, str]) -> set[str]:
    layout = Layout.from_properties(properties)
    runs = {*(layout.runs() if layout else ()), properties.get(_SNAPSHOT)}
    return {run.lower() for run in runs if run}


def _shown(df: DataFrame, judged: bool) -> list[str]:
    """The columns that the published view of written rows has."""
    return [c for c in df.columns if not (judged and c == REASON)]


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def check_same_schema(df: DataFrame, current: DataFrame) -> None:
    new, old = (
        [(f.name, f.dataType.simpleString()) for f in frame.schema.fields]
        for frame in (df, current)
    )
    if new != old:
        raise SchemaMismatch(f"table has {old}, data has {new}")
