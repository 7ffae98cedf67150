"""MERGE semantics (update all on match, insert all otherwise) as DataFrame joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import all_not_null, quoted

_NEW = "__new"
_COUNT = "__count"
_TIMES = "__times"
_RANK = "__rank"
#: How many target rows have a source row's key, where that has been found out before:
#: 0 for an insert, negative if several source rows share the key of a target row.
KNOWN = "__known"


class SchemaMismatch(ValueError):
    """Source and target of an upsert do not have the same columns."""


def aligned(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source columns by name in target order and type; nothing missing or extra."""
    missing = [c for c in target.columns if c not in source.columns]
    extra = [c for c in source.columns if c not in target.columns]
    if missing or extra:
        raise SchemaMismatch(f"missing columns {missing}, unexpected columns {extra}")
    return source.select(
        *[quoted(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    )


def _renamed_keys(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [quoted(k).alias(f"__key{i}") for i, k in enumerate(keys)]


def _same_key(keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [(quoted(k), F.col(f"__key{i}")) for i, k in enumerate(keys)]
    return reduce(
        lambda a, b: a & b,
        [left.eqNullSafe(right) if null_safe else left == right for left, right in pairs],
    )


def _one_per_key(source: DataFrame, keys: Sequence[str], unique: bool) -> DataFrame:
    """Key columns, a source row of that key, and how many rows share the key."""
    row = F.struct(*[quoted(c) for c in source.columns])
    if unique:
        return source.select(*_renamed_keys(source, keys), row.alias(_NEW), F.lit(1).alias(_COUNT))
    return source.groupBy(*_renamed_keys(source, keys)).agg(
        F.max(row).alias(_NEW), F.count("*").alias(_COUNT)
    )


def _matched(keys: Sequence[str]) -> Column:
    """Whether the target row has a source row; raises if it has several.

    Stands above the join, because a repeated source key is no error as long as
    no target row has it.
    """
    message = F.lit(f"several source rows match one target row on {list(keys)}")
    return F.when(F.col(_COUNT) > 1, F.raise_error(message)).otherwise(F.col(_COUNT).isNotNull())


def hashed_if(df: DataFrame, hashed: bool) -> DataFrame:
    """The side of a join whose rows, if they are ``hashed``, are so few that each task can
    hold its share of them in memory; the other side is then not sorted."""
    return df.hint("shuffle_hash") if hashed else df


def _found(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool, unique: bool, hashed: bool
) -> DataFrame:
    """The source's keys that the target has, in how many rows, and whether one of them differs.

    Of source rows that share a key one is compared. The target is joined to them
    before anything of it is grouped, so a source under Spark's broadcast
    threshold moves no target row.
    """
    if not unique:
        window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*[quoted(k) for k in keys])
        source = source.withColumn(_RANK, F.row_number().over(window)).filter(f"{_RANK} = 1").drop(_RANK)
    columns = [quoted(c) for c in target.columns]
    incoming = source.select(*_renamed_keys(source, keys), F.struct(*columns).alias(_NEW))
    names = [f"__key{i}" for i in range(len(keys))]
    return (
        target.join(hashed_if(incoming, hashed), _same_key(keys, null_safe), "inner")
        .groupBy(*names)
        .agg(F.max(~F.struct(*columns).eqNullSafe(F.col(_NEW))).alias("__differs"), F.count("*").alias(_TIMES))
    )


def effective(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    source_is_unique: bool = False,
    hashed: bool = False,
) -> DataFrame:
    """The source rows whose merge would change the target, or fail.

    Those are rows with a NULL key (plain equality inserts them again), with a
    key that the target lacks, with a key of which some target row differs, and
    rows that share their key (an error that the merge must raise, or several
    inserts). Merging them alone gives the same table as merging all. The column
    `KNOWN` says how many target rows have the key; `upsert` needs not look again.

    All target rows of a key count; ``target`` may be limited to parts that hold
    every row of the incoming keys. It is read once, and not sorted if the source
    is ``hashed`` (see `hashed_if`).
    """
    keys = list(keys)
    source = aligned(source, target)
    keyed = source if null_safe else source.filter(all_not_null(keys))
    found = _found(target, keyed, keys, null_safe, source_is_unique, hashed)
    times = F.coalesce(F.col(_TIMES), F.lit(0).cast("bigint"))
    acts, known, rows = F.coalesce(F.col("__differs"), F.lit(True)), times, keyed
    if not source_is_unique:
        rows = keyed.withColumn(_COUNT, F.count("*").over(Window.partitionBy(*[quoted(k) for k in keys])))
        several = F.col(_COUNT) > 1
        acts, known = several | acts, F.when(several, -times).otherwise(times)
    merged = (
        rows.join(hashed_if(found, hashed), _same_key(keys, null_safe), "left")
        .filter(acts)
        .select(*[quoted(c) for c in source.columns], known.alias(KNOWN))
    )
    if null_safe:
        return merged
    # Rows with NULL keys come first: a union whose pieces are partitioned alike is
    # seen to be so only if its first one has not lost the NULLs.
    return source.filter(~all_not_null(keys)).withColumn(KNOWN, F.lit(0).cast("bigint")).unionByName(merged)


def has_effect(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> bool:
    """Whether an upsert would change the target, or fail, at all."""
    return not effective(target, source, keys, null_safe).isEmpty()


def without_keys(
    target: DataFrame, gone: DataFrame, keys: Sequence[str], null_safe: bool = True, hashed: bool = False
) -> DataFrame:
    """The target rows whose key is not among ``gone``, NULLs compared as equal (unless told not to)."""
    listed = gone.select(*_renamed_keys(gone, keys))
    listed = listed.distinct() if null_safe else listed
    return target.join(hashed_if(listed, hashed), _same_key(keys, null_safe), "left_anti")


def with_keys(target: DataFrame, source: DataFrame, keys: Sequence[str], hashed: bool = False) -> DataFrame:
    """The target rows that the source has a row for, by plain equality of keys."""
    listed = hashed_if(source.select(*_renamed_keys(source, keys)), hashed)
    return target.join(listed, _same_key(keys, null_safe=False), "left_semi")


def marked(source: DataFrame, listed: DataFrame, keys: Sequence[str], mark: str) -> DataFrame:
    """The source rows whose key is listed (once), with the mark it has there."""
    found = listed.select(*_renamed_keys(listed, keys), mark)
    return source.join(found, _same_key(keys, null_safe=False), "inner").select(*[quoted(c) for c in source.columns], mark)


def keys_among(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of the target that the source has too, NULLs compared as equal."""
    listed = source.select(*_renamed_keys(source, keys)).distinct()
    return target.select(*[quoted(k) for k in keys]).join(
        listed, _same_key(keys, null_safe=True), "left_semi"
    ).distinct()


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    source_is_unique: bool = False,
) -> DataFrame:
    """The target's state after merging ``source`` into it.

    * target rows without a match stay; matched ones take every source column
      (one source row may update several target rows);
    * source rows without a match are inserted, also when the key is NULL
      (plain equality) or repeated;
    * a target row matched by several source rows is an error, raised when the
      result is evaluated. ``source_is_unique`` skips that check for a source
      just deduplicated on the same keys. A source that `effective` gave says of
    each row whether it is an update or an insert; then the target is read once.

    Shape of the plan: the target is on the streamed side of a left join, so a
    source under Spark's broadcast threshold leaves the target unshuffled, and
    beyond it AQE may split a skewed target key (it could not for a full outer
    join). Insert detection reads only the target's key columns. Rows with a
    NULL key can never match under plain equality; they bypass the joins
    instead of meeting in one partition.
    """
    columns = target.columns
    told = KNOWN in source.columns
    inserts = aligned(source.filter(f"{KNOWN} = 0").drop(KNOWN), target) if told else None
    source = aligned(source.filter(f"{KNOWN} <> 0").drop(KNOWN) if told else source, target)
    bypass = []
    if not null_safe:
        bypass = [side.filter(~all_not_null(keys)) for side in (target, source)]
        target, source = (side.filter(all_not_null(keys)) for side in (target, source))

    incoming = _one_per_key(source, keys, source_is_unique)
    hit = F.col(_COUNT).isNotNull() if source_is_unique else _matched(keys)
    kept = target.join(incoming, _same_key(keys, null_safe), "left").select(
        # Matched keys are equal anyway; passing the target's on keeps its partitioning.
        *[
            quoted(c)
            if c in keys
            else F.when(hit, F.col(_NEW).getField(c)).otherwise(quoted(c)).alias(c)
            for c in columns
        ]
    )

    if told:
        return reduce(DataFrame.unionByName, [*bypass, kept, inserts])
    source_keys = source.select(*_renamed_keys(source, keys)).distinct()
    matched = (
        target.select(*[quoted(k) for k in keys])
        .join(source_keys, _same_key(keys, null_safe), "inner")
        .select(*[f"__key{i}" for i in range(len(keys))])
        .distinct()
    )
    inserted = source.join(matched, _same_key(keys, null_safe), "left_anti")
    return reduce(DataFrame.unionByName, [*bypass, kept, inserted])
