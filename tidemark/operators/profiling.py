"""Profiling reports. Each returns a DataFrame; counts of a table share one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import all_not_null, or_zero, quoted


def _true_count(predicate: Column) -> Column:
    """Rows where the predicate is true (NULL is not); 0 for an empty table."""
    return F.count_if(predicate)


def _long_form(one_row: DataFrame, name: str, value: str) -> DataFrame:
    """One wide row to (name, value) rows."""
    return one_row.unpivot([], list(one_row.columns), name, value)


def stacked(reports: Mapping[str, DataFrame], label: str = "table_name") -> DataFrame:
    """Reports of several tables as one, labelled."""
    labelled = [df.select(F.lit(name).alias(label), "*") for name, df in reports.items()]
    return reduce(DataFrame.unionByName, labelled)


# -- grain and keys ------------------------------------------------------------


def grain(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows against distinct keys, single, composite or whole row.

    One shuffle: count per key (combined map-side), then totals of the counts.
    ``distinct_keys`` counts a NULL key as a value; ``distinct_full_keys``
    leaves out keys with a NULL part, as COUNT(DISTINCT ...) does.
    """
    keys = list(keys or df.columns)
    per_key = df.groupBy(*[quoted(k) for k in keys]).agg(F.count("*").alias("__n"))
    return per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_keys"),
        _true_count(all_not_null(keys)).alias("distinct_full_keys"),
        _true_count(F.col("__n") > 1).alias("repeated_keys"),
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    counted = df.groupBy(*[quoted(k) for k in keys]).agg(F.count("*").alias("row_count"))
    return counted.filter("row_count > 1")


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Value counts, most frequent first."""
    counted = df.groupBy(quoted(column)).agg(F.count("*").alias("row_count"))
    return counted.orderBy(F.desc("row_count"), quoted(column))


def heaviest_keys(
    df: DataFrame, keys: Sequence[str], k: int = 10, measures: Mapping[str, Column] | None = None
) -> DataFrame:
    """Top-k keys by row count with further measures; the key breaks ties."""
    extra = [expr.alias(name) for name, expr in (measures or {}).items()]
    counted = df.groupBy(*[quoted(c) for c in keys]).agg(F.count("*").alias("row_count"), *extra)
    return counted.orderBy(F.desc("row_count"), *[quoted(c) for c in keys]).limit(k)


def attribute_drift(
    df: DataFrame, entity: str, attributes: Sequence[str], k: int | None = None
) -> DataFrame:
    """Distinct values of each attribute per entity; with ``k``, the most drifting ones.

    Each (entity, attribute, value) is made distinct once, combined on the map
    side, and then counted; a count distinct per attribute would send every row
    once per attribute. NULLs don't count as values.
    """
    kinds = [df.schema[a].dataType for a in attributes]

    def slot(place: int):
        """The value in a field of its own type, all other fields NULL."""
        fields = [
            (quoted(a) if n == place else F.lit(None).cast(kind)).alias(f"v{n}")
            for n, (a, kind) in enumerate(zip(attributes, kinds))
        ]
        return F.struct(F.lit(place).alias("place"), *fields)

    values = F.explode(F.array(*[slot(n) for n in range(len(attributes))])).alias("__value")
    seen = df.select(quoted(entity).alias(entity), values).distinct()
    counts = [F.count(F.col(f"__value.v{n}")).alias(f"distinct_{a}") for n, a in enumerate(attributes)]
    drift = seen.groupBy(quoted(entity)).agg(*counts)
    if k is None:
        return drift
    return drift.orderBy(F.desc(f"distinct_{attributes[0]}"), quoted(entity)).limit(k)


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values of a column against the row count, in one shuffle."""
    per_value = df.groupBy(quoted(column).alias("__value")).agg(F.count("*").alias("__n"))
    return per_value.agg(
        F.count("__value").alias("distinct_values"),
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total_rows"),
    )


# -- counts in one pass --------------------------------------------------------


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs of every column in one pass, as (column_name, null_count)."""
    columns = list(columns or df.columns)
    one_row = df.agg(*[_true_count(quoted(c).isNull()).alias(c) for c in columns])
    return _long_form(one_row, "column_name", "null_count")


def flag_counts(df: DataFrame, checks: Mapping[str, str]) -> DataFrame:
    """Violations of named predicates in one pass, as (check_name, violations)."""
    one_row = df.agg(*[_true_count(F.expr(p)).alias(name) for name, p in checks.items()])
    return _long_form(one_row, "check_name", "violations")


def faults(columns: Sequence[str], checks: Mapping[str, str] | None = None) -> dict[str, Column]:
    """The predicates whose rows `one_pass` counts, by measure: NULLs per column, then the checks."""
    found = {f"nulls:{c}": quoted(c).isNull() for c in columns}
    return found | {f"check:{n}": F.expr(p) for n, p in (checks or {}).items()}


def one_pass(df: DataFrame, checks: Mapping[str, str] | None = None) -> DataFrame:
    """Row count, NULLs per column and violations per check from a single scan."""
    measures = [F.count("*").alias("rows")]
    measures += [_true_count(p).alias(name) for name, p in faults(df.columns, checks).items()]
    return _long_form(df.agg(*measures), "measure", "row_count")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return stacked({n: df.agg(F.count("*").alias("row_count")) for n, df in tables.items()})


def offending_rows(
    df: DataFrame, predicate: str, columns: Sequence[str], order_by: Sequence[str], k: int = 10
) -> DataFrame:
    """First k rows a check flags, in key order, with chosen columns."""
    flagged = df.filter(F.expr(predicate)).select(*[quoted(c) for c in columns])
    return flagged.orderBy(*[quoted(c) for c in order_by]).limit(k)


def preview(df: DataFrame, order_by: Sequence[str], k: int = 10) -> DataFrame:
    """First k rows in key order (a repeatable LIMIT)."""
    return df.orderBy(*[quoted(c) for c in order_by]).limit(k)


# -- relations between tables --------------------------------------------------


def orphan_keys(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct child keys without a parent. A NULL key has none.

    Both sides are made distinct first, so neither a hot child key nor a
    repeated parent key reaches the join more than once per map task.
    """
    left = child.select(quoted(key)).distinct()
    return left.join(parent.select(quoted(key)).distinct(), key, "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return orphan_keys(child, parent, key).agg(F.count("*").alias("orphan_keys"))


def orphan_value(child: DataFrame, parent: DataFrame, key: str, value: str) -> DataFrame:
    """Total of a column over rows without a parent; summed per key before the join."""
    per_key = child.groupBy(quoted(key)).agg(F.sum(quoted(value)).alias("__value"))
    orphans = per_key.join(parent.select(quoted(key)).distinct(), key, "left_anti")
    return orphans.agg(F.sum("__value").alias("orphan_value"))


def childless_count(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """Parent rows no child refers to."""
    referred = child.select(quoted(key)).distinct()
    return parent.join(referred, key, "left_anti").agg(F.count("*").alias("childless_rows"))


ROWS, COUNT = "decimal(38,0)", "decimal(19,0)"


def fan_out(parent: DataFrame, children: Sequence[DataFrame], key: str) -> DataFrame:
    """Rows a plain left join of all children would give, without making them.

    A parent with n1, n2, ... children would appear max(n1, 1) * max(n2, 1) * ...
    times.
    """
    wide = parent.select(quoted(key))
    product = F.lit(1).cast(ROWS)  # a bigint overflows with a few hot children
    for i, child in enumerate(children):
        counted = child.groupBy(quoted(key)).agg(F.count("*").alias(f"__n{i}"))
        wide = wide.join(counted, key, "left")
        product = (product * F.coalesce(F.col(f"__n{i}"), F.lit(1)).cast(COUNT)).cast(ROWS)
    per_key = wide.groupBy(quoted(key).alias("__key")).agg(F.sum(product).alias("__rows"))
    return per_key.agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).cast(ROWS).alias("rows_after_join"),
        F.count("__key").alias("distinct_keys"),
    )


# -- one entity ----------------------------------------------------------------


def entity_rows(
    df: DataFrame, key: str, value: object, columns: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Detail rows of one entity; the key filter reaches the scan."""
    found = df.filter(quoted(key) == F.lit(value)).select(*[quoted(c) for c in columns])
    return found.orderBy(*[quoted(c) for c in order_by])


def entity_activity(
    parent: DataFrame,
    child: DataFrame,
    entity: str,
    value: object | None,
    parent_key: str,
    child_key: str,
) -> DataFrame:
    """Distinct parent keys and distinct child keys per entity (one, or all of them)."""
    mine = parent if value is None else parent.filter(quoted(entity) == F.lit(value))
    mine = mine.select(quoted(entity), quoted(parent_key)).distinct()
    links = child.select(quoted(parent_key), quoted(child_key)).distinct()
    parents = mine.groupBy(quoted(entity)).agg(F.count(quoted(parent_key)).alias("parent_keys"))
    # An inner join, because AQE can split a parent with very many children there.
    children = (
        mine.join(links, parent_key)
        .groupBy(quoted(entity))
        .agg(F.countDistinct(quoted(child_key)).alias("child_keys"))
    )
    return parents.join(children, entity, "left").select(
        entity, "parent_keys", or_zero("child_keys").alias("child_keys")
    )
