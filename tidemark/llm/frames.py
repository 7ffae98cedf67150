"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case; every other character stays as it is."""
    return F.translate(column, UPPER, UPPER.lower())


def with_fields(df: DataFrame, made: Column, fields: Iterable[str], keep: Iterable[str] | None = None) -> DataFrame:
    """``df`` with the fields of the struct ``made`` as columns.

    An input column of the same name as a field (in any case) is replaced.
    """
    fields = list(fields)
    taken = {f.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    staged = df.select(*[F.col(f"`{c}`") for c in kept], made.alias("__made"))
    return staged.select(*[F.col(f"`{c}`") for c in kept], *[F.col("__made")[f].alias(f) for f in fields])


def shuffle_width(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
}


def names_of(fields: str) -> list[str]:
    """Column names of a ``name type, ...`` list."""
    return [field.split()[0] for field in fields.split(", ")]


def record_batch(fields: str, columns: dict[str, list]) -> pa.RecordBatch:
    """Arrow rows of a ``name type, ...`` list; columns that aren't given are null."""
    rows = len(next(iter(columns.values())))
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in map(str.split, fields.split(", "))])
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(f.name, [None] * rows), type=f.type) for f in schema], schema=schema
    )
