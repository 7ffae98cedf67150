"""Batch high-water marks and the slices above them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import quoted

_TIMESTAMP_WITH_OFFSET = "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"


@dataclass(frozen=True)
class Watermark:
    """A mark that left Spark as text, so no Python time zone is involved."""

    column: str
    dtype: str
    text: str

    def reached(self) -> Column:
        """Inclusive filter; a foldable literal, so sources can push it down."""
        return quoted(self.column) >= F.lit(self.text).cast(self.dtype)

    def earlier(self, spark: SparkSession, lookback: str | None) -> Watermark:
        """The mark moved back by an SQL interval or number, e.g. ``INTERVAL '3' DAY``."""
        if lookback is None:
            return self
        moved = spark.range(1).select(
            (F.lit(self.text).cast(self.dtype) - F.expr(lookback)).cast(self.dtype).alias(self.column)
        )
        return Watermark(self.column, self.dtype, moved.agg(mark_text(moved, self.column)).first()[0])

    def sql_literal(self) -> str:
        """The mark as an SQL literal for a source-side query."""
        text = self.text.replace("'", "''")
        if self.dtype == "timestamp_ntz":
            return f"TIMESTAMP '{text}'"
        if self.dtype == "timestamp":  # the text carries its offset
            return f"TIMESTAMP WITH TIME ZONE '{text}'"
        if self.dtype == "date":
            return f"DATE '{text}'"
        if self.dtype == "string":
            return f"'{text}'"
        return text


def mark_text(df: DataFrame, column: str, where: Column | None = None) -> Column:
    """Aggregate expression: the highest value of a column, rendered as text."""
    value = quoted(column)
    highest = F.max(value if where is None else F.when(where, value))
    if df.schema[column].dataType.simpleString() == "timestamp":
        return F.date_format(highest, _TIMESTAMP_WITH_OFFSET)
    return highest.cast("string")


def text_is_ordered(dtype: str) -> bool:
    """Whether rendered marks are ordered like their text: text is, and dates and times of four-digit years."""
    return dtype == "string" or dtype.startswith(("timestamp", "date"))


def latest_mark(spark: SparkSession, texts: Iterable[str], dtype: str) -> str | None:
    """The highest of several rendered marks of one type."""
    found = sorted(set(texts))
    if len(found) < 2:
        return found[0] if found else None
    if dtype == "string" or (text_is_ordered(dtype) and found[0][0] not in "+-"):
        return found[-1]
    values = spark.createDataFrame([(text,) for text in found], "text string")
    return values.orderBy(F.col("text").cast(dtype).desc()).first()[0]


def high_water_mark(df: DataFrame, column: str = "updated_at") -> DataFrame:
    """One row with the highest value (NULL for an empty table)."""
    return df.agg(F.max(quoted(column)).alias("watermark"))


def read_watermark(df: DataFrame, column: str = "updated_at") -> Watermark | None:
    """Fetch the mark (one scalar) for use in another read; None if there is none."""
    text = df.agg(mark_text(df, column)).first()[0]
    if text is None:
        return None
    return Watermark(column, df.schema[column].dataType.simpleString(), text)


def since(df: DataFrame, mark: Watermark | None) -> DataFrame:
    """Rows at or above the mark. No mark means everything is new."""
    return df if mark is None else df.filter(mark.reached())


def slice_above(source: DataFrame, target: DataFrame, column: str = "updated_at") -> DataFrame:
    """Rows of ``source`` at or above the mark of ``target``, in one lazy plan.

    The boundary is inclusive: rows with an equal mark are read again and the
    keyed upsert makes that harmless. Later-arriving rows below it are skipped.
    """
    mark = high_water_mark(target, column).scalar()
    return source.filter(mark.isNull() | (quoted(column) >= mark))
