"""JDBC source: whole tables, or the slice above a mark selected by the database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from decimal import Decimal, InvalidOperation

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.watermark import Watermark
from tidemark.specs import TableSpec


@dataclass(frozen=True)
class JdbcSplit:
    """Parallel read of one table: ranges of a numeric, date or timestamp column.

    Rows outside the bounds are read too (by the first and last range), so the
    bounds only steer how even the ranges are.
    """

    column: str
    lower: str
    upper: str
    partitions: int

    def above(self, mark: Watermark) -> JdbcSplit:
        """Ranges of a slice: from the mark upwards where it is on the same column.

        Marks outgrow a configured upper bound; it moves along, since a lower
        bound above the upper one is an error.
        """
        if self.column != mark.column:
            return self
        return replace(self, lower=mark.text, upper=max(self.upper, mark.text, key=_ordered))

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.partitions),
        }


def identifier(name: str, mark: str = '"') -> str:
    """A name as the database reads it literally."""
    return mark + name.replace(mark, mark * 2) + mark


def delta_query(schema: str, table: str, mark: Watermark, quote: str = '"') -> str:
    """Subquery with the rows at or above the mark, as a typed literal."""
    return (
        f"(SELECT * FROM {identifier(schema, quote)}.{identifier(table, quote)} "
        f"WHERE {identifier(mark.column, quote)} >= {mark.sql_literal()}) AS changed_rows"
    )


def _ordered(bound: str) -> tuple[int, Decimal, str]:
    """Numbers in numeric order; dates and timestamps as ISO text."""
    try:
        return (0, Decimal(bound), "")
    except InvalidOperation:
        return (1, Decimal(0), bound)


@dataclass(frozen=True)
class JdbcHexSplit:
    """Parallel read of a table whose key is lower-case hexadecimal text.

    Such keys can't be range bounds; each task reads the keys that start with
    one prefix range of ``digits`` digits. Other keys, NULL included, go to the
    outer ranges, so every row is read once.
    """

    column: str
    digits: int = 1

    def predicates(self, column: str) -> list[str]:
        cuts = [f"{n:0{self.digits}x}" for n in range(1, 16**self.digits)]
        ranges = zip([None, *cuts], [*cuts, None])
        made = [
            " AND ".join(
                part
                for part in (low and f"{column} >= '{low}'", high and f"{column} < '{high}'")
                if part
            )
            for low, high in ranges
        ]
        return [f"({made[0]} OR {column} IS NULL)", *made[1:]]


@dataclass(frozen=True)
class JdbcQuantileSplit:
    """Parallel read of a table by any ordered column, with bounds that the database finds.

    One query asks the database for the least value of each of ``partitions``
    equally long stretches of the ordered column (it reads an index, or sorts
    the column). The ranges between them are read by one task each; whatever
    the order - a collation, say - the database compares with it in both steps,
    so every row falls into one range. NULLs go to the first. A value that holds
    more rows than a stretch can't be divided.
    """

    column: str
    partitions: int

    def cuts_query(self, dbtable: str, column: str) -> str:
        return (
            f"(SELECT stretch, MIN(cut) AS cut FROM (SELECT {column} AS cut, "
            f"NTILE({self.partitions}) OVER (ORDER BY {column}) AS stretch "
            f"FROM {dbtable} WHERE {column} IS NOT NULL) AS placed GROUP BY stretch) AS cuts"
        )

    @staticmethod
    def predicates(column: str, cuts: Sequence[str]) -> list[str]:
        """Ranges from SQL literals in the database's order, the first of which is the least value."""
        inner = [cut for n, cut in enumerate(cuts) if n and cut != cuts[n - 1]]
        if not inner:
            return ["1 = 1"]
        made = [f"({column} < {inner[0]} OR {column} IS NULL)"]
        made += [f"{column} >= {low} AND {column} < {high}" for low, high in zip(inner, inner[1:])]
        return [*made, f"{column} >= {inner[-1]}"]

    def cuts(self, found: DataFrame) -> list[str]:
        """The answer to `cuts_query` as literals: one row for each partition at most."""
        dtype = found.schema["cut"].dataType.simpleString()
        rows = found.select("stretch", found["cut"].cast("string").alias("cut")).collect()
        return [Watermark("cut", dtype, row["cut"]).sql_literal() for row in sorted(rows)]


@dataclass(frozen=True)
class JdbcSource:
    """Tables of one database schema.

    ``options`` holds driver, user, password and the like; secrets come from
    the caller. Tables in ``splits`` are read by several tasks, the others by
    one, which is only right for small tables and change slices.
    """

    spark: SparkSession
    url: str
    options: Mapping[str, str]
    schema: str = "public"
    splits: Mapping[str, JdbcSplit | JdbcHexSplit | JdbcQuantileSplit] = field(default_factory=dict)
    fetch_size: int = 10_000
    quote: str = '"'  # the database's mark around identifiers

    def read_options(
        self, spec: TableSpec, dbtable: str, mark: Watermark | None = None
    ) -> dict[str, str]:
        split = self.splits.get(spec.name)
        if isinstance(split, (JdbcHexSplit, JdbcQuantileSplit)):
            split = None
        if split and mark:
            split = split.above(mark)
        return {
            "url": self.url,
            "dbtable": dbtable,
            "fetchsize": str(self.fetch_size),
            # Zone-less database timestamps stay wall-clock values, so a mark
            # sent back to the database is what the database stored.
            "preferTimestampNTZ": "true",
            **self.options,
            **(split.options() if split else {}),
        }

    def read(self, spec: TableSpec) -> DataFrame:
        return self._load(spec, f"{identifier(self.schema, self.quote)}.{identifier(spec.name, self.quote)}")

    def read_since(self, spec: TableSpec, mark: Watermark | None) -> DataFrame:
        if mark is None:
            return self.read(spec)
        return self._load(spec, delta_query(self.schema, spec.name, mark, self.quote), mark)

    def _load(self, spec: TableSpec, dbtable: str, mark: Watermark | None = None) -> DataFrame:
        options = self.read_options(spec, dbtable, mark)
        split = self.splits.get(spec.name)
        if isinstance(split, JdbcHexSplit):
            url, table = options.pop("url"), options.pop("dbtable")
            predicates = split.predicates(identifier(split.column, self.quote))
            return self.spark.read.jdbc(url, table, predicates=predicates, properties=options)
        if isinstance(split, JdbcQuantileSplit):
            column = identifier(split.column, self.quote)
            asked = {**options, "dbtable": split.cuts_query(dbtable, column)}
            cuts = split.cuts(self.spark.read.format("jdbc").options(**asked).load())
            url, table = options.pop("url"), options.pop("dbtable")
            return self.spark.read.jdbc(url, table, predicates=split.predicates(column, cuts), properties=options)
        return self.spark.read.format("jdbc").options(**options).load()
