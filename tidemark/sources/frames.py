"""Source over DataFrames (parquet files, catalog tables, test data)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.operators.watermark import Watermark, since
from tidemark.specs import TableSpec


@dataclass(frozen=True)
class FrameSource:
    frames: Mapping[str, DataFrame]

    def read(self, spec: TableSpec) -> DataFrame:
        return self.frames[spec.name]

    def read_since(self, spec: TableSpec, mark: Watermark | None) -> DataFrame:
        """The filter is a literal comparison, so a file scan gets it pushed down."""
        return since(self.read(spec), mark)
