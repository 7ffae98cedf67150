"""Layered order analytics on Spark: ingest, clean, validate, marts, profiling."""

from tidemark.specs import TABLES, TableSpec

__all__ = ["TABLES", "TableSpec"]
