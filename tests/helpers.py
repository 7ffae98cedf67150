"""Small helpers for literal test frames."""

from __future__ import annotations

from datetime import datetime


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *columns):
    """Sorted list of plain tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
