"""Stamps: what an output was built from, so that it isn't built again without need."""

from __future__ import annotations

import hashlib
import inspect
from collections.abc import Mapping
from functools import lru_cache
from types import ModuleType

from tidemark.layout import Layout
from tidemark.specs import TableSpec
from tidemark.warehouse import Warehouse


@lru_cache(maxsize=None)
def code_version(*modules: ModuleType) -> str:
    """A digest of the modules' source: a changed rule or mart is built anew."""
    text = "\0".join(inspect.getsource(module) for module in modules)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def spec_version(spec: TableSpec) -> str:
    return hashlib.sha256(repr(spec).encode()).hexdigest()[:16]


def stamp_of(
    warehouse: Warehouse,
    inputs: Mapping[str, tuple[str, str]],
    version: str,
    options: str = "",
    with_layouts: bool = False,
) -> dict | None:
    """The stamp of an output of the published ``inputs`` (name to layer and table).

    None if a state can't be told; such an output is always built. Layouts are
    kept along ``with_layouts``, so that the next build can see which parts have
    changed since.
    """
    made: dict = {"version": version, "options": options, "inputs": {}, "layouts": {}}
    for name, (layer, table) in inputs.items():
        state = warehouse.state(layer, table)
        if state is None:
            return None
        made["inputs"][name] = state
        layout = warehouse.layout(layer, table) if with_layouts else None
        if layout is not None:
            made["layouts"][name] = layout.without_facts().to_json()
    return made


def layout_in(stamp: dict | None, name: str) -> Layout | None:
    """The layout that an input had when the stamp was made."""
    text = (stamp or {}).get("layouts", {}).get(name)
    return Layout.from_json(text) if text else None
