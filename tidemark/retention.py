"""What may be removed while other runs and readers go on.

A lease says that somebody has been at work since a certain time. Whatever could
be seen or was begun since then stays, until the lease is released or runs out.
Leases are empty folders in the shared folder whose names say all, so drivers
that share it (``spark.checkpoint.dir``) and the catalog need nothing else. Their
clocks may differ by less than the ``keep`` they clean up with.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession

from tidemark import shared
from tidemark.warehouse import LAYERS, Warehouse

DAY = 24 * 3600
_LEASE = re.compile(r"([0-9a-f]{8})-([0-9a-f]{8})-[0-9a-f]{32}")


class Lease:
    """Keeps what its holder may be reading or writing; a context manager.

    Take it before the first table is read. It runs out after ``seconds``, so that
    a lost driver doesn't keep everything for ever; `renew` lengthens it.
    """

    def __init__(self, spark: SparkSession, seconds: int = DAY) -> None:
        self.spark = spark
        self.seconds = seconds
        self.since = shared.now()
        self._held: str | None = None
        self._lock = threading.Lock()
        self.renew()

    def renew(self) -> None:
        """Run out ``seconds`` from now. The new term is noted before the old one goes."""
        with self._lock:
            until = shared.now() + self.seconds
            made = f"{_leases(self.spark)}/{self.since:08x}-{until:08x}-{uuid.uuid4().hex}"
            folders, path = shared.file_system(self.spark, made)
            folders.mkdirs(path)
            self._forget()
            self._held = made

    def release(self) -> None:
        with self._lock:
            self._forget()

    def _forget(self) -> None:
        if self._held is not None:
            folders, path = shared.file_system(self.spark, self._held)
            folders.delete(path, True)
            self._held = None

    def __enter__(self) -> Lease:
        return self

    def __exit__(self, *_) -> None:
        self.release()


def kept_since(spark: SparkSession, keep: int) -> int:
    """What was last in use before this time is nobody's: ``keep`` seconds ago, or the oldest lease's begin."""
    now = shared.now()
    terms = [_LEASE.fullmatch(name) for name in shared.names_in(spark, _leases(spark))]
    held = [int(term[1], 16) for term in terms if term and int(term[2], 16) >= now]
    return min([now - keep, *held])


def clean_up(warehouse: Warehouse, keep: int = DAY, layers: Sequence[str] = LAYERS) -> list[str]:
    """Drop the tables of runs that nobody needs any more; returns their names.

    A run's table goes if no published view shows it and it left the last one, or,
    never published, was begun, more than ``keep`` seconds ago and before all live
    leases. Readers and writers without a lease must be done within ``keep``.
    """
    limit = kept_since(warehouse.spark, keep)
    dropped = []
    for layer in layers:
        begun = warehouse.run_tables(layer)
        tables = {table for table, _ in begun.values()}
        shown = {table: warehouse.runs_shown(layer, table) for table in tables}
        retired = {table: warehouse.retired(layer, table) for table in tables}
        for run, (table, since) in begun.items():
            if run not in shown[table] and retired[table].get(run, since) < limit:
                warehouse.spark.sql(f"DROP TABLE IF EXISTS {warehouse.name(layer, run)}")
                dropped.append(warehouse.name(layer, run))
    return dropped


def clean_up_folders(spark: SparkSession, keep: int = DAY, labels: Iterable[str] = ("staged",)) -> list[str]:
    """Delete folders of the shared folder that were begun before any live lease and ``keep`` seconds ago.

    A DataFrame that was returned over staged rows reads them when it is used, so
    its user holds a lease that long.
    """
    limit = kept_since(spark, keep)
    root = shared.shared_folder(spark)
    named = re.compile(rf"(?:{'|'.join(map(re.escape, labels))})-([0-9a-f]{{8}})-[0-9a-f]{{32}}")
    deleted = []
    for name in shared.names_in(spark, root):
        begun = named.fullmatch(name)
        if begun and int(begun[1], 16) < limit:
            folders, path = shared.file_system(spark, f"{root}/{name}")
            folders.delete(path, True)
            deleted.append(name)
    return deleted


def _leases(spark: SparkSession) -> str:
    return f"{shared.shared_folder(spark)}/leases"
