"""Removing superseded versions: mark what manifests, readers and the catalog still use, sweep the rest.

Live is whatever the newest ``keep`` manifests name, the manifests that readers have pinned, and the
folders that catalog tables and their partitions point at. Of the other folders those named by an
older manifest are superseded and go; those that no manifest names may belong to a writer that has
not committed yet and go only when they are older than ``grace_hours``. Older manifests go after
their folders, so a sweep that is lost half-way finds the rest the next time.

Only names and times of folders are read, on the driver: as many as there are versions.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tessera.plans import manifest as M
from tessera.plans.publish import REPLACED, _plain, current_location

PINS = "pins"


@dataclass(frozen=True)
class Swept:
    removed: tuple[str, ...]
    manifests: tuple[int, ...]
    definitions: tuple[str, ...]


def _pin_path(root: str, database: str, number: int, reader: str) -> str:
    return f"{M.folder(root, database)}/{PINS}/{number:012d}-{reader}"


def pin(spark: SparkSession, state: M.Snapshot, reader: str) -> None:
    """Keep a snapshot's versions until ``unpin``: for a long job that reads them."""
    M.create_if_absent(spark, _pin_path(state.root, state.database, state.number, reader), reader)
    if state.number and state.number not in M.numbers(spark, state.root, state.database):
        unpin(spark, state, reader)
        raise RuntimeError(f"manifest {state.number} of {state.database} is swept already")


def unpin(spark: SparkSession, state: M.Snapshot, reader: str) -> None:
    fs, path = M.file_system(spark, _pin_path(state.root, state.database, state.number, reader))
    fs.delete(path, False)


def pinned(spark: SparkSession, root: str, database: str) -> set[int]:
    fs, path = M.file_system(spark, f"{M.folder(root, database)}/{PINS}")
    if not fs.exists(path):
        return set()
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return {int(n.partition("-")[0]) for n in names if n[:12].isdigit()}


def _catalog_paths(spark: SparkSession, database: str) -> set[str]:
    """Where the catalog's tables and partitions of a database lie."""
    if not spark.catalog.databaseExists(database):
        return set()
    out = set()
    for t in spark.catalog.listTables(database):
        if t.isTemporary or t.tableType == "VIEW" or REPLACED in t.name:
            continue
        name = f"{database}.{t.name}"
        out.add(_plain(current_location(spark, name) or ""))
        if any(c.isPartition for c in spark.catalog.listColumns(name)):
            for r in spark.sql(f"SHOW PARTITIONS {name}").collect():
                spec = ", ".join("`{}` = '{}'".format(*p.split("=", 1)) for p in r[0].split("/"))
                rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({spec})").where("col_name = 'Location'").collect()
                out.update(_plain(x["data_type"]) for x in rows)
    return out - {""}


def _version_folders(spark: SparkSession, root: str, database: str) -> dict[str, float]:
    """(folder, age in hours) of every ``v=`` folder of a database's tables."""
    fs, top = M.file_system(spark, f"{root}/{database}")
    out = {}
    for table in fs.listStatus(top) if fs.exists(top) else ():
        if table.isDirectory() and table.getPath().getName() != M.FOLDER:
            for v in fs.listStatus(table.getPath()):
                if v.getPath().getName().startswith("v="):
                    out[_plain(v.getPath().toString())] = (time.time() - v.getModificationTime() / 1000) / 3600
    return out


def sweep(spark: SparkSession, root: str, database: str, *, keep: int = 3, grace_hours: float = 24.0) -> Swept:
    """Remove superseded versions of a database's tables; returns what was removed."""
    there = M.numbers(spark, root, database)
    if keep < 1:
        raise ValueError("the newest state is always kept")
    held = set(there[-keep:]) | (pinned(spark, root, database) & set(there))
    states = {n: M.snapshot(spark, root, database, n) for n in there}

    def paths(numbers) -> set[str]:
        return {_plain(e.path) for n in numbers for e in states[n].tables.values() if e.path}
    live = paths(held) | _catalog_paths(spark, database)
    old = paths(set(there) - held)

    def used(folder: str) -> bool:
        return any(p == folder or p.startswith(f"{folder}/") or folder.startswith(f"{p}/") for p in live)
    gone = sorted(p for p in old if not used(p))
    for folder, age in _version_folders(spark, root, database).items():
        superseded = any(p == folder or p.startswith(f"{folder}/") for p in old)
        if not used(folder) and (superseded or age > grace_hours):
            gone.append(folder)
    removed = []
    for p in dict.fromkeys(gone):
        fs, path = M.file_system(spark, p)
        if fs.exists(path) and fs.delete(path, True):
            removed.append(p)
    for n in sorted(set(there) - held):
        fs, path = M.file_system(spark, M._file(root, database, n))
        fs.delete(path, False)
    definitions = [f"{database}.{t.name}" for t in spark.catalog.listTables(database) if REPLACED in t.name] \
        if spark.catalog.databaseExists(database) else []
    for name in definitions:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return Swept(tuple(removed), tuple(sorted(set(there) - held)), tuple(definitions))
