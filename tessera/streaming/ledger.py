"""Incremental landing with a ledger of landed files.

``streaming.ingest`` lets the file stream remember which files it has seen, and that history lives in
the driver's memory and checkpoint. Here it is a table: every batch adds the names it landed to a
ledger, and a run lands what the listing of its folder has and the ledger has not (an anti-join). The
driver holds the names of the files of one batch, at most ``max_files``, and never the history.

A batch's landing rows and ledger rows are written to new folders and become visible in one commit of
the database's manifest. A malformed file fails the batch before that, so ledger and landing stay as
they were and its good files land with a later run; a lost driver leaves the batch whole or not at
all; of two runs that land the same files one is refused. A file counts by its path: rewritten under
a name already landed it is ignored, and its age plays no part.

The dependent step rebuilds staging for the landed batches that have none, and commits each batch's
rows under the same number. The tables ``landing``, ``ledger`` and ``staging`` are read with
``read``; their batches carry ``batch_id``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans import audit as A
from tessera.plans import manifest as M
from tessera.session import error_text
from tessera.sources.readers import read_json_documents
from tessera.streaming.ingest import CHILD_TASK, ROOT_TASK, IngestRun

LANDING, LEDGER, STAGING = "landing", "ledger", "staging"
MAX_FILES = 10_000


def _entry(table: str, batch: int) -> str:
    return f"{table}/{batch:09d}"


def batches(state: M.Snapshot, table: str) -> list[int]:
    return sorted(int(n.partition("/")[2]) for n in state.tables if n.startswith(f"{table}/"))


def read(spark: SparkSession, state: M.Snapshot, table: str, only: list[int] | None = None) -> DataFrame | None:
    """The rows of some or all batches of a table, with ``batch_id``; None if there are none."""
    wanted = [b for b in batches(state, table) if only is None or b in only]
    if not wanted:
        return None
    entries = [state.tables[_entry(table, b)] for b in wanted]
    schema = T.StructType.fromJson(json.loads(entries[-1].schema))
    base = f"{state.root}/{state.database}/{table}"
    out = spark.read.schema(schema.add("batch_id", "long")).option("basePath", base).parquet(*[e.path for e in entries])
    return out.select(*schema.names)


def _write(spark: SparkSession, rows: DataFrame, table: str, state: M.Snapshot, batch: int) -> M.Entry:
    path = f"{state.root}/{state.database}/{table}/batch_id={batch}/run={uuid.uuid4().hex}"
    rows.write.mode("error").parquet(path)
    return M.Entry(path, spark.read.schema(rows.schema).parquet(path).count(), rows.schema.json(), str(batch))


def unlanded(spark: SparkSession, listing: DataFrame, state: M.Snapshot) -> DataFrame:
    """The files of a listing (``path``, ``size``, ``last_modified``) that no batch has landed."""
    known = read(spark, state, LEDGER)
    return listing if known is None else listing.join(known.select("path"), "path", "left_anti")


def land_batch(spark: SparkSession, listing: DataFrame, root: str, database: str, *, column: str = "raw",
               outer_array: bool = False, max_files: int = MAX_FILES) -> tuple[M.Snapshot, int, int]:
    """Land the next at most ``max_files`` files of a listing (by path); returns (state, files, rows).
    Raises when a file is malformed, or another run has landed a batch meanwhile."""
    state = M.snapshot(spark, root, database)
    found = unlanded(spark, listing, state).select("path", "size", "last_modified")
    files = found.orderBy("path").limit(max_files).collect()
    if not files:
        return state, 0, 0
    batch = (batches(state, LANDING) or [-1])[-1] + 1
    rows = read_json_documents(spark, [f["path"] for f in files], outer_array=outer_array, column=column)
    landing = _write(spark, rows, LANDING, state, batch)
    ledger = _write(spark, spark.createDataFrame([tuple(f) for f in files], found.schema),
                    LEDGER, state, batch)
    return M.commit(spark, state, {_entry(LANDING, batch): landing, _entry(LEDGER, batch): ledger}), len(files), landing.rows


def rebuild_missing(spark: SparkSession, rebuild: Callable[[DataFrame], DataFrame], root: str, database: str) -> M.Snapshot:
    """Flatten the landed batches without staging rows, one commit for each."""
    state = M.snapshot(spark, root, database)
    for batch in sorted(set(batches(state, LANDING)) - set(batches(state, STAGING))):
        entry = _write(spark, rebuild(read(spark, state, LANDING, [batch])), STAGING, state, batch)
        state = M.commit(spark, state, {_entry(STAGING, batch): entry}, reads=(_entry(LANDING, batch),))
    return state


def run(spark: SparkSession, listing: Callable[[], DataFrame], root: str, database: str, *,
        rebuild: Callable[[DataFrame], DataFrame] | None = None, outer_array: bool = False,
        max_files: int = MAX_FILES) -> IngestRun:
    """Land every new file of ``listing``, batch by batch, then (only if that went well) rebuild
    staging; both steps are recorded in the run history. Batches committed before a failing one stay."""
    started, landed, rows = A.utc_now(), 0, 0
    try:
        while True:
            _, files, n = land_batch(spark, listing(), root, database, outer_array=outer_array, max_files=max_files)
            landed, rows = landed + bool(files), rows + n
            if files < max_files:
                break
        A.record_run(spark, root, ROOT_TASK, "SUCCEEDED", started, A.utc_now())
    except Exception as e:  # noqa: BLE001 - recorded and returned; the dependent step does not run
        A.record_run(spark, root, ROOT_TASK, "FAILED", started, A.utc_now(), error_text(e))
        return IngestRun(False, landed, rows, error_text(e))
    if rebuild is not None:
        started = A.utc_now()
        try:
            rebuild_missing(spark, rebuild, root, database)
            A.record_run(spark, root, CHILD_TASK, "SUCCEEDED", started, A.utc_now())
        except Exception as e:  # noqa: BLE001
            A.record_run(spark, root, CHILD_TASK, "FAILED", started, A.utc_now(), error_text(e))
            return IngestRun(False, landed, rows, error_text(e))
    return IngestRun(True, landed, rows)
