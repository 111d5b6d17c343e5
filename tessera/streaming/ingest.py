"""Incremental landing of JSON documents with Structured Streaming.

Root step: a file stream source over the landing folder with ``trigger(availableNow=True)``:
each run processes exactly the files not seen before (tracked in the checkpoint) and stops. The
history of names never expires and the age of a file plays no part: a file that is older than
others lands once, and a file rewritten under a name already seen is ignored. A run is one
micro-batch by default, so it lands whole or not at all. Every micro-batch is written to the landing table partitioned by ``batch_id`` with dynamic
partition overwrite, so a batch replayed after a failure replaces its own partition instead of
duplicating rows. A malformed file fails the batch (FAILFAST): nothing of it lands.

Dependent step: only when the root step succeeded, the staging table is rebuilt from the
landing table (outer flatten) and published as a new version. With ``incremental=True`` the
staging table is partitioned by ``batch_id`` and only the batches not yet in it (this run's,
plus any landed by an earlier run whose child did not finish) are flattened and published as
partitions, so a run costs its new documents rather than the whole history. Both steps append
a row to the run history.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.plans import audit as A
from tessera.session import error_text
from tessera.plans.publish import Version, partition_values, publish, publish_partitions

ROOT_TASK = "ingest_claims_root"
CHILD_TASK = "flatten_claims_child"
# Names are never forgotten and old files never skipped (Spark's default is seven days).
FOREVER = "36500d"


@dataclass(frozen=True)
class IngestRun:
    ok: bool
    batches: int
    rows: int
    error: str | None = None
    staged: Version | None = None


def _now() -> _dt.datetime:
    return A.utc_now()


def document_stream(spark: SparkSession, source_glob: str, *, outer_array: bool = False,
                    column: str = "raw", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.format("json").option("singleVariantColumn", column)
              .option("multiLine", outer_array).option("mode", "FAILFAST").option("maxFileAge", FOREVER))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(source_glob).select(
        F.col(column), F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_path").alias("_source_path"))
    if outer_array:
        df = df.select(F.explode(F.variant_get(F.col(column), "$", "array<variant>")).alias(column),
                       "_source_file", "_source_path")
    return df


def write_landing_batch(batch: DataFrame, batch_id: int, landing_path: str) -> int:
    """Write one micro-batch into its own ``batch_id`` partition (dynamic overwrite): a batch
    replayed after a failure replaces its partition instead of adding a second copy.
    Returns the rows written (observed on the write itself)."""
    out = batch.select("*", F.current_timestamp().cast("timestamp_ntz").alias("_loaded_at"),
                       F.lit(batch_id).cast("bigint").alias("batch_id"))
    obs = Observation(f"landing_{batch_id}_{uuid.uuid4().hex[:6]}")
    (out.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
     .parquet(landing_path))
    return int(obs.get["n"])


def ingest_new_files(spark: SparkSession, source_glob: str, landing_path: str,
                     checkpoint: str, *, outer_array: bool = False,
                     max_files_per_trigger: int | None = None,
                     batch_ids: list[int] | None = None,
                     stats: dict[str, int] | None = None) -> tuple[int, int]:
    """Run the root step once; returns (batches, rows) landed in this run. The ids of the
    batches written are appended to ``batch_ids`` when given, and ``stats`` counts what landed
    also when a later batch fails (possible only with ``max_files_per_trigger``)."""
    stats = {} if stats is None else stats
    stats |= {"batches": 0, "rows": 0}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        stats["rows"] += write_landing_batch(batch, batch_id, landing_path)
        stats["batches"] += 1
        if batch_ids is not None:
            batch_ids.append(batch_id)

    stream = document_stream(spark, source_glob, outer_array=outer_array,
                             max_files_per_trigger=max_files_per_trigger)
    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return stats["batches"], stats["rows"]


def read_landing(spark: SparkSession, landing_path: str) -> DataFrame:
    """The landing table; ``batch_id`` is typed explicitly (a partition column's type would
    otherwise be inferred from folder names)."""
    return spark.read.parquet(landing_path).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def landed_batch_ids(spark: SparkSession, landing_path: str) -> set[str]:
    """Batch ids present in the landing folder, from its ``batch_id=`` folder names (a
    listing bounded by the number of batches; no data read)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(landing_path)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return set()
    names = [st.getPath().getName() for st in fs.listStatus(path) if st.isDirectory()]
    return {n.split("=", 1)[1] for n in names if n.startswith("batch_id=")}


def _rebuild_staging(spark: SparkSession, landing: str, rebuild, staging_table: str, root: str,
                     incremental: bool, new_ids: list[int]) -> Version | None:
    """Full rebuild, or (incremental) the batches landed but not yet in staging. A batch whose
    rebuild yields no rows (possible with an inner flatten) never gets a partition, so it is
    flattened again on later runs: cheap, and the result stays equal to a full rebuild."""
    if not incremental:
        return publish(spark, rebuild(read_landing(spark, landing)), staging_table, root)
    if spark.catalog.tableExists(staging_table) and "batch_id" not in {
            c.name for c in spark.catalog.listColumns(staging_table) if c.isPartition}:
        raise ValueError(f"{staging_table} is not partitioned by batch_id; "
                         "incremental mode needs a staging table it created")
    pending = (landed_batch_ids(spark, landing)
               - partition_values(spark, staging_table, "batch_id")) | {str(b) for b in new_ids}
    if not pending:
        return None
    todo = read_landing(spark, landing).where(
        F.col("batch_id").isin([int(b) for b in sorted(pending)]))
    return publish_partitions(spark, rebuild(todo), staging_table, root, "batch_id")


def run_ingest(spark: SparkSession, source_glob: str, root: str, *,
               rebuild: Callable[[DataFrame], DataFrame] | None = None,
               staging_table: str | None = None, outer_array: bool = False,
               incremental: bool = False,
               max_files_per_trigger: int | None = None) -> IngestRun:
    """Root step, then (only on success) the dependent rebuild + publish; history recorded. The
    run is one batch unless ``max_files_per_trigger`` cuts it into separately committed ones; the
    counts returned are of what has landed, also after a failure. ``incremental``: only batches missing from the staging table are flattened (the rebuild
    must keep ``batch_id``)."""
    landing = f"{root}/landing/claims"
    checkpoint = f"{root}/checkpoints/claims"
    started = _now()
    new_ids: list[int] = []
    landed = {"batches": 0, "rows": 0}
    try:
        batches, rows = ingest_new_files(spark, source_glob, landing, checkpoint,
                                         outer_array=outer_array, batch_ids=new_ids,
                                         max_files_per_trigger=max_files_per_trigger, stats=landed)
        A.record_run(spark, root, ROOT_TASK, "SUCCEEDED", started, _now())
    except Exception as e:  # noqa: BLE001 - recorded and returned; the child does not run
        msg = error_text(e)
        A.record_run(spark, root, ROOT_TASK, "FAILED", started, _now(), msg)
        return IngestRun(False, landed["batches"], landed["rows"], msg)
    staged = None
    if rebuild is not None and staging_table:
        child_start = _now()
        try:
            staged = _rebuild_staging(spark, landing, rebuild, staging_table, root, incremental,
                                      new_ids)
            A.record_run(spark, root, CHILD_TASK, "SUCCEEDED", child_start, _now())
        except Exception as e:  # noqa: BLE001
            msg = error_text(e)
            A.record_run(spark, root, CHILD_TASK, "FAILED", child_start, _now(), msg)
            return IngestRun(False, batches, rows, msg)
    return IngestRun(True, batches, rows, None, staged)
