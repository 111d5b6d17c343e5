"""Load audit: one append-only row per processed file (or failed attempt)."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = ("id string, table_name string, file string, rows bigint, status string, "
                "error string, loaded_at timestamp_ntz")
LOADED, LOAD_FAILED, PARTIALLY_LOADED = "LOADED", "LOAD_FAILED", "PARTIALLY_LOADED"
RUN_SCHEMA = ("name string, state string, scheduled_time timestamp_ntz, "
              "completed_time timestamp_ntz, error_message string")


def audit_path(root: str) -> str:
    return f"{root}/control/load_audit"


def _batch(path: str) -> str:
    """Each append writes its own new sub-folder, so concurrent writers (parallel table loads,
    several jobs) never share a commit folder; readers list the folder recursively."""
    return f"{path}/batch-{uuid.uuid4().hex}"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


def utc_now() -> _dt.datetime:
    """All control-table times are UTC wall-clock times without zone (TIMESTAMP_NTZ)."""
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def record(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    """Append audit rows (table, file, rows, status, error); ids are run-unique uuids."""
    now = utc_now()
    data = [(uuid.uuid4().hex, t.upper(), f, n, s, e, now) for t, f, n, s, e in rows]
    spark.createDataFrame(data, AUDIT_SCHEMA).write.mode("error").parquet(_batch(audit_path(root)))


def record_frame(root: str, df: DataFrame) -> None:
    """Append audit rows computed by Spark (table_name, file, rows, status, error): per-file
    rows never pass through the driver."""
    df.select(F.expr("uuid()").alias("id"), F.upper("table_name").alias("table_name"),
              F.col("file").cast("string"), F.col("rows").cast("bigint"),
              F.col("status").cast("string"), F.col("error").cast("string"),
              F.lit(utc_now().isoformat(sep=" ")).cast("timestamp_ntz").alias("loaded_at")) \
        .write.mode("error").parquet(_batch(audit_path(root)))


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, audit_path(root), AUDIT_SCHEMA)


def latest(audit: DataFrame, n: int = 20) -> DataFrame:
    """Latest loads first (top-n: each task keeps n rows, then one merge)."""
    return audit.orderBy(F.desc("loaded_at"), F.desc("id")).limit(n)


def rows_loaded(audit: DataFrame) -> DataFrame:
    """Rows loaded per table; a missing count counts as 0."""
    return audit.groupBy("table_name").agg(
        F.sum(F.coalesce(F.col("rows"), F.lit(0))).alias("rows_loaded"))


def per_file_counts(df: DataFrame, file_column: str = "_source_file") -> DataFrame:
    """Rows per source file from a staged version's lineage column (one narrow column read)."""
    return df.groupBy(file_column).agg(F.count(F.lit(1)).alias("rows"))


def run_history_path(root: str) -> str:
    return f"{root}/control/run_history"


def record_run(spark: SparkSession, root: str, name: str, state: str,
               scheduled: _dt.datetime, completed: _dt.datetime | None,
               error: str | None = None) -> None:
    spark.createDataFrame([(name, state, scheduled, completed, error)], RUN_SCHEMA) \
        .write.mode("error").parquet(_batch(run_history_path(root)))


def run_history(spark: SparkSession, root: str, *, name: str | None = None,
                hours: int = 6, limit: int = 10) -> DataFrame:
    """Runs of the last ``hours`` hours, newest first, at most ``limit``."""
    h = _read(spark, run_history_path(root), RUN_SCHEMA)
    since = F.lit((utc_now() - _dt.timedelta(hours=hours)).isoformat(sep=" ")).cast("timestamp_ntz")
    if name:
        h = h.where(F.col("name") == name)
    return (h.where(F.col("scheduled_time") >= since)
            .orderBy(F.desc("scheduled_time"), F.asc("name")).limit(limit))
