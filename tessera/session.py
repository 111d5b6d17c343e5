"""Session construction and the shared work folder.

All intermediate files (landing files, staged versions, manifests, stream checkpoints) go under
the folder named by ``spark.checkpoint.dir``. On a cluster that setting points at shared storage
(HDFS, object store) and must be set by whoever launches the job; only when it is unset (local
runs, tests) do we fall back to a fresh local folder and set it ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Local/test session with the settings the library assumes (AQE on, UTC, no UI)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
    )
    if master:
        builder = builder.master(master)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Only a local session that does not
    set it gets a local folder; on a cluster every executor would see another one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(root)
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 - some deployments refuse core confs at runtime
            pass
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the shared work root for one job's files."""
    return f"{checkpoint_root(spark)}/tessera/{name}-{uuid.uuid4().hex[:12]}"


def error_text(e: BaseException) -> str:
    """The whole message of a Spark/py4j error with its causes, without stack frames; the py4j
    call, which often comes first, is left out when something more telling follows."""
    lines = [ln.strip() for ln in str(e).splitlines() if ln.strip()]
    lines = [ln for ln in lines if not re.match(r"at [\w.$/]+\(|\.\.\. \d+ more|JVM stacktrace:", ln)]
    told = next((i for i, ln in enumerate(lines) if ln.startswith(("org.apache.spark", "pyspark.", "["))
                 or "Exception:" in ln), 0)
    return "\n".join(dict.fromkeys(lines[told:])) or type(e).__name__
