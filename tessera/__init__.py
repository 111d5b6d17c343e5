"""tessera: contract-driven ingest, flatten, data-quality, payment and masking jobs on Spark.

Every operator takes and returns DataFrames; the heavy work is planned by Catalyst and run by
Spark executors. Driver-side code only handles schema metadata and file-system metadata.
"""

from tessera.session import build_session, work_path

__all__ = ["build_session", "work_path"]
