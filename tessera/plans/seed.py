"""Full rebuild of a set of tables from seed files, all or nothing, with a count check.

Each seed is typed by its contract; every table is written as a new version first (row count
observed on the write), compared with the expected count, and only then are all tables
swapped. Any failure leaves every table on its previous version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.plans.publish import ensure_database, publish_all, table_counts
from tessera.sources.contracts import TableContract
from tessera.sources.readers import read_seed


def rebuild_from_seeds(spark: SparkSession, contracts: dict[str, TableContract],
                       seeds: dict[str, str], root: str, *, schema: str = "raw",
                       expected: dict[str, int] | None = None,
                       multi_line: bool = True) -> DataFrame:
    """Returns (table_name, expected_rows, rows) per table; raises before publishing when a
    count differs from ``expected``."""
    ensure_database(spark, schema, root)
    frames = {f"{schema}.{n}": read_seed(spark, seeds[n], c, multi_line=multi_line)
              for n, c in contracts.items() if n in seeds}
    exp = {f"{schema}.{n}": v for n, v in (expected or {}).items()}
    versions = publish_all(spark, frames, root, expected_rows=exp)
    rows = [(name, exp.get(name), v.rows) for name, v in versions.items()]
    return spark.createDataFrame(rows, "table_name string, expected_rows bigint, rows bigint")


def presence_report(spark: SparkSession, names: list[str]) -> DataFrame:
    """Row count per table without writing; -1 for a table that does not exist."""
    return table_counts(spark, names)
