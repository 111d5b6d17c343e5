"""Partitioned table extract from a database over JDBC.

Instead of fetching a whole table through one connection, the read is split into
``num_partitions`` ranges of a numeric column, each read by its own task. Bounds come from the
caller (or from one ``min/max`` query). Any DataFrame source can replace this; the rest of the
library only sees DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, *, column: str = "id",
               lower: int, upper: int, num_partitions: int, properties: dict | None = None,
               fetch_size: int = 10000) -> DataFrame:
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetch_size))
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=props)
