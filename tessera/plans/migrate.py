"""Schema evolution of published tables.

Adding a nullable column is a catalog change (old rows read NULL, nothing is rewritten).
Changing a column's type cannot happen in place on Parquet: the table is rewritten with the
cast as a new version and swapped in (the old version stays readable until the swap).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.plans.publish import Version, publish


def add_columns(spark: SparkSession, table: str, columns: dict[str, str]) -> None:
    cols = ", ".join(f"`{n}` {t}" for n, t in columns.items())
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")


def change_column_type(spark: SparkSession, table: str, column: str, new_type: str,
                       root: str) -> Version:
    df = spark.table(table)
    out = df.select(*[F.col(c).cast(new_type).alias(c) if c == column else F.col(c)
                      for c in df.columns])
    return publish(spark, out, table, root)
