"""Tables laid out for how they are looked up and joined.

A bucketed publish deals the rows of a version into hash buckets of a key and sorts each bucket, one
file each. A lookup of one key then reads the file of its bucket (and in it the row groups whose range
fits), not every file of the table, and tables with equal buckets of a shared key are joined without
moving either. The buckets are part of the catalog table's definition; every later version of the
table is written with the same ones and takes its place by a change of location, committed in the
manifest like any other publish. All rows of a key share a bucket, so a key should be one that is
looked up or joined by, and not hold a large share of the rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.plans import manifest as M
from tessera.plans.publish import PublishError, Version, _ddl, database_of, new_version_id, publish_versions


def bucket_spec(spark: SparkSession, table: str) -> tuple[int, tuple[str, ...]] | None:
    """(buckets, key) of a catalog table, or None if it has none."""
    if not spark.catalog.tableExists(table):
        return None
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "Num Buckets" not in told:
        return None
    return int(told["Num Buckets"]), tuple(c.strip(" `") for c in told["Bucket Columns"].strip("[]").split(","))


def publish_bucketed(spark: SparkSession, df: DataFrame, table: str, root: str, key: str, *, buckets: int,
                     sort: tuple[str, ...] = ()) -> Version:
    """Publish a version of ``table`` in ``buckets`` hash buckets of ``key``, sorted by it and ``sort``."""
    have = bucket_spec(spark, table)
    if spark.catalog.tableExists(table) and have != (buckets, (key,)):
        raise PublishError(f"{table} has buckets {have}, not {buckets} of {key}; publish it under another name")
    base = M.snapshot(spark, root, database_of([table]))
    path = f"{root}/{table.replace('.', '/')}/v={new_version_id()}"
    writing = f"{table}__write_{uuid.uuid4().hex[:8]}"
    order = [key, *[c for c in sort if c != key]]
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    (df.observe(obs, F.count(F.lit(1)).alias("rows")).repartition(buckets, key).write.format("parquet").mode("error")
     .bucketBy(buckets, key).sortBy(*order).option("path", path).saveAsTable(writing))
    spark.sql(f"DROP TABLE {writing}")  # only the definition: the files belong to the version
    v = Version(table, path, int(obs.get["rows"]))
    if have is None:  # the first version brings the definition, still without a place of its own
        sorted_by = ", ".join(f"`{c}`" for c in order)
        spark.sql(f"CREATE TABLE {table} ({_ddl(df)}) USING parquet CLUSTERED BY (`{key}`) SORTED BY ({sorted_by}) "
                  f"INTO {buckets} BUCKETS LOCATION '{root}/{table.replace('.', '/')}/none'")
    publish_versions(spark, [v], root, base)
    return v
