"""Helpers shared by the operators: staged tables and row-safe filtering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import work_path

WHITE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(spark: SparkSession, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared work folder and read it back: later uses do not repeat the
    work, and a lost executor costs only what it was writing."""
    path = work_path(spark, f"llm-{name}")
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Hash buckets of ``split_by``: at most so many rows (about 64 MB) are broadcast, whatever the size
#: of the wanted keys.
BUCKETS = 1 << 22


def split_by(df: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose ``key`` falls in a hash bucket of the single column of ``wanted``
    (every match and few others), and the other rows. It spares a following exact join the shuffle
    of rows that cannot match."""
    bucket = fresh(df, "bucket")
    spots = F.broadcast(wanted.select(F.pmod(F.xxhash64(wanted.columns[0]), F.lit(BUCKETS)).alias(bucket)).distinct())
    tagged = df.withColumn(bucket, F.pmod(F.xxhash64(key), F.lit(BUCKETS)))
    return tagged.join(spots, bucket, "left_semi").drop(bucket), tagged.join(spots, bucket, "left_anti").drop(bucket)


def maybe_in(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    return split_by(df, key, wanted)[0]


def without(df: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``key`` is not in the single column of ``dropped``."""
    likely, others = split_by(df, key, dropped)
    return others.unionByName(likely.join(dropped, likely[key] == dropped[dropped.columns[0]], "left_anti"))
