"""Bucketed tables: files read by a lookup, joins without an exchange."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessera.plans import layout as L
from tessera.plans import manifest as M
from tessera.plans import publish as P


def rows(spark, n, times=1):
    return spark.range(n * times).select((F.col("id") % n).alias("k"), F.col("id").alias("v"))


def test_a_lookup_reads_one_bucket(spark, tmp_path):
    root = str(tmp_path)
    P.ensure_database(spark, "ly_a", root)
    for times in (3, 4):  # the second version takes the same place
        L.publish_bucketed(spark, rows(spark, 500, times), "ly_a.t", root, "k", buckets=16, sort=("v",))
        found = spark.table("ly_a.t").where("k = 7")
        assert sorted(r["v"] for r in found.collect()) == [7 + 500 * i for i in range(times)]
    assert M.snapshot(spark, root, "ly_a").table(spark, "t").count() == 2000
    assert L.bucket_spec(spark, "ly_a.t") == (16, ("k",))
    with pytest.raises(P.PublishError, match="another name"):
        L.publish_bucketed(spark, rows(spark, 5), "ly_a.t", root, "k", buckets=8)
    # with every other file of the version damaged the lookup still works: it opens one
    own = {r[0] for r in spark.table("ly_a.t").where("k = 7").select("_metadata.file_path").distinct().collect()}
    live = Path(M.snapshot(spark, root, "ly_a").entry("t").path)
    files = sorted(live.glob("part-*.parquet"))
    assert len(own) == 1 and len(files) == 16
    for f in files:
        if f.name not in own.copy().pop():
            f.write_bytes(b"damaged")
    spark.sql("REFRESH TABLE ly_a.t")
    assert spark.table("ly_a.t").where("k = 7").count() == 4
    with pytest.raises(Exception):
        spark.table("ly_a.t").where("v = 7").collect()


def test_equal_buckets_join_without_an_exchange(spark, tmp_path):
    root = str(tmp_path)
    P.ensure_database(spark, "ly_b", root)
    L.publish_bucketed(spark, rows(spark, 300), "ly_b.parent", root, "k", buckets=8)
    L.publish_bucketed(spark, rows(spark, 300, 5), "ly_b.child", root, "k", buckets=8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("ly_b.child").join(spark.table("ly_b.parent").withColumnRenamed("v", "w"), "k")
        assert joined.count() == 1500
        executed = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in executed and not re.search(r"\bExchange\b", executed)
