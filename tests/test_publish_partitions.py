import pytest
from pyspark.sql import functions as F

from tessera.plans.publish import ensure_database, partition_values, publish_partitions

SCHEMA = "k bigint, v string, batch_id bigint"


def rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).select("k", "v", "batch_id").collect())


def test_replayed_partition_replaces_only_itself(spark, tmp_path):
    root = str(tmp_path)
    ensure_database(spark, "pp_a", root)
    publish_partitions(spark, spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 1)], SCHEMA),
                       "pp_a.t", root, "batch_id")
    v = publish_partitions(spark, spark.createDataFrame([(9, "z", 0)], SCHEMA), "pp_a.t", root,
                           "batch_id")
    assert v.rows == 1
    assert rows(spark, "pp_a.t") == [(3, "c", 1), (9, "z", 0)]
    assert partition_values(spark, "pp_a.t", "batch_id") == {"0", "1"}
    assert spark.table("pp_a.t").where("batch_id = 1").count() == 1


def test_failed_partition_write_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    ensure_database(spark, "pp_b", root)
    publish_partitions(spark, spark.createDataFrame([(1, "a", 0)], SCHEMA), "pp_b.t", root,
                       "batch_id")
    bad = spark.createDataFrame([(2, "b", 0), (3, "c", 1)], SCHEMA).withColumn(
        "v", F.when(F.col("k") == 3, F.raise_error(F.lit("boom"))).otherwise(F.col("v")))
    with pytest.raises(Exception):
        publish_partitions(spark, bad, "pp_b.t", root, "batch_id")
    assert rows(spark, "pp_b.t") == [(1, "a", 0)]
    assert partition_values(spark, "pp_b.t", "batch_id") == {"0"}


def test_full_publish_over_a_partitioned_table_replaces_its_partitions(spark, tmp_path):
    from tessera.plans.publish import publish

    root = str(tmp_path)
    ensure_database(spark, "pp_c", root)
    publish_partitions(spark, spark.createDataFrame([(1, "a", 0), (2, "b", 1)], SCHEMA), "pp_c.t",
                       root, "batch_id")
    publish(spark, spark.createDataFrame([(7, "x", 0)], SCHEMA), "pp_c.t", root)
    assert rows(spark, "pp_c.t") == [(7, "x", 0)]


def test_string_partition_values(spark, tmp_path):
    root = str(tmp_path)
    ensure_database(spark, "pp_d", root)
    schema = "k bigint, region string"
    publish_partitions(spark, spark.createDataFrame([(1, "north"), (2, "o'hare / east")], schema),
                       "pp_d.t", root, "region")
    assert partition_values(spark, "pp_d.t", "region") == {"north", "o'hare / east"}
    publish_partitions(spark, spark.createDataFrame([(3, "o'hare / east")], schema), "pp_d.t",
                       root, "region")
    got = sorted(tuple(r) for r in spark.table("pp_d.t").select("k", "region").collect())
    assert got == [(1, "north"), (3, "o'hare / east")]


def test_partitions_with_another_schema_are_refused(spark, tmp_path):
    from tessera.plans.publish import PublishError

    root = str(tmp_path)
    ensure_database(spark, "pp_e", root)
    publish_partitions(spark, spark.createDataFrame([(1, "a", 0)], SCHEMA), "pp_e.t", root,
                       "batch_id")
    wider = spark.createDataFrame([(2, "b", 1.5, 1)], "k bigint, v string, w double, batch_id bigint")
    with pytest.raises(PublishError, match="rebuild the table in full"):
        publish_partitions(spark, wider, "pp_e.t", root, "batch_id")
    assert rows(spark, "pp_e.t") == [(1, "a", 0)]


def test_metadata_helpers_on_missing_inputs(spark, tmp_path):
    from tessera.streaming.ingest import landed_batch_ids, write_landing_batch

    assert landed_batch_ids(spark, str(tmp_path / "nothing-here")) == set()
    assert partition_values(spark, "pp_none.t", "batch_id") == set()
    land = str(tmp_path / "landing")
    write_landing_batch(spark.range(2).select(F.parse_json(F.to_json(F.struct("id"))).alias("raw")),
                        7, land)
    assert landed_batch_ids(spark, land) == {"7"}
