"""Superseded versions go, live ones stay."""

from pathlib import Path

import pytest

from tessera.plans import manifest as M
from tessera.plans import publish as P
from tessera.plans import retention as R


def folders(tmp_path, db, table):
    return len(list((tmp_path / db / table).glob("v=*")))


def test_after_five_reloads_exactly_n_folders_remain(spark, tmp_path):
    root = str(tmp_path)
    P.ensure_database(spark, "rt_a", root)
    for n in range(5):
        P.publish(spark, spark.range(n + 1), "rt_a.t", root)
    P.publish(spark, spark.range(9), "rt_a.other", root)
    done = R.sweep(spark, root, "rt_a", keep=3)
    # the newest three manifests name versions 4 and 5 of t, and the one of other
    assert folders(tmp_path, "rt_a", "t") == 2 and folders(tmp_path, "rt_a", "other") == 1 and len(done.removed) == 3
    assert M.numbers(spark, root, "rt_a") == [4, 5, 6] and done.manifests == (1, 2, 3)
    assert (spark.table("rt_a.t").count(), spark.table("rt_a.other").count()) == (5, 9)
    assert [M.snapshot(spark, root, "rt_a", n).table(spark, "t").count() for n in (4, 5, 6)] == [4, 5, 5]
    assert R.sweep(spark, root, "rt_a", keep=3) == R.Swept((), (), ())
    P.publish(spark, spark.range(7), "rt_a.t", root)
    assert M.snapshot(spark, root, "rt_a").number == 7


def test_pinned_snapshots_stay(spark, tmp_path):
    root = str(tmp_path)
    P.ensure_database(spark, "rt_b", root)
    P.publish(spark, spark.range(1), "rt_b.t", root)
    first = M.snapshot(spark, root, "rt_b")
    R.pin(spark, first, "report")
    for n in (2, 3, 4):
        P.publish(spark, spark.range(n), "rt_b.t", root)
    R.sweep(spark, root, "rt_b", keep=1)
    assert first.table(spark, "t").count() == 1 and M.numbers(spark, root, "rt_b") == [1, 4]
    R.unpin(spark, first, "report")
    R.sweep(spark, root, "rt_b", keep=1)
    assert folders(tmp_path, "rt_b", "t") == 1 and spark.table("rt_b.t").count() == 4
    with pytest.raises(RuntimeError, match="swept already"):
        R.pin(spark, first, "late")


def test_uncommitted_versions_have_their_grace(spark, tmp_path):
    root = str(tmp_path)
    P.ensure_database(spark, "rt_c", root)
    P.publish(spark, spark.range(1), "rt_c.t", root)
    base = M.snapshot(spark, root, "rt_c")
    v = P.stage_version(spark.range(2), "rt_c.t", root)  # a writer that has not committed yet
    assert R.sweep(spark, root, "rt_c", keep=1).removed == ()
    P.publish_versions(spark, [v], root, base)
    assert spark.table("rt_c.t").count() == 2
    P.stage_version(spark.range(3), "rt_c.t", root)
    assert len(R.sweep(spark, root, "rt_c", keep=1, grace_hours=-1).removed) == 2 and spark.table("rt_c.t").count() == 2


def test_partitions_and_replaced_definitions(spark, tmp_path):
    root = str(tmp_path)
    P.ensure_database(spark, "rt_d", root)
    schema = "id bigint, v string, batch_id bigint"
    P.publish_partitions(spark, spark.createDataFrame([(1, "a", 0), (2, "b", 1)], schema), "rt_d.p", root, "batch_id")
    P.publish_partitions(spark, spark.createDataFrame([(3, "c", 1)], schema), "rt_d.p", root, "batch_id")
    P.publish(spark, spark.range(2), "rt_d.t", root)
    P.publish(spark, spark.range(3).selectExpr("cast(id AS string) AS id"), "rt_d.t", root)
    done = R.sweep(spark, root, "rt_d", keep=1, grace_hours=-1)
    assert len(done.definitions) == 1 and not [t for t in spark.catalog.listTables("rt_d") if "__replaced_" in t.name]
    assert spark.table("rt_d.t").count() == 3
    assert sorted(map(tuple, spark.table("rt_d.p").collect())) == [(1, "a", 0), (3, "c", 1)]
    assert Path(done.removed[0]).name.startswith("v=")
