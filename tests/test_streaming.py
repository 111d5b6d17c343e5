import json
import os
import time

from tessera.operators.flatten import CLAIM_SPEC, flatten
from tessera.plans import audit as A
from tessera.plans.publish import ensure_database
from tessera.streaming.ingest import read_landing, run_ingest


def docs(ids):
    return "\n".join(json.dumps({"claim_id": f"C{i}", "policy_number": "P", "vin": "V",
                                 "reported_at": "2026-08-01T00:00:00", "incident_type": "theft",
                                 "estimated_damage_usd": 1.0,
                                 "involved_parties": [{"name": "n"}] * (i % 3)}) for i in ids)


def test_incremental_runs_and_replay(spark, tmp_path):
    root = str(tmp_path / "store")
    ensure_database(spark, "rj_t", root)
    src = tmp_path / "src"
    (src / "w1").mkdir(parents=True)
    (src / "w1" / "a.json").write_text(docs(range(4)))
    glob = str(src) + "/*/"

    def rebuild(landing):
        return flatten(landing, CLAIM_SPEC, outer=True, keep=("batch_id",))
    r1 = run_ingest(spark, glob, root, rebuild=rebuild, staging_table="rj_t.stg")
    assert r1.ok and r1.rows == 4
    r2 = run_ingest(spark, glob, root, rebuild=rebuild, staging_table="rj_t.stg")
    assert r2.ok and r2.rows == 0
    (src / "w2").mkdir()
    (src / "w2" / "b.json").write_text(docs([10]))
    time.sleep(0.05)
    # rewriting an already seen file under the same name is ignored
    (src / "w1" / "a.json").write_text(docs(range(100, 110)))
    os.utime(src / "w1" / "a.json")
    r3 = run_ingest(spark, glob, root, rebuild=rebuild, staging_table="rj_t.stg")
    assert r3.ok and r3.rows == 1
    land = read_landing(spark, f"{root}/landing/claims")
    assert land.count() == 5
    assert spark.table("rj_t.stg").count() == sum(max(1, i % 3) for i in [0, 1, 2, 3, 10])
    states = [r["state"] for r in A.run_history(spark, root).collect()]
    assert states.count("SUCCEEDED") == 6


def test_malformed_file_fails_root_and_skips_child(spark, tmp_path):
    root = str(tmp_path / "store")
    ensure_database(spark, "rj_t2", root)
    src = tmp_path / "src" / "w1"
    src.mkdir(parents=True)
    (src / "a.json").write_text(docs(range(3)) + "\n{not json")
    r = run_ingest(spark, str(tmp_path / "src") + "/*/", root,
                   rebuild=lambda df: df, staging_table="rj_t2.stg")
    assert not r.ok
    assert not spark.catalog.tableExists("rj_t2.stg")
    hist = A.run_history(spark, root).collect()
    assert [(h["name"], h["state"]) for h in hist] == [("ingest_claims_root", "FAILED")]


def test_replayed_batch_leaves_one_copy_and_max_files(spark, tmp_path):
    from pyspark.sql import functions as F

    from tessera.streaming.ingest import ingest_new_files, write_landing_batch

    landing = str(tmp_path / "landing")
    batch = spark.range(5).select(F.parse_json(F.to_json(F.struct("id"))).alias("raw"))
    assert write_landing_batch(batch, 0, landing) == 5
    assert write_landing_batch(spark.range(3).select(F.parse_json(F.to_json(F.struct("id")))
                                                     .alias("raw")), 1, landing) == 3
    assert write_landing_batch(batch, 0, landing) == 5  # replay of batch 0
    counts = {r["batch_id"]: r["count"] for r in
              spark.read.parquet(landing).groupBy("batch_id").count().collect()}
    assert counts == {0: 5, 1: 3}

    src = tmp_path / "src" / "w"
    src.mkdir(parents=True)
    for i in range(3):
        (src / f"f{i}.json").write_text(docs(range(i * 10, i * 10 + 2)))
    b, n = ingest_new_files(spark, str(tmp_path / "src") + "/*/", str(tmp_path / "land2"),
                            str(tmp_path / "ck2"), max_files_per_trigger=1)
    assert (b, n) == (3, 6)


def test_incremental_staging_flattens_only_new_batches(spark, tmp_path):
    from tessera.plans.publish import partition_values

    root = str(tmp_path / "store")
    ensure_database(spark, "rj_inc", root)
    src = tmp_path / "src"
    glob = str(src) + "/*/"
    seen = []
    fail = {"next": False}

    def rebuild(landing):
        seen.append(sorted(r["batch_id"] for r in landing.select("batch_id").distinct().collect()))
        if fail["next"]:
            fail["next"] = False
            raise RuntimeError("child failed")
        return flatten(landing, CLAIM_SPEC, outer=True, keep=("batch_id",))

    def full():
        land = read_landing(spark, f"{root}/landing/claims")
        return sorted(tuple(r) for r in flatten(land, CLAIM_SPEC, outer=True, keep=("batch_id",))
                      .collect())

    def staged():
        cols = flatten(read_landing(spark, f"{root}/landing/claims"), CLAIM_SPEC, outer=True,
                       keep=("batch_id",)).columns
        return sorted(tuple(r) for r in spark.table("rj_inc.stg").select(*cols).collect())

    for i, ids in enumerate([range(4), range(10, 12), range(20, 23)]):
        (src / f"w{i}").mkdir(parents=True)
        (src / f"w{i}" / "a.json").write_text(docs(ids))
        if i == 1:
            fail["next"] = True   # batch 1 lands, its child step fails
            r = run_ingest(spark, glob, root, rebuild=rebuild, staging_table="rj_inc.stg",
                           incremental=True)
            assert not r.ok and r.rows == 2
            continue
        r = run_ingest(spark, glob, root, rebuild=rebuild, staging_table="rj_inc.stg",
                       incremental=True)
        assert r.ok
        assert staged() == full()
    # run 0 flattened batch 0; run 1 tried batch 1 and failed; run 2 caught up 1 and 2
    assert seen == [[0], [1], [1, 2]]
    assert partition_values(spark, "rj_inc.stg", "batch_id") == {"0", "1", "2"}
    # nothing new: no child work at all
    r = run_ingest(spark, glob, root, rebuild=rebuild, staging_table="rj_inc.stg",
                   incremental=True)
    assert r.ok and r.rows == 0 and r.staged is None and len(seen) == 3
    assert spark.table("rj_inc.stg").where("batch_id = 2").count() == sum(
        max(1, i % 3) for i in range(20, 23))


def test_one_run_in_several_bounded_batches(spark, tmp_path):
    from tessera.plans.publish import partition_values

    root = str(tmp_path / "store")
    ensure_database(spark, "rj_mb", root)
    src = tmp_path / "src" / "w"
    src.mkdir(parents=True)
    for i in range(3):
        (src / f"f{i}.json").write_text(docs(range(i * 10, i * 10 + 3)))

    def rebuild(landing):
        return flatten(landing, CLAIM_SPEC, outer=True, keep=("batch_id",))
    r = run_ingest(spark, str(tmp_path / "src") + "/*/", root, rebuild=rebuild,
                   staging_table="rj_mb.stg", incremental=True, max_files_per_trigger=1)
    assert r.ok and (r.batches, r.rows) == (3, 9)
    assert partition_values(spark, "rj_mb.stg", "batch_id") == {"0", "1", "2"}
    land = read_landing(spark, f"{root}/landing/claims")
    assert sorted(tuple(x) for x in rebuild(land).collect()) == sorted(
        tuple(x) for x in spark.table("rj_mb.stg").select(*rebuild(land).columns).collect())


def test_incremental_run_without_files_does_nothing(spark, tmp_path):
    root = str(tmp_path / "store")
    ensure_database(spark, "rj_empty", root)
    (tmp_path / "src" / "w").mkdir(parents=True)
    r = run_ingest(spark, str(tmp_path / "src") + "/*/", root,
                   rebuild=lambda df: flatten(df, CLAIM_SPEC, outer=True, keep=("batch_id",)),
                   staging_table="rj_empty.stg", incremental=True)
    assert r.ok and (r.batches, r.rows) == (0, 0) and r.staged is None
    assert not spark.catalog.tableExists("rj_empty.stg")


def test_old_files_land_once_and_a_bad_run_lands_nothing(spark, tmp_path):
    root = str(tmp_path / "store")
    src = tmp_path / "src"
    src.mkdir()
    (src / "new.json").write_text(docs([1]))
    assert run_ingest(spark, str(src), root).rows == 1
    (src / "old.json").write_text(docs([2, 3]))
    month = 30 * 86400
    os.utime(src / "old.json", (time.time() - month,) * 2)  # older than the newest file by a month
    assert run_ingest(spark, str(src), root).rows == 2
    (src / "old.json").write_text(docs([2, 3, 4]))  # rewritten: its name has landed
    assert run_ingest(spark, str(src), root).rows == 0
    (src / "good.json").write_text(docs([7]))
    (src / "bad.json").write_text("{not json")
    r = run_ingest(spark, str(src), root)
    assert (r.ok, r.batches, r.rows) == (False, 0, 0)
    assert read_landing(spark, f"{root}/landing/claims").count() == 3
