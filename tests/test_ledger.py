"""Landing with a ledger of landed files."""

import json
import os

import pytest

from tessera.operators.flatten import CLAIM_SPEC, flatten
from tessera.plans import audit as A
from tessera.plans import manifest as M
from tessera.sources.readers import list_files
from tessera.streaming import ledger as L


def put(folder, name, docs, text=None):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text if text is not None else "".join(json.dumps(d) + "\n" for d in docs))


def claims(*ids):
    return [{"claim_id": i, "policy_number": "P1", "involved_parties": [{"name": "a"}, {"name": "b"}]} for i in ids]


def setup(spark, tmp_path, db):
    src, root = tmp_path / "src", str(tmp_path / "store")

    def run(**kw):
        return L.run(spark, lambda: list_files(spark, str(src), "*.json"), root, db,
                     rebuild=lambda df: flatten(df, CLAIM_SPEC, outer=True), **kw)

    def ids(table=L.LANDING):
        rows = L.read(spark, M.snapshot(spark, root, db), table)
        if rows is None:
            return []
        got = rows.selectExpr("variant_get(raw, '$.claim_id', 'string') AS c", "batch_id") if table == L.LANDING else rows
        return sorted((r[0], r["batch_id"]) for r in got.collect())
    return src, root, run, ids


def test_new_rewritten_old_and_malformed_files(spark, tmp_path):
    src, root, run, ids = setup(spark, tmp_path, "lg_a")
    put(src, "1.json", claims("a", "b"))
    put(src, "2.json", claims("c"))
    assert (run().rows, ids()) == (3, [("a", 0), ("b", 0), ("c", 0)])
    assert run().rows == 0  # nothing new: no batch
    put(src, "1.json", claims("changed"))  # a name already landed
    put(src, "3.json", claims("d"))
    os.utime(src / "3.json", (1000, 1000))  # older than any landed file
    assert (run().rows, ids()[-1]) == (1, ("d", 1))
    before, listed = M.snapshot(spark, root, "lg_a"), ids()
    put(src, "4.json", claims("e"))
    put(src, "5.json", None, '{"claim_id": \n')
    failed = run()
    assert not failed.ok and failed.rows == 0 and M.snapshot(spark, root, "lg_a") == before and ids() == listed
    put(src, "5.json", claims("f"))  # mended: both files land now
    assert run().rows == 2 and ids()[-2:] == [("e", 2), ("f", 2)]
    assert ids(L.STAGING) == sorted([(c, b) for c, b in ids() for _ in range(2)])
    assert [r["state"] for r in A.run_history(spark, root, name=L.ROOT_TASK).orderBy("scheduled_time").collect()] == [
        "SUCCEEDED", "SUCCEEDED", "SUCCEEDED", "FAILED", "SUCCEEDED"]


def test_many_files_go_in_batches(spark, tmp_path):
    src, root, run, ids = setup(spark, tmp_path, "lg_b")
    for i in range(23):
        put(src, f"{i:03d}.json", claims(f"c{i:03d}"))
    done = run(max_files=10)
    assert (done.ok, done.batches, done.rows) == (True, 3, 23)
    assert ids() == [(f"c{i:03d}", i // 10) for i in range(23)]
    known = L.read(spark, M.snapshot(spark, root, "lg_b"), L.LEDGER)
    assert known.select("path").distinct().count() == 23


def test_a_lost_or_second_run_lands_nothing_twice(spark, tmp_path, monkeypatch):
    src, root, run, ids = setup(spark, tmp_path, "lg_c")
    put(src, "1.json", claims("a"))
    real = M.commit
    monkeypatch.setattr(M, "commit", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        run()
    monkeypatch.setattr(M, "commit", real)
    assert ids() == []

    def beaten(spark_, base, changes, reads=()):  # another run commits the same batch first
        monkeypatch.setattr(M, "commit", real)
        assert run().rows == 1
        return real(spark_, base, changes, reads)
    monkeypatch.setattr(M, "commit", beaten)
    second = run()
    assert not second.ok and "changed" in second.error
    assert ids() == [("a", 0)] and ids(L.STAGING) == [("a", 0)] * 2


def test_failed_rebuild_is_made_up_for(spark, tmp_path):
    src, root, run, ids = setup(spark, tmp_path, "lg_d")
    put(src, "1.json", claims("a"))

    def broken(df):
        raise RuntimeError("no staging today")
    done = L.run(spark, lambda: list_files(spark, str(src), "*.json"), root, "lg_d", rebuild=broken)
    assert not done.ok and done.rows == 1 and ids(L.STAGING) == []
    put(src, "2.json", claims("b"))
    assert run().ok and ids(L.STAGING) == [("a", 0), ("a", 0), ("b", 1), ("b", 1)]
