"""Claims per policy kept batch by batch, against the whole report of all claims."""

import random
import shutil
from decimal import Decimal

import pytest

from tessera.operators import claims_state as S
from tessera.operators.claims import claims_by_policy
from tessera.plans import manifest as M

ROW = "claim_id string, policy_number string, estimated_damage_usd double, _loaded_at int"


def policies(spark):
    return spark.createDataFrame([(f"P{i}",) for i in range(9)], "policy_number string")


def report(df):
    return sorted(map(tuple, df.collect()))


def whole(spark, batches):
    """The newest row of each claim over all batches, summed up again."""
    newest = {c: (c, p, a, n) for n, b in enumerate(batches) for c, p, a, _ in b}
    return report(claims_by_policy(spark.createDataFrame(list(newest.values()), ROW), policies(spark)))


def test_batches_equal_the_whole_report(spark, tmp_path):
    rng = random.Random(1)
    batches, root = [], str(tmp_path)
    for n in range(4):
        ids = [f"C{rng.randrange(0, 60)}" for _ in range(25)]
        one = {c: (c, f"P{rng.choice([0, 0, 0, rng.randrange(12)])}", rng.choice([None, 0.004, 10.0, 99.99]), 1) for c in ids}
        batches.append(list(one.values()))
        rows = [r for r in batches[-1] for _ in range(rng.randint(1, 3))]  # a claim has a row for each person
        done = S.apply_batch(spark, spark.createDataFrame(rows, ROW), n, root, "cs_a", buckets=7)
        assert done.done and report(S.claims_by_policy(spark, done.state, policies(spark))) == whole(spark, batches)


def test_a_run_reads_only_the_buckets_it_touches(spark, tmp_path):
    """The folders of other buckets can be gone: the run does not look at them."""
    root = str(tmp_path)
    first = S.apply_batch(spark, spark.createDataFrame([(f"C{i}", f"P{i % 9}", 1.0, 1) for i in range(200)], ROW), 1, root, "cs_b", buckets=32)
    plan = spark.createDataFrame([("C5", "P1", 7.0, 1)], ROW)
    at = {n: e.path for n, e in first.state.tables.items() if e.path}
    keep = {S._entry(S.CLAIMS, spark.createDataFrame([("C5",)], "c string").select(S._bucket("c", 32)).first()[0])}
    for p in ("P5", "P1"):
        keep.add(S._entry(S.POLICIES, spark.createDataFrame([(p,)], "c string").select(S._bucket("c", 32)).first()[0]))
    saved = tmp_path / "saved"
    for n, p in at.items():
        if n not in keep:
            shutil.copytree(p, saved / n)
            shutil.rmtree(p)
    second = S.apply_batch(spark, plan, 2, root, "cs_b")
    assert second.claim_buckets and len(second.claim_buckets) == 1 and len(second.policy_buckets) <= 2
    same = [n for n, p in at.items() if n not in keep]
    assert same and all(second.state.tables[n].path == at[n] for n in same)
    for n in same:
        shutil.copytree(saved / n, at[n])
    got = {r[0]: (r[1], str(r[2])) for r in S.claims_by_policy(spark, second.state, policies(spark)).collect()}
    assert got["P5"] == (21, "21.00") and got["P1"] == (24, "30.00")


def test_a_batch_is_applied_once_and_whole(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    rows = spark.createDataFrame([("C1", "P1", 5.0, 1)], ROW)
    first = S.apply_batch(spark, rows, 1, root, "cs_c").state
    moved = spark.createDataFrame([("C1", "P2", 8.0, 1)], ROW)
    real = M.commit
    monkeypatch.setattr(M, "commit", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):  # lost between writing and committing
        S.apply_batch(spark, moved, 2, root, "cs_c")
    monkeypatch.setattr(M, "commit", real)
    assert M.snapshot(spark, root, "cs_c") == first
    second = S.apply_batch(spark, moved, 2, root, "cs_c")
    assert report(S.claims_by_policy(spark, second.state, policies(spark))) == [("P2", 1, Decimal("8.00"))]
    assert not S.apply_batch(spark, moved, 2, root, "cs_c").done and not S.apply_batch(spark, rows, 1, root, "cs_c").done


def test_nulls_and_an_empty_batch(spark, tmp_path):
    root = str(tmp_path)
    rows = [(None, "P1", 3.0, 1), ("C1", None, 4.0, 1), ("C2", "P2", None, 1)]
    S.apply_batch(spark, spark.createDataFrame(rows, ROW), 1, root, "cs_d")
    done = S.apply_batch(spark, spark.createDataFrame([], ROW), 2, root, "cs_d")
    assert done.done and done.claim_buckets == ()
    got = report(S.claims_by_policy(spark, done.state, policies(spark)))
    assert got == report(claims_by_policy(spark.createDataFrame(rows, ROW), policies(spark)))
