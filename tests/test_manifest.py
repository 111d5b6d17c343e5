"""One commit for several tables: lost drivers, conflicts, recovery."""

import datetime as dt
import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.operators.payments import apply_payments
from tessera.plans import manifest as M
from tessera.plans import publish as P

BILLS = "id bigint, policy_id bigint, due_date date, balance decimal(10,2), status string, payment_method string"
LOG = "id bigint, policy_id bigint, edited_table_name string, edited_date timestamp_ntz, additional_info string, edited_by string"
PAYS = "payment_id bigint, bill_id bigint, amount decimal(10,2), payment_method string, edited_by string"


class Lost(BaseException):
    """A driver that is gone: no handler of the library runs."""


def lose_at(monkeypatch, n, name="swap"):
    """The n-th call of a catalog swap, or of the commit itself, never returns."""
    real, calls = getattr(P, name), []

    def fails(*a, **k):
        calls.append(1)
        if len(calls) == n:
            raise Lost()
        return real(*a, **k)
    monkeypatch.setattr(P, name, fails)
    return lambda: monkeypatch.setattr(P, name, real)


def start(spark, root, db):
    P.ensure_database(spark, db, root)
    P.publish_all(spark, {
        f"{db}.bill": spark.createDataFrame([(1, 9, dt.date(2026, 9, 1), Decimal("10.00"), "Pending", None)], BILLS),
        f"{db}.log": spark.createDataFrame([(7, 9, "Bill", dt.datetime(2026, 1, 1), "x", "y")], LOG)}, root)


def pay(spark, root, db):
    state = M.snapshot(spark, root, db)
    pays = spark.createDataFrame([(1, 1, Decimal("4.00"), "cash", "c")], PAYS)
    run = apply_payments(spark, state.table(spark, "bill"), pays, state.table(spark, "log"), as_of="2026-08-08",
                         edited_at="2026-08-08 09:00:00")
    return run, state


def seen(spark, root, db):
    s = M.snapshot(spark, root, db)
    return s.table(spark, "bill").first()["balance"], s.table(spark, "log").count()


OLD, NEW = (Decimal("10.00"), 1), (Decimal("6.00"), 2)


@pytest.mark.parametrize("at,name,want", [(1, "commit", OLD), (1, "swap", NEW), (2, "swap", NEW)])
def test_lost_driver_leaves_bills_and_log_both_old_or_both_new(spark, tmp_path, monkeypatch, at, name, want):
    root, db = str(tmp_path), f"mf_lost_{name}{at}"
    start(spark, root, db)
    run, state = pay(spark, root, db)
    back = lose_at(monkeypatch, at, name)
    with pytest.raises(Lost):
        run.publish(f"{db}.bill", f"{db}.log", root, base=state, batch="b1")
    back()
    assert seen(spark, root, db) == want
    again, state = pay(spark, root, db) if want == OLD else (run, None)
    again.publish(f"{db}.bill", f"{db}.log", root, base=state, batch="b1")  # the rerun charges once
    assert seen(spark, root, db) == NEW
    assert (spark.table(f"{db}.bill").first()["balance"], spark.table(f"{db}.log").count()) == NEW
    assert P.recover(spark, root, db) == []


def test_written_but_uncommitted_versions_are_not_seen(spark, tmp_path):
    root = str(tmp_path)
    start(spark, root, "mf_staged")
    P.stage_version(spark.range(5), "mf_staged.bill", root)
    assert seen(spark, root, "mf_staged") == OLD


def test_stale_payment_run_is_refused(spark, tmp_path):
    root = str(tmp_path)
    start(spark, root, "mf_stale")
    first, state = pay(spark, root, "mf_stale")
    second, _ = pay(spark, root, "mf_stale")
    first.publish("mf_stale.bill", "mf_stale.log", root, base=state)
    with pytest.raises(M.CommitConflict, match="bill, log changed"):
        second.publish("mf_stale.bill", "mf_stale.log", root, base=state)
    assert seen(spark, root, "mf_stale") == NEW


def test_concurrent_publishes_of_one_table(spark, tmp_path):
    """Both begin from the same state: one wins, the other is refused and changes nothing."""
    root = str(tmp_path)
    P.ensure_database(spark, "mf_race", root)
    P.publish(spark, spark.range(1), "mf_race.t", root)
    base, out, gate = M.snapshot(spark, root, "mf_race"), {}, threading.Barrier(2)

    def load(n):
        v = P.stage_version(spark.range(n), "mf_race.t", root)
        gate.wait()
        try:
            M.commit(spark, base, {"t": P.entry_of(spark, v)})
            out[n] = "won"
        except M.CommitConflict:
            out[n] = "conflict"
    both = [threading.Thread(target=load, args=(n,)) for n in (10, 20)]
    [t.start() for t in both]
    [t.join() for t in both]
    assert sorted(out.values()) == ["conflict", "won"]
    won = next(n for n, v in out.items() if v == "won")
    assert P.recover(spark, root, "mf_race") == ["mf_race.t"] and spark.table("mf_race.t").count() == won


def test_commits_of_other_tables_are_no_conflict(spark, tmp_path):
    root = str(tmp_path)
    P.ensure_database(spark, "mf_both", root)
    base = M.snapshot(spark, root, "mf_both")
    versions = {n: P.stage_version(spark.range(n), f"mf_both.t{n}", root) for n in range(1, 7)}
    threads = [threading.Thread(target=M.commit, args=(spark, base, {f"t{n}": P.entry_of(spark, v)})) for n, v in versions.items()]
    [t.start() for t in threads]
    [t.join() for t in threads]
    s = M.snapshot(spark, root, "mf_both")
    assert s.number == 6 and {n: e.rows for n, e in s.tables.items()} == {f"t{n}": n for n in versions}
    with pytest.raises(M.CommitConflict):  # a table that was read has changed
        M.commit(spark, base, {"new": P.entry_of(spark, versions[1])}, reads=["t3"])


def test_readers_keep_their_snapshot(spark, tmp_path):
    root = str(tmp_path)
    P.ensure_database(spark, "mf_pin", root)
    P.publish_all(spark, {"mf_pin.a": spark.range(3), "mf_pin.b": spark.range(3)}, root)
    old = M.snapshot(spark, root, "mf_pin")
    P.publish_all(spark, {"mf_pin.a": spark.range(8), "mf_pin.b": spark.range(8)}, root)
    assert [old.table(spark, t).count() for t in "ab"] == [3, 3]
    assert M.snapshot(spark, root, "mf_pin", number=1) == old
    M.snapshot(spark, root, "mf_pin").register(spark, "mfpin_")
    assert spark.sql("SELECT count(*) FROM mfpin_a JOIN mfpin_b USING (id)").first()[0] == 8


def test_type_change_keeps_the_name(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    P.ensure_database(spark, "mf_type", root)
    P.publish(spark, spark.range(3), "mf_type.t", root)
    text = spark.range(4).select(F.col("id").cast("string").alias("id"))
    real = type(spark).sql

    def refuses(self, q, *a, **k):
        if "__next_" in q and q.startswith("ALTER") and "RENAME" in q:
            raise RuntimeError("catalog unavailable")
        return real(self, q, *a, **k)
    monkeypatch.setattr(type(spark), "sql", refuses)
    with pytest.raises(RuntimeError, match="unavailable"):
        P.publish(spark, text, "mf_type.t", root)
    monkeypatch.setattr(type(spark), "sql", real)
    assert spark.table("mf_type.t").count() == 3 and M.snapshot(spark, root, "mf_type").entry("t").rows == 3
    P.publish(spark, text, "mf_type.t", root)
    assert spark.table("mf_type.t").dtypes == [("id", "string")] and spark.table("mf_type.t").count() == 4


def test_lost_between_the_two_renames(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    P.ensure_database(spark, "mf_mid", root)
    P.publish(spark, spark.range(3), "mf_mid.t", root)
    real = type(spark).sql

    def lost(self, q, *a, **k):
        if "__next_" in q and q.startswith("ALTER") and "RENAME" in q:
            raise Lost()
        return real(self, q, *a, **k)
    monkeypatch.setattr(type(spark), "sql", lost)
    with pytest.raises(Lost):
        P.publish(spark, spark.range(4).select(F.col("id").cast("string").alias("id")), "mf_mid.t", root)
    monkeypatch.setattr(type(spark), "sql", real)
    assert M.snapshot(spark, root, "mf_mid").table(spark, "t").count() == 4
    assert P.recover(spark, root, "mf_mid") == ["mf_mid.t"] and spark.table("mf_mid.t").count() == 4


def test_tables_of_two_databases_are_no_one_commit(spark, tmp_path):
    with pytest.raises(P.PublishError, match="one database"):
        P.publish_all(spark, {"mf_x.a": spark.range(1), "mf_y.a": spark.range(1)}, str(tmp_path))
