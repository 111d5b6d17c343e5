import datetime as dt
from decimal import Decimal

from tessera.operators.payments import apply_payments

BILLS = "id bigint, policy_id bigint, due_date date, balance decimal(10,2), status string, payment_method string"
PAYS = "payment_id bigint, bill_id bigint, amount decimal(10,2), payment_method string, edited_by string"
LOG = ("id bigint, policy_id bigint, edited_table_name string, edited_date timestamp_ntz, "
       "additional_info string, edited_by string")


def run(spark, bills, pays, log_rows=(), **kw):
    b = spark.createDataFrame(bills, BILLS)
    p = spark.createDataFrame(pays, PAYS)
    log = spark.createDataFrame(list(log_rows), LOG)
    return apply_payments(spark, b, p, log, as_of="2026-08-08", edited_at="2026-08-08 09:00:00", **kw)


def d(s):
    return Decimal(s)


def test_golden_payment_and_second_payment(spark):
    bills = [(141, 20, dt.date(2025, 10, 29), d("349.89"), "Pending", None)]
    pays = [(1, 141, d("150.00"), "credit_card", "cobranza"),
            (2, 141, d("100.00"), "credit_card", "cobranza")]
    r = run(spark, bills, pays, [(63, 20, "Bill", dt.datetime(2026, 1, 1), "x", "y")])
    b = r.bills.first()
    assert b["balance"] == d("158.37") and b["status"] == "Pending"
    assert b["payment_method"] == "credit_card"
    log = sorted(r.log.collect(), key=lambda x: x["id"])
    assert [x["id"] for x in log] == [64, 65]
    assert log[0]["additional_info"] == ("Pago de 150.00 registrado vía credit_card. Recargo por "
                                         "mora: 34.99 (283 dias). Nuevo saldo: 234.88")
    assert log[1]["additional_info"].endswith("Recargo por mora: 23.49 (283 dias). Nuevo saldo: 158.37")
    assert r.rejects.count() == 0


def test_overpayment_and_rejects(spark):
    bills = [(1, 1, dt.date(2026, 8, 1), d("100.00"), "Overdue", None),   # 7 days -> 2%
             (2, 1, dt.date(2026, 9, 1), None, "Pending", None),
             (3, 1, dt.date(2026, 9, 1), d("-1.00"), "Pending", None),
             (4, 1, dt.date(2026, 9, 1), d("50.00"), "Pending", None)]
    pays = [(1, 1, d("500.00"), "cash", "a"), (2, 2, d("10.00"), "cash", "a"),
            (3, 3, d("10.00"), "cash", "a"), (4, 99, d("10.00"), "cash", "a"),
            (5, 4, d("0.00"), "cash", "a"), (6, 4, d("5.00"), "x" * 21, "a"),
            (None, 4, d("5.00"), "cash", "a")]
    r = run(spark, bills, pays)
    bills_out = {x["id"]: x for x in r.bills.collect()}
    assert bills_out[1]["balance"] == d("0.00") and bills_out[1]["status"] == "Paid"
    assert bills_out[4]["balance"] == d("50.00") and bills_out[4]["payment_method"] is None
    reasons = {x["payment_id"]: x["reject_reason"] for x in r.rejects.collect()}
    assert reasons == {2: "bill balance is NULL", 3: "bill balance cannot be negative (got -1.00)",
                       4: "bill 99 does not exist", 5: "amount must be greater than zero",
                       6: "payment_method longer than 20 characters",
                       None: "payment order key is NULL"}
    assert [x["id"] for x in r.log.collect()] == [1]


def test_hot_path_equals_fold(spark):
    """Bills above max_fold go through the streamed fold; results must be identical."""
    bills = [(i, i, dt.date(2026, 7, 1 + i), d("1000.00"), "Pending", None) for i in range(1, 6)]
    pays = [(k, 1 + k % 5, d(f"{7 + k % 13}.{k % 100:02d}"), "cash", "a") for k in range(1, 120)]
    a = run(spark, bills, pays)
    b = run(spark, bills, pays, max_fold=3)
    key = ("bill_id", "seq", "surcharge", "new_balance")
    assert sorted(tuple(r[k] for k in key) for r in a.applied.collect()) == \
        sorted(tuple(r[k] for k in key) for r in b.applied.collect())
    assert sorted(a.bills.collect()) == sorted(b.bills.collect())
    ids = sorted(x["id"] for x in b.log.collect())
    assert ids == list(range(1, 120))


def test_log_ids_follow_bill_and_payment_order(spark):
    bills = [(i, i, dt.date(2026, 9, 1), d("1000.00"), "Pending", None) for i in range(1, 40)]
    pays = [(100 - k, 1 + k % 39, d("1.00"), "cash", "a") for k in range(0, 99)]
    r = run(spark, bills, pays, [(500, 1, "Bill", dt.datetime(2026, 1, 1), "x", "y")])
    rows = sorted(r.log_with_keys.collect(), key=lambda x: x["id"])
    assert [x["id"] for x in rows] == list(range(501, 600))
    assert [(x["bill_id"], x["seq"]) for x in rows] == sorted((x["bill_id"], x["seq"]) for x in rows)


def test_hot_bills_not_overdue_use_prefix_sum_and_match_fold(spark):
    """Future due dates (rate 0) and past due dates (rate > 0) mixed; a small max_fold sends
    both kinds through the hot paths; every output must equal the plain fold."""
    bills = ([(i, i, dt.date(2026, 12, 1), d("400.00"), "Pending", None) for i in range(1, 4)]
             + [(i, i, dt.date(2026, 6, 1), d("900.00"), "Overdue", None) for i in range(4, 6)])
    pays = [(k, 1 + k % 5, d(f"{3 + k % 17}.{k % 100:02d}"), "cash", "a") for k in range(1, 300)]
    a = run(spark, bills, pays)
    b = run(spark, bills, pays, max_fold=2)
    key = ("bill_id", "payment_id", "seq", "surcharge", "new_balance")
    got_a = sorted(tuple(r[k] for k in key) for r in a.applied.collect())
    got_b = sorted(tuple(r[k] for k in key) for r in b.applied.collect())
    assert got_a == got_b
    assert any(r[3] == 0 for r in got_b) and any(r[3] > 0 for r in got_b)
    assert any(r[4] == 0 for r in got_b)  # some bills were paid off
    assert sorted(a.bills.collect()) == sorted(b.bills.collect())


def test_hot_overdue_bill_is_split_at_certified_zero(spark):
    """A hot overdue bill paid off early, an interest-only bill (never zero, stays sequential)
    and a zero-balance bill: the split path must equal the plain fold, and the parallel part
    must start at or after the true first zero, close to it."""
    bills = [(1, 1, dt.date(2026, 1, 10), d("5000.00"), "Overdue", None),   # rate 0.100
             (2, 2, dt.date(2026, 7, 20), d("1000.00"), "Overdue", None),   # 19 days: 0.050
             (3, 3, dt.date(2026, 1, 10), d("0.00"), "Overdue", None)]
    pays = ([(k, 1, d(f"{900 + k % 23}.{k % 100:02d}"), "cash", "a") for k in range(1, 400)]
            + [(1000 + k, 2, d("50.00"), "cash", "a") for k in range(1, 60)]
            + [(2000 + k, 3, d("1.00"), "cash", "a") for k in range(1, 30)])
    a = run(spark, bills, pays)
    b = run(spark, bills, pays, max_fold=5)
    key = ("bill_id", "payment_id", "seq", "surcharge", "new_balance")
    got_a = sorted(tuple(r[k] for k in key) for r in a.applied.collect())
    got_b = sorted(tuple(r[k] for k in key) for r in b.applied.collect())
    assert got_a == got_b
    assert sorted(a.bills.collect()) == sorted(b.bills.collect())
    bal2 = {r[4] for r in got_b if r[0] == 2}
    assert bal2 == {d("1000.00")}  # 5% of 1000 = 50: interest only, never paid off

    from pyspark.sql import functions as F

    from tessera.operators.payments import _split_hot_overdue
    rows = b.applied.select("bill_id", "payment_id", "amount", "payment_method", "edited_by",
                            "policy_id", "days_late").join(
        spark.createDataFrame([(1, d("5000.00"), d("0.100")), (2, d("1000.00"), d("0.050")),
                               (3, d("0.00"), d("0.100"))],
                              "bill_id bigint, _start_balance decimal(10,2), _rate decimal(4,3)"),
        "bill_id")
    import tempfile
    head, settled = _split_hot_overdue(
        rows, "bill_id", ["payment_id"],
        ["payment_id", "amount", "payment_method", "edited_by", "policy_id", "days_late"], 4,
        tempfile.mkdtemp(prefix="hot-overdue-"))
    heads = dict(head.groupBy("bill_id").count().collect())
    first_zero = min(r[2] for r in got_a if r[0] == 1 and r[4] == 0)
    assert first_zero <= heads[1] <= first_zero + 2
    assert heads[2] == 59 and heads[3] == 1
    assert settled.where(F.col("bill_id") == 2).count() == 0
    assert settled.count() == (399 - heads[1]) + 28


def test_publish_bills_and_log_from_their_own_tables(spark, tmp_path):
    from tessera.plans.publish import ensure_database, publish_all

    root = str(tmp_path)
    ensure_database(spark, "pay_pub", root)
    publish_all(spark, {
        "pay_pub.bill": spark.createDataFrame(
            [(141, 20, dt.date(2025, 10, 29), d("349.89"), "Pending", None),
             (142, 20, dt.date(2026, 9, 1), d("10.00"), "Pending", None)], BILLS),
        "pay_pub.policy_edit_log": spark.createDataFrame(
            [(63, 20, "Bill", dt.datetime(2026, 1, 1), "x", "y")], LOG)}, root)
    pays = spark.createDataFrame([(1, 141, d("150.00"), "credit_card", "cobranza"),
                                  (2, 142, d("10.00"), "cash", "cobranza")], PAYS)
    r = apply_payments(spark, spark.table("pay_pub.bill"), pays,
                       spark.table("pay_pub.policy_edit_log"), as_of="2026-08-08",
                       edited_at="2026-08-08 09:00:00")
    v = r.publish("pay_pub.bill", "pay_pub.policy_edit_log", root)
    assert v["pay_pub.bill"].rows == 2 and v["pay_pub.policy_edit_log"].rows == 3
    bills = {b["id"]: (b["balance"], b["status"]) for b in spark.table("pay_pub.bill").collect()}
    assert bills == {141: (d("234.88"), "Pending"), 142: (d("0.00"), "Paid")}
    assert sorted(x["id"] for x in spark.table("pay_pub.policy_edit_log").collect()) == [63, 64, 65]


def test_overdue_split_moves_rows_once(spark, tmp_path):
    """The rows of a hot overdue bill are moved once, to be put in order; the cut, found by the sums of
    pieces, is the first payment at which the discounted sum reaches the start."""
    from tessera.operators.payments import _split_hot_overdue

    amounts = [Decimal("0.50") + Decimal(i % 9) / 100 for i in range(2000)]
    rows = spark.createDataFrame([(1, i, a, Decimal("20.00"), Decimal("0.020")) for i, a in enumerate(amounts)]
                                 + [(2, i, Decimal("0.30"), Decimal("20.00"), Decimal("0.020")) for i in range(2000)],
                                 "bill_id bigint, n int, amount decimal(12,2), _start_balance decimal(12,2), _rate decimal(4,3)")
    head, settled = _split_hot_overdue(rows.repartition(3), "bill_id", ["n"], ["amount"], 5, str(tmp_path / "s"))
    for df in (head, settled):
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    run, cut = 0.0, 0
    while run < 20 * (1 + 1e-6) + 1e-6:
        cut += 1
        run += (float(amounts[cut - 1]) - 0.005) * 1.02 ** -cut
    assert sorted((r["bill_id"], r["n"]) for r in head.collect()) == [(1, i) for i in range(cut)] + [(2, i) for i in range(2000)]
    assert sorted((r["n"], r["seq"]) for r in settled.collect()) == [(i, i + 1) for i in range(cut, 2000)]
