"""Balances of very long bills, piece by piece, against a plain fold."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import balance_pieces as B
from tessera.operators.payments import apply_payments

BILLS = "id bigint, policy_id bigint, due_date date, balance decimal(10,2), status string, payment_method string"
LOG = "id bigint, policy_id bigint, edited_table_name string, edited_date timestamp_ntz, additional_info string, edited_by string"


def fold(balance, rate, amounts):
    for a in amounts:
        _, balance = B.step(balance, rate, a)
    return balance


@settings(max_examples=400, deadline=None)
@given(after=st.integers(0, 10**13), rate=st.integers(0, 300))
def test_largest_before_is_the_largest(after, rate):
    b = B.largest_before(after, rate)
    assert b + (b * rate + 500) // 1000 <= after < (b + 1) + ((b + 1) * rate + 500) // 1000


@settings(max_examples=300, deadline=None)
@given(rate=st.sampled_from([1, 20, 50, 100]), amounts=st.lists(st.integers(1, 10**6), min_size=1, max_size=40), start=st.integers(0, 10**8))
def test_summary_follows_like_the_fold(rate, amounts, start):
    low, high, outs, kept = B.summary(amounts, rate)
    assert fold(low, rate, amounts) == 0 and (low == high or fold(low + 1, rate, amounts) > 0)
    for b in {start, low, low + 1, min(low + 100, high)}:
        if b <= high:
            assert B.follow(b, low, high, outs, kept, rate) == fold(b, rate, amounts)


@pytest.mark.parametrize("rate", [20, 50, 100])
def test_long_stretches_leave_few_balances(rate):
    """Payments that about cover the surcharge: long stretches are told by a short list."""
    rng = random.Random(rate)
    start = 5_000_000
    s = (start * rate + 500) // 1000
    amounts = [s + k for _ in range(3000) for k in rng.choice([(1, -1), (-2, 2), (0, 0), (3, -3)])]
    low, high, outs, kept = B.summary(amounts, rate)
    assert kept is None and len(outs) == high - low <= B.widest(rate)
    assert low < start <= high and B.follow(start, low, high, outs, kept, rate) == fold(start, rate, amounts) > 0


def test_a_balance_beyond_the_column_is_refused():
    low, high, outs, kept = B.summary([1] * 3000, 100)
    with pytest.raises(ValueError, match="passes"):
        B.follow(high + 1, low, high, outs, kept, 100)


@pytest.mark.parametrize("pieces", [2, 7])
def test_hot_bills_equal_the_plain_fold(spark, tmp_path, pieces):
    """One bill whose payments only cover the surcharges, one that is settled in the middle, one
    that grows, and small ones: the same rows as a fold in order."""
    rng = random.Random(4)
    bills = [(1, 10, "2026-01-01", "50000.00"), (2, 10, "2026-01-01", "90.00"), (3, 11, "2026-01-01", "1000.00"), (4, 11, "2026-01-01", "77.77")]
    rate = 100
    pays, n = [], 0
    for bill, start, count in ((1, 5_000_000, 4000), (2, 9_000, 700), (3, 100_000, 60), (4, 7_777, 5)):
        for i in range(count // 2):
            d = rng.choice([0, 1, 2, 3])
            s = (start * rate + 500) // 1000
            for a in ((s + d, s - d) if bill in (1, 3) else (s - 40, s + 60)):
                n += 1
                pays.append((n, bill, Decimal(a) / 100, "cash", "c"))
    rng.shuffle(pays)
    b = spark.createDataFrame([(i, p, dt.date.fromisoformat(d), Decimal(x), "Pending", None) for i, p, d, x in bills], BILLS)
    p = spark.createDataFrame(pays, "payment_id bigint, bill_id bigint, amount decimal(10,2), payment_method string, edited_by string").repartition(5)
    run = apply_payments(spark, b, p, spark.createDataFrame([], LOG), as_of="2026-08-08", edited_at="2026-08-08 09:00:00",
                         max_fold=50, hot_partitions=pieces, stage_path=str(tmp_path / "stage"))
    got = {(r["bill_id"], r["payment_id"]): (r["seq"], r["surcharge"], r["new_balance"]) for r in run.applied.collect()}
    want = {}
    for bill, _, _, start in bills:
        balance, seq = int(Decimal(start) * 100), 0
        for i, key, a, _, _ in sorted(x for x in pays if x[1] == bill):
            s, balance = B.step(balance, rate, int(a * 100))
            seq += 1
            want[bill, i] = (seq, Decimal(s) / 100, Decimal(balance) / 100)
    assert got == want
    assert run.applied.where("bill_id = 1").agg(F.min("new_balance")).first()[0] > 0


@pytest.mark.parametrize("pieces", [2, 40])
def test_payments_that_outgrow_the_column_are_refused(spark, tmp_path, pieces):
    """One long overdue bill whose payments stay below the surcharges, with two large payments in
    between, a long one whose payments just cover them and a short one: a payment that leaves more than
    decimal(10,2) holds goes to the rejects, the bill keeps its balance, and the batch goes on."""
    bills, largest = [(1, 5_000_000), (2, 4_000_000), (3, 9_500_000_000)], 10**10 - 1
    amounts = {1: [499_000 + i % 7 for i in range(9000)], 2: [400_000] * 200, 3: [100, 960_000_000, 1]}
    amounts[1][2500] = amounts[1][4100] = 9_900_000_000
    rng, pays, want, refused = random.Random(5), [], {}, set()
    for bill, balance in bills:
        for i, a in enumerate(amounts[bill]):
            pays.append((i, bill, Decimal(a) / 100, "cash", "c"))
            s, balance, no = B.step_or_refuse(balance, 100, a, largest)
            refused |= {(bill, i)} if no else set()
            want |= {} if no else {(bill, i): (Decimal(s) / 100, Decimal(balance) / 100)}
    rng.shuffle(pays)
    assert {b for b, _ in refused} == {1, 3} and {i for b, i in want if b == 1 and i > 2400} >= {2500, 4100}
    b = spark.createDataFrame([(i, 10, dt.date(2026, 1, 1), Decimal(x) / 100, "Pending", None) for i, x in bills], BILLS)
    p = spark.createDataFrame(pays, "payment_id bigint, bill_id bigint, amount decimal(10,2), payment_method string, edited_by string").repartition(5)
    run = apply_payments(spark, b, p, spark.createDataFrame([], LOG), as_of="2026-08-08", edited_at="2026-08-08 09:00:00",
                         max_fold=50, hot_partitions=pieces, stage_path=str(tmp_path / "stage"))
    assert {(r["bill_id"], r["payment_id"]): (r["surcharge"], r["new_balance"]) for r in run.applied.collect()} == want
    assert {(r["bill_id"], r["payment_id"]) for r in run.rejects.collect()} == refused
    last = {bill: want[max(k for k in want if k[0] == bill)][1] for bill, _ in bills}
    assert {r["id"]: r["balance"] for r in run.bills.collect()} == last
    assert run.log.count() == len(want)
