"""Property checks: flatten row counts and reload idempotence over generated inputs."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators.flatten import CLAIM_SPEC, flatten
from tessera.plans.publish import ensure_database, publish
from tessera.session import work_path
from tessera.sources.readers import read_json_documents

person = st.fixed_dictionaries({"name": st.text(min_size=1, max_size=5)},
                               optional={"email": st.emails(), "phone": st.text(max_size=12)})
parties = st.one_of(st.none(), st.just("absent"), st.lists(person, max_size=5))
docs = st.lists(st.tuples(st.integers(0, 10**6), parties), min_size=1, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(docs)
def test_outer_flatten_count_is_sum_of_max_one(spark, items):
    out = []
    expected_outer = expected_inner = 0
    for i, (k, ps) in enumerate(items):
        d = {"claim_id": f"C{i}-{k}", "policy_number": "P"}
        if ps != "absent":
            d["involved_parties"] = ps
        n = len(ps) if isinstance(ps, list) else 0
        expected_outer += max(1, n)
        expected_inner += n
        out.append(json.dumps(d))
    path = work_path(spark, "prop")
    spark.createDataFrame([(x,) for x in out], "value string").coalesce(1).write.text(path)
    landing = read_json_documents(spark, path, outer_array=False)
    assert flatten(landing, CLAIM_SPEC, outer=True).count() == expected_outer
    assert flatten(landing, CLAIM_SPEC, outer=False).count() == expected_inner


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-2**63, 2**63 - 1), st.text(max_size=8)), max_size=40),
       st.integers(1, 3))
def test_reloading_n_times_equals_once(spark, rows, times):
    root = work_path(spark, "prop-reload")
    ensure_database(spark, "prop_db", root)
    df = spark.createDataFrame(rows, "k bigint, v string")
    name = f"prop_db.t_{abs(hash((tuple(rows), times))) % 10**9}"
    for _ in range(times):
        publish(spark, df, name, root)
    assert sorted(spark.table(name).collect()) == sorted(df.collect())


@settings(max_examples=400, deadline=None)
@given(start=st.integers(0, 10**9), rate=st.sampled_from([20, 50, 100]),
       pays=st.lists(st.integers(1, 5 * 10**7), min_size=1, max_size=60))
def test_zero_certificate_is_sound(start, rate, pays):
    """Where the discounted-payment certificate of the hot overdue path fires, the exact
    folded balance (integer cents, half-up surcharge) is zero from that payment on."""
    from tessera.operators.payments import ZERO_CERT_ABS, ZERO_CERT_REL

    base, run, bal, cut = 1 + rate / 1000, 0.0, start, None
    balances = []
    for m, a in enumerate(pays, start=1):
        bal = max(bal + (bal * rate + 500) // 1000 - a, 0)
        balances.append(bal)
        run += (a / 100 - 0.005) * base ** -m
        if cut is None and run >= (start / 100) * (1 + ZERO_CERT_REL) + ZERO_CERT_ABS:
            cut = m
    if cut is not None:
        assert all(b == 0 for b in balances[cut - 1:])


bills_st = st.lists(st.tuples(st.sampled_from([-40, -20, -10, 0, 5, 60]),   # due day offset
                              st.integers(0, 10**8)), min_size=1, max_size=4)  # balance cents
pays_st = st.lists(st.tuples(st.integers(0, 3), st.integers(1, 5 * 10**6)), min_size=1,
                   max_size=40)                                             # (bill, cents)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(bills_st, pays_st)
def test_hot_paths_equal_the_plain_fold(spark, bills, pays):
    """Random bills (every rate band, zero balances) and payments (tiny to large): with
    max_fold=3 the hot paths (prefix sum, certified split, streamed head) must give exactly
    the rows of the JVM fold."""
    import datetime as dt
    from decimal import Decimal

    from tessera.operators.payments import apply_payments

    as_of = dt.date(2026, 8, 8)
    b = spark.createDataFrame(
        [(i, i, as_of + dt.timedelta(days=off), Decimal(cents) / 100, "Pending", None)
         for i, (off, cents) in enumerate(bills)],
        "id bigint, policy_id bigint, due_date date, balance decimal(10,2), status string, "
        "payment_method string")
    p = spark.createDataFrame(
        [(k, bill % len(bills), Decimal(cents) / 100, "cash", "a")
         for k, (bill, cents) in enumerate(pays)],
        "payment_id bigint, bill_id bigint, amount decimal(10,2), payment_method string, "
        "edited_by string")
    log = spark.createDataFrame([], "id bigint, policy_id bigint, edited_table_name string, "
                                    "edited_date timestamp_ntz, additional_info string, "
                                    "edited_by string")
    key = ("bill_id", "payment_id", "seq", "surcharge", "new_balance")
    runs = [apply_payments(spark, b, p, log, as_of=as_of, edited_at="2026-08-08 09:00:00",
                           max_fold=m) for m in (1000, 3)]
    plain, hot = [sorted(tuple(r[k] for k in key) for r in x.applied.collect()) for x in runs]
    assert plain == hot
