from tessera.operators import quality as Q


def tables(spark):
    data = {
        "policy": spark.createDataFrame(
            [(1, "P1", "2026-01-01", "2026-12-31"), (2, "P2", "2026-05-01", "2026-01-01"),
             (None, "P3", None, "2026-01-01"), (2, "P2", "2026-01-01", "2026-02-01")],
            "id bigint, policy_number string, policy_effective_date string, policy_expire_date string"),
        "bill": spark.createDataFrame(
            [(10, 1, "Paid", 0.0), (11, 9, "paid", 5.0), (12, None, "Pending", 3.0), (13, 2, "PAID", None)],
            "id bigint, policy_id bigint, status string, balance double"),
        "empty": spark.createDataFrame([], "id bigint"),
    }
    return data.__getitem__


def rules():
    return [Q.pk_not_null("policy", ("id",)), Q.unique("policy", ("id",)),
            Q.no_orphans("bill", ("policy_id",), "policy", ("id",)),
            Q.column_order("policy", "policy_effective_date", "policy_expire_date"),
            Q.row_rule("paid_zero_balance[bill]", "bill",
                       lambda: (Q.F.upper("status") == "PAID") & (Q.F.coalesce("balance", Q.F.lit(0)) != 0)),
            Q.not_empty("empty"), Q.not_empty("bill"), Q.max_length("policy", "policy_number", 1)]


def test_each_family_detects_planted_defect(spark):
    got = {r["name"]: (r["ok"], r["n_offenders"]) for r in Q.rule_counts(tables(spark), rules()).collect()}
    assert got == {
        "pk_not_null[policy]": (False, 1), "pk_unique[policy]": (False, 1),
        "no_orphans[bill.policy_id]": (False, 1), "date_order[policy]": (False, 1),
        "paid_zero_balance[bill]": (False, 1), "not_empty[empty]": (False, 1),
        "not_empty[bill]": (True, 0), "max_length[policy.policy_number]": (False, 4)}


def test_offender_rows_and_report(spark):
    t = tables(spark)
    dup = Q.unique("policy", ("id",)).offenders(t).collect()
    assert [(r["id"], r["times"]) for r in dup] == [(2, 2)]
    orphans = Q.no_orphans("bill", ("policy_id",), "policy", ("id",)).offenders(t).collect()
    assert [r["id"] for r in orphans] == [11]
    rep = Q.run_rules(spark, t, rules())
    rows = {r["name"]: r for r in rep.collect()}
    assert rows["no_orphans[bill.policy_id]"]["detail"].startswith("1 row(s), e.g.: (9, 11")
    assert rows["not_empty[bill]"]["detail"] == "no problems"
    s = Q.summary(rep).first()
    assert (s["passed"], s["failed"], s["total"]) == (1, 7, 8)


def test_fused_single_scan_per_table(spark):
    t = tables(spark)
    df = Q.rule_counts(t, [Q.pk_not_null("policy", ("id",)),
                           Q.column_order("policy", "policy_effective_date", "policy_expire_date"),
                           Q.max_length("policy", "policy_number", 1)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") <= 1 or plan.count("Scan") <= 1
