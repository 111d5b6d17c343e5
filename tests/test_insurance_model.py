"""The relational model's own rule set over small fixture tables of the seven contracts."""

import datetime as dt
from decimal import Decimal

import pytest

from tessera.operators import masking as M
from tessera.operators import quality as Q
from tessera.functions.scalars import ROLE_ANALYST, ROLE_MANAGER
from tessera.sources.contracts import RELATIONAL

TS = dt.datetime(2026, 8, 1, 10, 0)


def fixture_tables(spark, drop=None):
    rows = {
        "coverage": [(1, "Collision", "Physical Damage", "COL", True, True, None),
                     (2, "Medical", "Medical", "MED", True, False, "x")],
        "policy": [(1, "POL-000001", dt.date(2026, 1, 1), dt.date(2026, 12, 31), "monthly",
                    Decimal("120.00"), True, None, TS),
                   (2, "POL-000002", dt.date(2026, 2, 1), dt.date(2027, 1, 31), "annual",
                    None, True, "a, b", TS)],
        "vehicle": [(1, "VIN-PENDIENTE-1", None, None, None, None, TS)],
        "policy_edit_log": [(1, 1, "Bill", TS, "created", "seed")],
        "bill": [(1, 1, dt.date(2026, 1, 31), Decimal("10.00"), TS, Decimal("0.00"), "Paid", None, None),
                 (2, 2, dt.date(2026, 2, 28), None, TS, Decimal("35.50"), "Pending", "credit_card", None)],
        "policy_coverage": [(1, 1, 1, True, TS), (2, 2, 2, False, TS)],
        "vehicle_coverage": [(1, 1, 1, True, TS)],
    }
    frames = {n: spark.createDataFrame([] if n == drop else r, RELATIONAL[n].struct)
              for n, r in rows.items()}
    return frames.__getitem__


def test_clean_model_passes_every_rule(spark):
    rules = Q.insurance_rules(RELATIONAL)
    assert len(rules) == 7 + 7 + 6 + 7 + 2 + 2  # keys, unique keys, FKs, not empty, business, secondary unique
    rep = Q.rule_counts(fixture_tables(spark), rules).collect()
    assert all(r["ok"] for r in rep), [r for r in rep if not r["ok"]]


def test_omitted_table_turns_rules_red(spark):
    rep = {r["name"]: r["ok"] for r in
           Q.rule_counts(fixture_tables(spark, drop="vehicle"), Q.insurance_rules(RELATIONAL)).collect()}
    failed = sorted(n for n, ok in rep.items() if not ok)
    assert failed == ["no_orphans[vehicle_coverage.vehicle_id]", "not_empty[vehicle]"]


def test_access_matrix_and_masked_reads(spark):
    staged = spark.createDataFrame([("n", "+57-399-555-0142", "Calle 1")],
                                   "party_name string, party_phone string, party_address string")
    landing = spark.createDataFrame([("x", "f")], "raw string, _source_file string")
    tables = {M.STAGING: staged, M.LANDING: landing}
    assert M.read_as(ROLE_ANALYST, M.STAGING, tables).first()["party_phone"] == "+57-399-555-0142"
    with pytest.raises(M.AccessDenied):
        M.read_as(ROLE_ANALYST, M.LANDING, tables)
    with pytest.raises(M.AccessDenied):
        M.read_as("ACCOUNTADMIN", M.STAGING, tables)
    with pytest.raises(M.AccessDenied):
        M.read_as(ROLE_MANAGER, M.LANDING, tables)
    names = M.register_views_for(spark, ROLE_MANAGER, tables)
    assert names == [M.STAGING]
    assert spark.table(M.STAGING).first()["party_phone"] == "+57-399-***-****"
    # a filter on the masked column sees masked values
    assert spark.table(M.STAGING).where("party_phone LIKE '+57-399-555%'").count() == 0


def test_session_role_view(spark):
    staged = spark.createDataFrame([("+57-399-555-0142", "Calle 1")], "party_phone string, party_address string")
    M.declare_role(spark, ROLE_ANALYST)
    staged.createOrReplaceTempView("v_roles_src")
    M.create_masked_view(spark, "v_roles_src", "v_roles", M.STAGING, staged.columns)
    assert spark.table("v_roles").first()["party_phone"] == "+57-399-555-0142"
    M.declare_role(spark, "SOMEONE_ELSE")
    assert spark.table("v_roles").first()["party_phone"] == "+**-***-***-****"
    M.declare_role(spark, ROLE_MANAGER)
    row = spark.table("v_roles").first()
    assert (row["party_phone"], row["party_address"]) == ("+57-399-***-****", "*** direccion protegida ***")


def test_not_null_rules_from_strict_ddl(spark):
    rules = Q.contract_rules(RELATIONAL, not_null_columns=True)
    names = {r.name for r in rules}
    assert "not_null[policy.policy_number]" in names and "not_null[bill.due_date]" in names
    assert "not_null[bill.balance]" not in names  # nullable in the strict schema
    t = fixture_tables(spark)
    bad = {"policy": t("policy").union(spark.createDataFrame(
        [(3, None, dt.date(2026, 1, 1), dt.date(2026, 2, 1), None, None, True, None, TS)],
        RELATIONAL["policy"].struct))}
    rep = {r["name"]: r["n_offenders"] for r in Q.rule_counts(
        lambda n: bad.get(n) or t(n), rules).collect()}
    assert rep["not_null[policy.policy_number]"] == 1
    assert rep["max_length[bill.payment_method]"] == 0
