import json

import pytest

from tessera.plans.seed import presence_report, rebuild_from_seeds
from tessera.sources.contracts import RELATIONAL
from tessera.sources.readers import read_seed

COVERAGE = [
    {"id": "1", "coverage_name": "Collision", "coverage_group": "", "code": "COL",
     "is_policy_coverage": " TRUE ", "is_vehicle_coverage": "t", "description": ""},
    {"id": "2", "coverage_name": "Medical", "coverage_group": "Medical", "code": "MED",
     "is_policy_coverage": "yes", "is_vehicle_coverage": "nope", "description": "d"},
]
POLICY = [{"id": "7", "policy_number": "POL-000007", "policy_effective_date": "2026-01-01T00:00:00",
           "policy_expire_date": "2026-12-31", "payment_option": "monthly", "total_amount": "2.345",
           "active": "1", "additional_info": "", "created_date": "2026-01-01T10:11:12.1234567+00:00"}]


def test_array_seed_conversions(spark, tmp_path):
    (tmp_path / "coverage.json").write_text(json.dumps(COVERAGE))
    rows = {r["id"]: r for r in read_seed(spark, str(tmp_path / "coverage.json"),
                                          RELATIONAL["coverage"]).collect()}
    assert rows[1]["coverage_group"] is None and rows[1]["description"] is None
    assert rows[1]["is_policy_coverage"] is True and rows[1]["is_vehicle_coverage"] is True
    assert rows[2]["is_policy_coverage"] is True and rows[2]["is_vehicle_coverage"] is False
    (tmp_path / "policy.json").write_text(json.dumps(POLICY))
    p = read_seed(spark, str(tmp_path / "policy.json"), RELATIONAL["policy"]).first()
    assert str(p["total_amount"]) == "2.35" and p["active"] is True
    assert str(p["policy_effective_date"]) == "2026-01-01"
    assert str(p["created_date"]) == "2026-01-01 10:11:12.123456"


def test_rebuild_all_or_nothing_and_presence(spark, tmp_path):
    root = str(tmp_path / "store")
    (tmp_path / "coverage.json").write_text(json.dumps(COVERAGE))
    (tmp_path / "policy.json").write_text(json.dumps(POLICY))
    seeds = {"coverage": str(tmp_path / "coverage.json"), "policy": str(tmp_path / "policy.json")}
    contracts = {n: RELATIONAL[n] for n in ("coverage", "policy", "vehicle")}  # no vehicle seed
    out = {r["table_name"]: r["rows"] for r in rebuild_from_seeds(
        spark, contracts, seeds, root, schema="seed_t", expected={"coverage": 2, "policy": 1}).collect()}
    assert out == {"seed_t.coverage": 2, "seed_t.policy": 1}
    with pytest.raises(Exception):
        rebuild_from_seeds(spark, contracts, seeds, root, schema="seed_t",
                           expected={"coverage": 3, "policy": 1})
    rep = {r["table_name"]: r["rows"] for r in presence_report(
        spark, ["seed_t.coverage", "seed_t.policy", "seed_t.vehicle"]).collect()}
    assert rep == {"seed_t.coverage": 2, "seed_t.policy": 1, "seed_t.vehicle": -1}
