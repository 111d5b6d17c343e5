import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import claims as C
from tessera.operators.flatten import CLAIM_SPEC, REPAIR_SPEC, flatten, line_total_offenders, project_document, reconcile
from tessera.sources.readers import read_json_documents


def claim(i, parties, policy="POL-1", damage=100.0, **extra):
    d = {"claim_id": f"CLM-{i}", "policy_number": policy, "vin": f"VIN{i}",
         "reported_at": "2026-08-01T10:00:00", "incident_type": "collision",
         "estimated_damage_usd": damage}
    if parties is not None:
        d["involved_parties"] = parties
    d.update(extra)
    return d


def person(n, email=None):
    p = {"name": n, "role": "driver", "phone": "+57-399-555-0142", "personal_address": "Calle"}
    if email:
        p["email"] = email
    return p


@pytest.fixture
def landing(spark, tmp_path):
    week1 = [claim(1, [person("a"), person("b")]), claim(2, []), claim(3, None)]
    week2 = [claim(4, [person("c", "c@x")], policy="POL-2", damage=50.5),
             claim(5, "null-marker"), claim(6, [person("d"), person("e"), person("f")])]
    week2[1]["involved_parties"] = None
    (tmp_path / "w1.json").write_text(json.dumps(week1))
    (tmp_path / "w2.json").write_text(json.dumps(week2, indent=2))
    return read_json_documents(spark, str(tmp_path), outer_array=True)


def test_outer_keeps_empty_absent_null(spark, landing):
    out = flatten(landing, CLAIM_SPEC, outer=True)
    assert out.count() == 2 + 1 + 1 + 1 + 1 + 3
    inner = flatten(landing, CLAIM_SPEC, outer=False)
    assert inner.count() == 6
    r = out.where("claim_id = 'CLM-2'").first()
    assert r["party_name"] is None and r["reported_at"].isoformat() == "2026-08-01T10:00:00"
    assert out.where("party_email = 'c@x'").count() == 1
    assert out.where("assigned_workshop IS NOT NULL").count() == 0


def test_lineage_and_reconcile(spark, landing):
    assert {r[0] for r in landing.select("_source_file").distinct().collect()} == {"w1.json", "w2.json"}
    staged = flatten(landing, CLAIM_SPEC, outer=True)
    r = reconcile(landing, staged, CLAIM_SPEC, "claim_id").first()
    assert (r["claims"], r["staged_rows"], r["expected_rows"], r["missing_keys"], r["ok"]) == (6, 9, 9, 0, True)
    broken = reconcile(landing, staged.where("claim_id <> 'CLM-2'"), CLAIM_SPEC, "claim_id").first()
    assert not broken["ok"] and broken["missing_keys"] == 1


def test_claims_by_policy_counts_each_claim_once(spark, landing):
    staged = flatten(landing, CLAIM_SPEC, outer=True)
    pol = spark.createDataFrame([("POL-1",), ("POL-2",)], "policy_number string")
    good = {r["policy_number"]: (r["claims"], str(r["damage_usd"]))
            for r in C.claims_by_policy(staged, pol).collect()}
    fanned = {r["policy_number"]: (r["claims"], str(r["damage_usd"]))
              for r in C.claims_by_policy_as_reference(staged, pol).collect()}
    assert good == {"POL-1": (5, "500.00"), "POL-2": (1, "50.50")}
    assert fanned["POL-1"] == (5, "800.00")  # 2 + 1 + 1 + 1 + 3 person rows


def test_strict_cast_fails_on_wrong_type(spark, tmp_path):
    (tmp_path / "bad.json").write_text(json.dumps([claim(1, [], damage="lots")]))
    landing = read_json_documents(spark, str(tmp_path), outer_array=True)
    with pytest.raises(Exception):
        flatten(landing, CLAIM_SPEC).collect()


def test_malformed_file_aborts(spark, tmp_path):
    (tmp_path / "ok.json").write_text(json.dumps([claim(1, [])]))
    (tmp_path / "broken.json").write_text('[{"claim_id": "x", ')
    with pytest.raises(Exception):
        read_json_documents(spark, str(tmp_path), outer_array=True).collect()


def test_one_document_per_line(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join(json.dumps(claim(i, [person("p")])) for i in range(4)))
    landing = read_json_documents(spark, str(tmp_path), outer_array=False)
    assert flatten(landing, CLAIM_SPEC).count() == 4


def test_repair_documents_optional_key_and_totals(spark, tmp_path):
    docs = [{"claim_id": "R1", "policy_number": "P", "reported_at": "2026-06-01T08:00:00Z",
             "claim_type": "collision", "status": "open", "adjuster": {"email": "a@x"},
             "estimated_total_cost": 30.5,
             "repair_line_items": [{"part": "door", "damage_severity": "low", "labor_hours": 1.5,
                                    "estimated_cost": 10.25},
                                   {"part": "hood", "damage_severity": "high", "labor_hours": 2,
                                    "estimated_cost": 20.25}]},
            {"claim_id": "R2", "policy_number": "P", "reported_at": "2026-06-02T08:00:00Z",
             "claim_type": "theft", "status": "open", "adjuster": {"email": "b@x", "agency": "AG"},
             "estimated_total_cost": 0, "repair_line_items": []},
            {"claim_id": "R3", "policy_number": "P", "reported_at": "2026-06-03T08:00:00Z",
             "claim_type": "theft", "status": "open", "adjuster": {"email": "c@x"},
             "estimated_total_cost": 9.99, "repair_line_items": [{"part": "x", "damage_severity": "low",
                                                                  "labor_hours": 1, "estimated_cost": 5}]}]
    (tmp_path / "r.json").write_text(json.dumps(docs))
    landing = read_json_documents(spark, str(tmp_path), outer_array=True)
    heads = {r["claim_id"]: r for r in project_document(landing, REPAIR_SPEC).collect()}
    assert heads["R1"]["adjuster_agency"] is None and heads["R2"]["adjuster_agency"] == "AG"
    assert str(heads["R1"]["reported_at"]) == "2026-06-01 08:00:00"
    lines = flatten(landing, REPAIR_SPEC, outer=True)
    assert lines.count() == 4
    bad = line_total_offenders(project_document(landing, REPAIR_SPEC),
                               lines.where(F.col("estimated_cost").isNotNull()),
                               "claim_id", "estimated_total_cost", "estimated_cost")
    assert [r["claim_id"] for r in bad.collect()] == ["R3"]
