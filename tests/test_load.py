import gzip

import pytest
from pyspark.sql import functions as F

from tessera.operators.drift import SchemaDriftError, check_drift, compare_columns
from tessera.plans import audit as A
from tessera.plans.load import load_table
from tessera.plans.publish import PublishError, ensure_database, publish, publish_all, stage_version
from tessera.sources.contracts import RELATIONAL
from tessera.sources.sinks import write_csv

BILL = RELATIONAL["bill"]
HEADER = "id,policy_id,due_date,minimum_payment,created_date,balance,status,payment_method,paid_date"
ROWS = ["1,10,2026-01-31,5.00,2026-01-01 10:00:00,100.50,Pending,,",
        '2,10,2026-02-28,,2026-01-01 10:00:00.123456,0.00,Paid,"card, visa",2026-02-01',
        '3,11,2026-03-31,1.00,2026-01-01 10:00:00,7.25,"Pé ""x""  ",  cash  ,']


def write(path, header, rows, gz=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    text = "\n".join([header] + rows) + "\n"
    if gz:
        with gzip.open(path, "wt", encoding="utf-8") as f:
            f.write(text)
    else:
        path.write_text(text, encoding="utf-8")
    return str(path)


def test_by_name_any_column_order_and_csv_details(spark, tmp_path):
    root = str(tmp_path / "store")
    cols = HEADER.split(",")
    rev = [",".join(reversed(r.split(","))) for r in ROWS[:1]]
    src = write(tmp_path / "rev" / "bill.csv", ",".join(reversed(cols)), rev)
    r = load_table(spark, BILL, src, root, schema="raw_t1")
    assert r.ok and r.rows == 1
    row = spark.table("raw_t1.bill").first()
    assert row["id"] == 1 and str(row["balance"]) == "100.50" and row["payment_method"] is None
    src2 = write(tmp_path / "fwd" / "bill.csv", HEADER, ROWS)
    r = load_table(spark, BILL, src2, root, schema="raw_t1")
    assert r.ok and r.rows == 3
    rows = {x["id"]: x for x in spark.table("raw_t1.bill").collect()}
    assert rows[2]["payment_method"] == "card, visa" and rows[2]["minimum_payment"] is None
    assert str(rows[2]["created_date"]) == "2026-01-01 10:00:00.123456"
    assert rows[3]["status"] == 'Pé "x"  ' and rows[3]["payment_method"] == "  cash  "


def test_drift_refuses_and_keeps_previous(spark, tmp_path):
    root = str(tmp_path / "store")
    assert load_table(spark, BILL, write(tmp_path / "a" / "b.csv", HEADER, ROWS), root, schema="raw_t2").ok
    extra = write(tmp_path / "b" / "b.csv", HEADER + ",Late_Fee", [r + ",1" for r in ROWS[:1]])
    r = load_table(spark, BILL, extra, root, schema="raw_t2")
    assert not r.ok and "LATE_FEE" in r.error and "ADD COLUMNS (`LATE_FEE` STRING)" in r.error
    assert spark.table("raw_t2.bill").count() == 3
    missing = write(tmp_path / "c" / "b.csv", HEADER.replace(",paid_date", ""), [r[:-1] for r in ROWS])
    r = load_table(spark, BILL, missing, root, schema="raw_t2")
    assert not r.ok and "PAID_DATE" in r.error
    audit = A.read_audit(spark, root).where("status = 'LOAD_FAILED'").count()
    assert audit == 2


def test_compare_columns_rules():
    r = compare_columns("bill", [" ID ", "Extra", "b"], ["id", "B", "c"])
    assert r.new == ("EXTRA",) and r.missing == ("C",)
    assert not compare_columns("bill", ["x"], None).has_drift
    with pytest.raises(SchemaDriftError):
        check_drift("bill", ["id", "x"], ["id"])
    assert check_drift("bill", ["id"], ["id", "y"], allow_missing=True).missing == ("Y",)


@pytest.mark.parametrize("bad_row", [
    "4,10,2026-01-31,5.00,2026-01-01 10:00:00,abc,Pending,,",       # not a number
    "4,10,2026-01-31,5.00,2026-01-01 10:00:00,1.00,Pending,abcdefghijklmnopqrstu,",  # 21 chars
    "4,10,2026-01-31",                                               # ragged row
])
def test_bad_row_aborts_and_previous_version_stays(spark, tmp_path, bad_row):
    root = str(tmp_path / "store")
    schema = "raw_t3"
    assert load_table(spark, BILL, write(tmp_path / "ok" / "b.csv", HEADER, ROWS), root, schema=schema).ok
    r = load_table(spark, BILL, write(tmp_path / "bad" / "b.csv", HEADER, ROWS + [bad_row]), root,
                   schema=schema)
    assert not r.ok and r.status == "LOAD_FAILED"
    assert spark.table(f"{schema}.bill").count() == 3


def test_continue_mode_splits_rejects(spark, tmp_path):
    root = str(tmp_path / "store")
    bad = ["4,10,2026-01-31,5.00,2026-01-01 10:00:00,abc,Pending,,",
           "5,10,2026-01-31,5.00,2026-01-01 10:00:00,1.00,Pending,abcdefghijklmnopqrstu,",
           "6,10,2026-01-31"]
    r = load_table(spark, BILL, write(tmp_path / "x" / "b.csv", HEADER, ROWS + bad), root,
                   schema="raw_t4", on_error="continue")
    assert r.ok and r.status == "PARTIALLY_LOADED" and r.rows == 3 and r.rejects == 3
    audit = A.read_audit(spark, root).collect()
    assert {x["status"] for x in audit} == {"PARTIALLY_LOADED"}
    assert audit[0]["error"].startswith("3 row(s) rejected; first error: ")
    rej = spark.read.parquet(f"{root}/raw_t4/bill__rejects/*").collect()
    assert sorted(str(r["column"]) for r in rej) == ["None", "balance", "payment_method"]
    ragged = [r for r in rej if r["column"] is None][0]
    assert ragged["reason"] == "malformed CSV row" and ragged["raw"] == "6,10,2026-01-31"


def test_missing_header_only_and_gzip(spark, tmp_path):
    root = str(tmp_path / "store")
    r = load_table(spark, BILL, str(tmp_path / "nope"), root, schema="raw_t5")
    assert not r.ok and "missing source" in r.error
    r = load_table(spark, BILL, write(tmp_path / "h" / "b.csv", HEADER, []), root, schema="raw_t5")
    assert r.ok and r.rows == 0
    r = load_table(spark, BILL, write(tmp_path / "g" / "b.csv.gz", HEADER, ROWS, gz=True), root,
                   schema="raw_t5")
    assert r.ok and r.rows == 3


def test_sink_contract_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, True, "a,b", None), (2, False, 'q"x', "")],
                               "id bigint, flag boolean, t string, u string")
    out = str(tmp_path / "out")
    write_csv(df, out)
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*.csv")))
    assert "TRUE" in text and "FALSE" in text and '"a,b"' in text and '"q""x"' in text


def test_failed_write_leaves_previous_version(spark, tmp_path):
    root = str(tmp_path / "store")
    ensure_database(spark, "pub_t", root)
    publish(spark, spark.range(3), "pub_t.nums", root)
    boom = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("boom")))
                                 .otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        publish(spark, boom, "pub_t.nums", root)
    assert spark.table("pub_t.nums").count() == 3
    with pytest.raises(PublishError):
        stage_version(spark.range(2), "pub_t.nums", root, expected_rows=5)
    publish(spark, spark.range(5), "pub_t.nums", root)
    assert spark.table("pub_t.nums").count() == 5


def test_publish_all_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "store")
    ensure_database(spark, "pub_t2", root)
    publish_all(spark, {"pub_t2.a": spark.range(10), "pub_t2.b": spark.range(10)}, root)
    boom = spark.range(20).select(F.when(F.col("id") == 19, F.raise_error(F.lit("x")))
                                  .otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        publish_all(spark, {"pub_t2.a": spark.range(20), "pub_t2.b": boom}, root)
    assert (spark.table("pub_t2.a").count(), spark.table("pub_t2.b").count()) == (10, 10)
    publish_all(spark, {"pub_t2.a": spark.range(20), "pub_t2.b": spark.range(20)}, root)
    assert (spark.table("pub_t2.a").count(), spark.table("pub_t2.b").count()) == (20, 20)


def test_part_files_with_different_column_order_are_not_scrambled(spark, tmp_path):
    root = str(tmp_path / "store")
    d = tmp_path / "parts"
    write(d / "part-1.csv", HEADER, ROWS[:1])
    cols = HEADER.split(",")
    write(d / "part-2.csv", ",".join(reversed(cols)), [",".join(reversed(ROWS[0].split(",")))])
    r = load_table(spark, BILL, str(d), root, schema="raw_t6")
    if r.ok:  # loaded: every row must carry the same values, bound by name
        rows = spark.table("raw_t6.bill").collect()
        assert len(rows) == 2 and rows[0]["balance"] == rows[1]["balance"]
    else:  # refused: mismatched headers are an error, never a silent scramble
        assert "part-2.csv" in r.error or "header" in r.error.lower()


def test_publish_all_rolls_back_swaps_when_one_fails(spark, tmp_path, monkeypatch):
    from tessera.plans import publish as P

    root = str(tmp_path / "store")
    ensure_database(spark, "pub_t3", root)
    publish_all(spark, {"pub_t3.a": spark.range(10), "pub_t3.b": spark.range(10)}, root)
    real_swap = P.swap

    def failing_swap(s, v):
        if v.table == "pub_t3.c":
            raise RuntimeError("catalog unavailable")
        real_swap(s, v)

    monkeypatch.setattr(P, "swap", failing_swap)
    with pytest.raises(RuntimeError, match="catalog unavailable"):
        P.publish_all(spark, {"pub_t3.a": spark.range(20), "pub_t3.new": spark.range(5),
                              "pub_t3.c": spark.range(20)}, root)
    monkeypatch.setattr(P, "swap", real_swap)
    assert (spark.table("pub_t3.a").count(), spark.table("pub_t3.b").count()) == (10, 10)
    assert not spark.catalog.tableExists("pub_t3.new")


def test_added_column_is_loaded_and_never_narrowed(spark, tmp_path):
    root = str(tmp_path / "store")
    first = load_table(spark, BILL, write(tmp_path / "a" / "bill.csv", HEADER, ROWS), root, schema="raw_add")
    assert first.ok
    wide = write(tmp_path / "b" / "bill.csv", HEADER + ",_risk", [r + f",r{i}" for i, r in enumerate(ROWS)])
    refused = load_table(spark, BILL, wide, root, schema="raw_add")
    assert not refused.ok and "_RISK" in refused.error
    spark.sql("ALTER TABLE raw_add.bill ADD COLUMNS (`_RISK` STRING)")
    for _ in range(2):
        assert load_table(spark, BILL, wide, root, schema="raw_add").ok
        assert sorted(r[0] for r in spark.table("raw_add.bill").select("_RISK").collect()) == ["r0", "r1", "r2"]
    with pytest.raises(PublishError, match="lacks column"):
        publish(spark, spark.table("raw_add.bill").drop("_RISK"), "raw_add.bill", root)
    assert spark.table("raw_add.bill").count() == 3


def test_corrupt_source_is_a_result(spark, tmp_path):
    from tessera.plans.load import load_all
    root = str(tmp_path / "store")
    good = write(tmp_path / "good" / "bill.csv", HEADER, ROWS)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "policy.csv.gz").write_bytes(b"not gzip")
    res = {r["table_name"]: r for r in load_all(spark, {n: RELATIONAL[n] for n in ("bill", "policy")}, {
        "bill": good, "policy": str(tmp_path / "bad" / "policy.csv.gz")}, root, schema="raw_cor").collect()}
    assert res["raw_cor.bill"]["ok"] and not res["raw_cor.policy"]["ok"] and res["raw_cor.policy"]["error"]


def test_outer_spaces_survive_the_extract(spark, tmp_path):
    path = str(tmp_path / "out")
    write_csv(spark.createDataFrame([("  lead and trail  ",)], "t string"), path)
    from tessera.sources.readers import read_csv_strings
    assert read_csv_strings(spark, path).first()["t"] == "  lead and trail  "


def test_newest_version_of_a_claim_is_one_row(spark):
    from tessera.operators.claims import claims_by_policy
    staged = spark.createDataFrame([("C1", "POL-2", 10.0, 1), ("C1", "POL-1", 99.0, 2), ("C2", "POL-1", 0.004, 1), ("C3", "POL-1", 0.004, 1)],
                                   "claim_id string, policy_number string, estimated_damage_usd double, _loaded_at int")
    pol = spark.createDataFrame([("POL-1",), ("POL-2",)], "policy_number string")
    assert [(r[0], r[1], str(r[2])) for r in claims_by_policy(staged, pol).collect()] == [("POL-1", 3, "99.01")]


def test_first_error_is_the_first_line(spark, tmp_path):
    """Two files read in many byte ranges: the line of every bad row, and the first one in the audit."""
    from tessera.plans import audit as A

    root, folder = str(tmp_path / "store"), tmp_path / "src"
    bad = {"a.csv": [(700, "zzz"), (1203, "aaa"), (1999, "mmm")], "b.csv": [(2, "x"), (900, "b")]}
    for name, wrong in bad.items():
        rows = [ROWS[0]] * 2000
        for line, text in wrong:
            rows[line - 2] = ROWS[0].replace(ROWS[0].split(",")[0], text, 1)
        write(folder / name, HEADER, rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        r = load_table(spark, BILL, str(folder), root, schema="raw_line", on_error="continue")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert r.ok and r.rejects == 5 and r.rows == 3995
    rej = spark.read.parquet(f"{root}/raw_line/bill__rejects/*")
    assert sorted((x["file"], x["line"]) for x in rej.collect()) == sorted((n, line) for n, w in bad.items() for line, _ in w)
    told = {x["file"]: x["error"] for x in A.read_audit(spark, root).collect()}
    assert "first error: line 700: id: cannot convert 'zzz'" in told["a.csv"] and "line 2: id: cannot convert 'x'" in told["b.csv"]
