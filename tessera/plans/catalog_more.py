"""Query catalogue, third part: rows of the survey that had no compared key."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.scalars import ROLE_ANALYST, ROLE_MANAGER
from tessera.operators import masking as MK
from tessera.operators import quality as Q
from tessera.operators.flatten import flatten
from tessera.plans import audit as A
from tessera.plans import standins as SI
from tessera.plans.catalog import ORACLES, _contract, _corrupt_low_priority, _extract, _schema_name, query
from tessera.plans.load import load_table
from tessera.session import work_path
from tessera.sources.contracts import ColumnSpec, TableContract
from tessera.sources.readers import read_json_documents, read_seed

#: Claims of one file of the array landing: an array is one task.
ARRAY_CLAIMS = 1000


def _array_landing(spark, sf_dir):
    """The claim documents as JSON arrays, a folder with one array for each run of claim numbers."""
    t = SI.reader(spark, sf_dir)
    path = work_path(spark, "claims-arrays")
    docs = SI.claim_documents(t("orders"), t("lineitem")).withColumn(
        "run", F.floor(F.get_json_object("value", "$.claim_id").cast("long") / ARRAY_CLAIMS))
    arrays = docs.groupBy("run").agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value"))
    # Grouped by run, a run is already whole in one task: its only file needs no further move.
    SI.write_documents(arrays, path, by="run")
    return read_json_documents(spark, f"{path}/run=*", outer_array=True)


@query("flatten_outer_array", ORACLES["flatten_outer"])
def flatten_outer_array(spark, sf_dir):
    """The outer array of every landed file is stripped, each element one VARIANT row."""
    return flatten(_array_landing(spark, sf_dir), SI.ORDER_CLAIM_SPEC, outer=True)


@query("landing_lineage", f"""
SELECT CAST(floor(o_orderkey / {ARRAY_CLAIMS}) AS BIGINT) AS run, count(*) AS claims, CAST(1 AS BIGINT) AS files, true AS timed
FROM orders GROUP BY 1""")
def landing_lineage(spark, sf_dir):
    """The lineage columns of the landing: every claim names the file of its run, and when it
    was loaded."""
    rows = _array_landing(spark, sf_dir)
    run = F.regexp_extract("_source_path", r"run=(\d+)/[^/]*$", 1).cast("long")
    named = F.expr("endswith(_source_path, _source_file)")
    return (rows.filter(named).groupBy(run.alias("run")).agg(
        F.count_distinct(F.variant_get("raw", "$.claim_id", "bigint")).alias("claims"), F.count_distinct("_source_path").alias("files"),
        F.bool_and(F.col("_loaded_at") > F.lit("2020-01-01").cast("timestamp_ntz")).alias("timed")))


_SEED = TableContract("bill_seed", (ColumnSpec("id", "id"), ColumnSpec("created", "timestamp"), ColumnSpec("due", "date"),
                                    ColumnSpec("active", "bool"), ColumnSpec("amount", "money"), ColumnSpec("note", "text")))
#: Spellings of a boolean in the seed, by remainder of the claim number, and what they mean.
_SPELLINGS = ("true", "1", " T ", "YES", "false", "no", "0", "si", "")


@query("seed_text_values", f"""
SELECT o_orderkey AS id, o_orderdate + INTERVAL 1 SECOND * (o_orderkey % 86400) + INTERVAL 123456 MICROSECOND AS created,
       CAST(o_orderdate AS DATE) + 30 AS due,
       CASE WHEN o_orderkey % 9 < 4 THEN true WHEN o_orderkey % 9 < 8 THEN false END AS active,
       CAST(o_totalprice AS DECIMAL(10,2)) AS amount, CASE WHEN o_orderkey % 2 = 0 THEN 'n' || o_orderkey END AS note
FROM orders""")
def seed_text_values(spark, sf_dir):
    """S1/F-1/F-2/F-6: seed texts of timestamps (with more digits than are kept), dates with a time
    behind them, booleans in nine spellings, amounts and empty texts, compared by value."""
    o, key = SI.reader(spark, sf_dir)("orders"), F.col("o_orderkey")
    moment = F.col("o_orderdate") + F.make_dt_interval(secs=(key % 86400).cast("decimal(18,6)"))
    spelled = F.element_at(F.array(*[F.lit(x) for x in _SPELLINGS]), (key % len(_SPELLINGS) + 1).cast("int"))
    texts = o.select(key.cast("string").alias("id"),
                     F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".123456789Z")).alias("created"),
                     F.concat(F.date_add(F.col("o_orderdate").cast("date"), 30).cast("string"), F.lit("T23:59:59")).alias("due"),
                     spelled.alias("active"), F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("amount"),
                     F.when(key % 2 == 0, F.concat(F.lit("n"), key.cast("string"))).otherwise(F.lit("")).alias("note"))
    path = work_path(spark, "seed-texts")
    texts.select(F.to_json(F.struct(*texts.columns)).alias("value")).write.text(path)
    return read_seed(spark, path, _SEED, multi_line=False)


# Which table of the driver plays which table of the model when it is read under a role.
_ROLE_TABLES = {"policy": "customer", "vehicle": "part", "coverage": "nation", "policy_coverage": "supplier", "vehicle_coverage": "lineitem",
                "bill": "orders", "policy_edit_log": "orders", MK.LANDING: "orders", MK.STAGING: "customer"}


@query("role_reads", " UNION ALL ".join(
    f"SELECT '{role}' AS role, '{name}' AS table_name, {'(SELECT count(*) FROM ' + source + ')' if ok else 'NULL'}::BIGINT AS rows_read, "
    f"{'(SELECT count(*) FROM customer)' if ok and name == MK.STAGING else '0'}::BIGINT AS phones, "
    f"{'(SELECT count(*) FROM customer)' if role == ROLE_ANALYST and name == MK.STAGING else '0'}::BIGINT AS whole_phones"
    for role in (ROLE_ANALYST, ROLE_MANAGER, "ACCOUNTADMIN") for name, source in _ROLE_TABLES.items()
    for ok in [name in MK.ACCESS.get(role, frozenset())]))
def role_reads(spark, sf_dir):
    """Every table of the model, played by a whole table of the driver, read under each role: the
    rows read (NULL: refused), and of the masked phones how many are there and how many are whole."""
    t = SI.reader(spark, sf_dir)
    tables = {n: t(s) for n, s in _ROLE_TABLES.items()}
    tables |= {"bill": SI.bills(t), "policy_edit_log": SI.edit_log(t), MK.STAGING: SI.persons(t),
               MK.LANDING: SI.claim_landing_table(spark, sf_dir)}
    out = None
    for role in (ROLE_ANALYST, ROLE_MANAGER, "ACCOUNTADMIN"):
        for name in _ROLE_TABLES:
            try:
                df = MK.read_as(role, name, tables)
            except MK.AccessDenied:
                df = None
            phone = df is not None and "party_phone" in df.columns
            seen = spark.range(1).select(F.lit(None).cast("long").alias("rows_read"), F.lit(0).cast("long").alias("phones"),
                                         F.lit(0).cast("long").alias("whole_phones")) if df is None else df.agg(
                F.count("*").alias("rows_read"), F.count_if(F.col("party_phone").isNotNull() if phone else F.lit(False)).alias("phones"),
                F.count_if(~F.contains("party_phone", F.lit("*")) if phone else F.lit(False)).alias("whole_phones"))
            row = seen.select(F.lit(role).alias("role"), F.lit(name).alias("table_name"), "*")
            out = row if out is None else out.unionByName(row)
    return out


@query("abort_keeps_table", "SELECT o_orderkey, o_totalprice, 'LOAD_FAILED' AS status FROM orders")
def abort_keeps_table(spark, sf_dir):
    """A load that meets rows it cannot convert is aborted whole; the table keeps every row of
    the version before, and the audit says that the load failed."""
    t = SI.reader(spark, sf_dir)
    root, schema, c = work_path(spark, "abort"), _schema_name(), _contract(t, "orders")
    first = load_table(spark, c, _extract(spark, t, "orders", root), root, schema=schema)
    second = load_table(spark, c, _extract(spark, t, "orders", f"{root}/again", transform=_corrupt_low_priority), root, schema=schema)
    if not first.ok or second.ok:
        raise RuntimeError(first.error or "the damaged load was not refused")
    return spark.table(first.table).select("o_orderkey", "o_totalprice", F.lit(second.status).alias("status"))


@query("not_null_rules", " UNION ALL ".join(
    f"SELECT 'not_null[{t}.{c}]' AS name, n = 0 AS ok, n AS n_offenders FROM (SELECT count(*) FILTER ({e} IS NULL) AS n FROM {t} x)"
    for t, c, e in (("orders", "o_custkey", "nullif(o_custkey % 10, 0)"), ("orders", "o_orderdate", "o_orderdate"),
                    ("customer", "c_name", "c_name"), ("customer", "c_mktsegment", "nullif(c_mktsegment, 'BUILDING')"))))
def not_null_rules(spark, sf_dir):
    """Q9: the NOT NULL columns of the strict contract as rules; two of them are broken on purpose by
    emptying the values of every tenth policy and of one segment."""
    t = SI.reader(spark, sf_dir)
    frames = {"orders": t("orders").withColumn("o_custkey", F.nullif(F.col("o_custkey") % 10, F.lit(0))),
              "customer": t("customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))}
    strict = {"orders": TableContract("orders", (ColumnSpec("o_orderkey", "id", True), ColumnSpec("o_custkey", "id", True),
                                                 ColumnSpec("o_orderdate", "timestamp", True), ColumnSpec("o_totalprice", "double")), ("o_orderkey",)),
              "customer": TableContract("customer", (ColumnSpec("c_custkey", "id", True), ColumnSpec("c_name", "text", True),
                                                     ColumnSpec("c_mktsegment", "text", True)), ("c_custkey",))}
    rules = [r for r in Q.contract_rules(strict, not_null_columns=True) if r.name.startswith("not_null[")]
    return Q.rule_counts(frames.__getitem__, rules)


@query("latest_load_order", " UNION ALL ".join(
    f"SELECT {n + 1}::BIGINT AS position, '{name.upper()}' AS table_name, count(*) AS rows_loaded FROM {name}"
    for n, name in enumerate(("supplier", "customer", "nation"))))
def latest_load_order(spark, sf_dir):
    """Tables loaded one after the other; the audit lists the latest load first."""
    t = SI.reader(spark, sf_dir)
    root, schema = work_path(spark, "latest-order"), _schema_name()
    for name in ("nation", "customer", "supplier"):
        res = load_table(spark, _contract(t, name), _extract(spark, t, name, root), root, schema=schema)
        if not res.ok:
            raise RuntimeError(res.error)
    per_table = A.read_audit(spark, root).groupBy("table_name").agg(F.sum("rows").alias("rows_loaded"), F.max("loaded_at").alias("loaded_at"),
                                                                    F.max("id").alias("id"))
    listed = A.latest(per_table).withColumn("position", F.row_number().over(Window.orderBy(F.desc("loaded_at"), F.desc("id"))).cast("long"))
    return listed.select("position", "table_name", "rows_loaded")
