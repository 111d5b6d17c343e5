"""Query catalogue, second part: commits, recovery, and state kept up to date between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import late_fee_rate
from tessera.operators import claims_state, integrity, variant_drift
from tessera.operators.flatten import flatten
from tessera.operators.payments import apply_payments
from tessera.plans import audit as A
from tessera.plans import manifest as M, retention
from tessera.plans import standins as SI
from tessera.plans.catalog import (ORACLES, _BILLS_SELECT, _EXTRA_SQL, _LOG_SELECT, _NOT_EMPTY_SQL, _ORPHAN_SQL, _PAY_SQL_BASE,
                                   _PK_NULL_SQL, _RATE_SQL, _RUNS, _UNIQUE_SQL, _apply, _corrupt_low_priority, _report_sql, _schema_name, query)
from tessera.plans.publish import ensure_database, entry_of, publish_all, recover, stage_version
from tessera.plans.layout import publish_bucketed
from tessera.plans.load import load_table
from tessera.session import work_path
from tessera.sources.contracts import contract_from_schema
from tessera.sources.readers import list_files
from tessera.sources.sinks import to_csv_strings
from tessera.streaming import ledger
from tessera.streaming.ingest import CHILD_TASK, ROOT_TASK

_BILLS_AFTER = _BILLS_SELECT.replace("SELECT b.id,", ", paid AS (SELECT b.id,", 1) + ")"


def _books(step: str, bills: DataFrame, log: DataFrame) -> DataFrame:
    """What a reader finds in the two tables at one moment."""
    return (bills.agg(F.count("*").alias("rows"), F.sum("balance").cast("decimal(20,2)").alias("open_balance"),
                      F.count_if(F.col("status") == "Paid").alias("paid"))
            .select(F.lit(step).alias("step"), F.lit("bill").alias("table_name"), "*")
            .unionByName(log.agg(F.count("*").alias("rows")).select(
                F.lit(step).alias("step"), F.lit("policy_edit_log").alias("table_name"), "rows",
                F.lit(None).cast("decimal(20,2)").alias("open_balance"), F.lit(None).cast("bigint").alias("paid"))))


@query("payments_commit_recovery", _PAY_SQL_BASE + _BILLS_AFTER + """
, steps AS (SELECT unnest(['1 written', '2 committed', '3 recovered']) AS step)
SELECT step, 'bill' AS table_name, count(*) AS rows,
       CAST(sum(CASE WHEN step = '1 written' THEN b.balance ELSE paid.balance END) AS DECIMAL(20,2)) AS open_balance,
       count(*) FILTER (CASE WHEN step = '1 written' THEN b.status ELSE paid.status END = 'Paid') AS paid
FROM steps, b JOIN paid ON paid.id = b.id GROUP BY step
UNION ALL
SELECT step, 'policy_edit_log', (SELECT count(*) FROM orders)
       + CASE WHEN step = '1 written' THEN 0 ELSE (SELECT count(*) FROM applied) END, NULL, NULL FROM steps""")
def payments_commit_recovery(spark, sf_dir):
    """Bills and edit log as readers of the manifest find them when the driver is lost
    after writing both versions (both old), when it is lost right after the commit, before the
    catalog tables followed (both new), and in the catalog tables after ``recover`` (both new)."""
    t = SI.reader(spark, sf_dir)
    root, db = work_path(spark, "pay-commit"), _schema_name("pay")
    bill, log = f"{db}.bill", f"{db}.policy_edit_log"
    ensure_database(spark, db, root)
    publish_all(spark, {bill: SI.bills(t), log: SI.edit_log(t)}, root)
    run, state = _apply(spark, sf_dir), M.snapshot(spark, root, db)
    written = [stage_version(run.bills, bill, root), stage_version(run.edit_log, log, root)]
    found = []

    def look(step):
        s = M.snapshot(spark, root, db)
        found.append(_books(step, s.table(spark, bill), s.table(spark, log)))
    look("1 written")
    M.commit(spark, state, {v.table: entry_of(spark, v) for v in written}, reads=(bill, log))
    look("2 committed")
    recover(spark, root, db)
    found.append(_books("3 recovered", spark.table(bill), spark.table(log)))
    return found[0].unionByName(found[1]).unionByName(found[2])


# --- a hot bill that never gets to zero -------------------------------------------------------
# Every credit-card line (a third of all payment rows) becomes two payments on one overdue bill:
# its surcharge plus, then minus, a few cents. The balance goes down and comes back for ever.
STEADY_ORDER = ("pay_src", "pay_line", "pay_part", "pay_supplier", "half", "amount", "payment_method")

_STEADY_SQL_BASE = (
    _PAY_SQL_BASE
    .replace("pay AS (SELECT l_orderkey AS bill_id,", "pay0 AS (SELECT l_orderkey AS bill_id, l_orderkey AS pay_src,")
    .replace("chk AS (SELECT pay.*,", f"""late AS (SELECT id, balance, greatest(DATE '{SI.PAYMENTS_AS_OF}' - due_date, 0) AS days FROM b),
rated AS (SELECT id, balance, {_RATE_SQL.format(d='days', b='balance')} AS rate FROM late),
hot AS (SELECT id, CAST(round(balance * rate, 2) AS DECIMAL(10,2)) AS s FROM rated WHERE rate > 0
        ORDER BY CAST(balance * 100 AS BIGINT) * CAST(rate * 1000 AS BIGINT) % 1000, id LIMIT 1),
pay AS (SELECT *, 0 AS half FROM pay0 WHERE payment_method <> 'credit_card'
        UNION ALL SELECT hot.id, pay_src, pay_line, pay_part, pay_supplier,
               CAST(s + (1 - 2 * half) * (pay_part % 5) / CAST(100 AS DECIMAL(5,2)) AS DECIMAL(10,2)),
               payment_method, edited_by, half
        FROM pay0, hot, (SELECT unnest([0, 1]) AS half) WHERE payment_method = 'credit_card'),
chk AS (SELECT pay.*,""")
    .replace("ORDER BY pay_line, pay_part, pay_supplier, amount, payment_method", f"ORDER BY {', '.join(STEADY_ORDER)}"))


def steady_payments(t) -> tuple[DataFrame, int]:
    """The payments, and the bill that gets all of the credit card (found with one aggregate)."""
    late = SI.bills(t).withColumn("days", F.greatest(F.datediff(F.lit(SI.PAYMENTS_AS_OF).cast("date"), "due_date"), F.lit(0)))
    rated = late.withColumn("rate", late_fee_rate("days", "balance")).where("rate > 0")
    left = (F.col("balance") * 100).cast("bigint") * (F.col("rate") * 1000).cast("bigint") % 1000
    hot = rated.agg(F.min_by(F.struct("id", F.round(F.col("balance") * F.col("rate"), 2).cast("decimal(10,2)").alias("s")),
                             F.struct(left.alias("left"), "id")).alias("hot")).first()["hot"]
    card, cents = F.col("payment_method") == "credit_card", (F.col("pay_part") % 5).cast("decimal(10,2)") / 100
    pays = SI.payments(t).withColumn("pay_src", F.col("bill_id")).withColumn(
        "half", F.explode(F.when(card, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return pays.withColumns({
        "bill_id": F.when(card, F.lit(hot["id"])).otherwise(F.col("bill_id")),
        "amount": F.when(card, (F.lit(hot["s"]) + F.when(F.col("half") == 0, cents).otherwise(-cents)).cast("decimal(10,2)"))
        .otherwise(F.col("amount"))}), hot["id"]


def _apply_steady(spark, sf_dir):
    key = (*SI.input_version(spark, sf_dir), "steady")
    if key not in _RUNS:
        t = SI.reader(spark, sf_dir)
        _RUNS[key] = apply_payments(spark, SI.bills(t), steady_payments(t)[0], SI.edit_log(t), as_of=SI.PAYMENTS_AS_OF,
                                    edited_at=SI.PAYMENTS_EDITED_AT, order_cols=STEADY_ORDER)
    return _RUNS[key]


@query("hot_bill_steady_log", _STEADY_SQL_BASE + _LOG_SELECT)
def hot_bill_steady_log(spark, sf_dir):
    """U2 with a hot bill whose balance never reaches zero: every payment's surcharge and balance."""
    return _apply_steady(spark, sf_dir)["log"]


@query("hot_bill_steady_bills", _STEADY_SQL_BASE + _BILLS_SELECT)
def hot_bill_steady_bills(spark, sf_dir):
    """U2 with a hot bill whose balance never reaches zero: the bills afterwards."""
    return _apply_steady(spark, sf_dir)["bills"].select("id", "policy_id", "due_date", "balance", "status", "payment_method")


# --- the validation report with its samples ---------------------------------------------------

def _first_sql(rule, rows, shown, order):
    """The first three of ``rows`` as one text."""
    text = " || ', ' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in shown)
    return (f"SELECT '{rule}' AS name, string_agg('(' || {text} || ')', ', ' ORDER BY {order}) AS sample "
            f"FROM (SELECT * FROM ({rows}) ORDER BY {order} LIMIT 3)")


def _detail_sql() -> str:
    samples = []
    for t, (pk, _) in SI.KEYS.items():
        k = ", ".join(pk)
        samples.append(_first_sql(f"pk_unique[{t}]", f"SELECT {k}, count(*) AS times FROM {t} GROUP BY {k} HAVING count(*) > 1", (*pk, "times"), k))
        samples.append(_first_sql(f"pk_not_null[{t}]", f"SELECT {k} FROM {t} WHERE {' OR '.join(f'{c} IS NULL' for c in pk)}", pk, k))
    relations = [(f"no_orphans[{t}.{fk}]", t, fk, parent, key) for t, (_, fks) in SI.KEYS.items() for fk, parent, key in fks]
    for name, child, fk, parent, key in [*relations, *SI.REVERSE]:
        own = [c for c in SI.KEYS[child][0] if c != fk]
        least = f"arg_min({{{', '.join(f'{c}: {c}' for c in own)}}}, ({', '.join([*own, '0'])}))" if own else "NULL"
        first = [f"(row_of).{c}" for c in own]
        samples.append(_first_sql(name, f"SELECT {fk}, {least} AS row_of FROM {child} c WHERE {fk} IS NOT NULL AND NOT EXISTS "
                                        f"(SELECT 1 FROM {parent} p WHERE p.{key} = c.{fk}) GROUP BY {fk}", (*first, fk), fk))
    samples.append(_first_sql("unique[customer.c_name]", "SELECT min(c_custkey) AS c_custkey, c_name, count(*) AS times FROM customer "
                              "GROUP BY c_name HAVING count(*) > 1", ("c_custkey", "c_name", "times"), "c_custkey"))
    samples.append(_first_sql("max_length[customer.c_name]", "SELECT c_name FROM customer WHERE length(c_name) > 20", ("c_name",), "c_name"))
    samples.append(_first_sql("date_order[lineitem]", "SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate FROM lineitem JOIN orders "
                              "ON o_orderkey = l_orderkey WHERE l_shipdate < o_orderdate",
                              ("l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate"), "l_orderkey, l_linenumber, l_shipdate, o_orderdate"))
    samples.append(_first_sql("paid_zero_balance[orders]", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE "
                              "upper(o_orderstatus) = 'F' AND coalesce(o_totalprice, 0) <> 0", ("o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderkey"))
    return (f"WITH report AS ({_report_sql(_PK_NULL_SQL + _UNIQUE_SQL + _ORPHAN_SQL + _NOT_EMPTY_SQL + _EXTRA_SQL)}),\n"
            f"samples AS ({' UNION ALL '.join(samples)})\n"
            "SELECT name, ok, n_offenders, CASE WHEN ok THEN 'no problems' ELSE n_offenders || ' row(s)' || "
            "coalesce(', e.g.: ' || sample, '') END AS detail FROM report LEFT JOIN samples USING (name)")


@query("dq_detail", _detail_sql())
def dq_detail(spark, sf_dir):
    """The whole rule set with the first offenders of every failed rule."""
    return integrity.detail(SI.reader(spark, sf_dir), SI.standin_rules())


# --- claims per policy, kept up to date -------------------------------------------------------

@query("claims_by_policy_updated", """
WITH last AS (SELECT max(year(o_orderdate)) AS y FROM orders),
c AS (SELECT o_orderkey, CASE WHEN year(o_orderdate) < y THEN o_custkey
                              WHEN o_custkey % 2 = 0 THEN o_custkey + 1 ELSE o_custkey - 1 END AS policy_number,
             CAST(o_totalprice AS DECIMAL(28,10)) + CASE WHEN year(o_orderdate) < y THEN 0 ELSE 10 END AS damage
      FROM orders, last)
SELECT policy_number, c_name AS policy_name, count(*) AS claims,
       CAST(round(sum(damage), 2) AS DECIMAL(38,2)) AS damage_usd
FROM c JOIN customer ON c_custkey = policy_number GROUP BY policy_number, c_name""")
def claims_by_policy_updated(spark, sf_dir):
    """All claims in a first batch; a second one exports the last year's claims again,
    under another policy and with another amount. The kept report equals the whole recomputation."""
    t = SI.reader(spark, sf_dir)
    root, db = work_path(spark, "claim-state"), _schema_name("claims")
    staged = flatten(SI.claim_landing_table(spark, sf_dir), SI.ORDER_CLAIM_SPEC, outer=True)
    last = t("orders").agg(F.max(F.year("o_orderdate"))).first()[0]
    policy = F.col("policy_number")
    again = staged.filter(F.year("reported_at") == last).withColumns({
        "policy_number": F.when(policy % 2 == 0, policy + 1).otherwise(policy - 1),
        "estimated_damage_usd": F.col("estimated_damage_usd").cast("decimal(28,10)") + 10})
    claims_state.apply_batch(spark, staged, 1, root, db)
    state = claims_state.apply_batch(spark, again, 2, root, db).state
    policies = t("customer").select(F.col("c_custkey").alias("policy_number"), F.col("c_name").alias("policy_name"))
    return claims_state.claims_by_policy(spark, state, policies, policy_columns=("policy_name",))


# --- landing with a ledger --------------------------------------------------------------------

def _file_system(spark, path):
    fs, p = M.file_system(spark, path)
    return fs, p, spark._jvm.org.apache.hadoop.fs.Path


def _ledger_runs(spark, sf_dir):
    """Four runs over one folder: all claims but the last year's; a landed file rewritten, and the
    last year's claims, one of whose files is very old; a malformed file beside a good one; and
    the same again without the malformed one."""
    t = SI.reader(spark, sf_dir)
    root, db = work_path(spark, "ledger"), _schema_name("raw_json")
    o, li = t("orders"), t("lineitem")
    last = o.agg(F.max(F.year("o_orderdate"))).first()[0]

    def documents(name, orders):
        SI.write_documents(SI.claim_documents(orders, li), f"{root}/src/{name}")

    def listing(glob="part-*"):
        return lambda: list_files(spark, f"{root}/src", glob)

    def run(found):
        return ledger.run(spark, found, root, db, rebuild=lambda landing: flatten(landing, SI.ORDER_CLAIM_SPEC, outer=True))

    runs = []
    documents("week1", o.filter(F.year("o_orderdate") < last))
    runs.append(run(listing()))
    first = list_files(spark, f"{root}/src/week1", "part-*").agg(F.min("path")).first()[0]
    fs, path, _ = _file_system(spark, first)
    out = fs.create(path, True)
    out.write(bytearray(b'{"claim_id": -1}\n'))
    out.close()
    documents("week2", o.filter(F.year("o_orderdate") == last))
    old = list_files(spark, f"{root}/src/week2", "part-*").agg(F.max("path")).first()[0]
    fs.setTimes(_file_system(spark, old)[1], 1000, -1)
    runs.append(run(listing()))
    before = M.snapshot(spark, root, db)
    fs, path, _ = _file_system(spark, f"{root}/src/week3/part-bad.txt")
    out = fs.create(path, True)
    out.write(bytearray(b'{"claim_id": 5}\n{"claim_id": \n'))
    out.close()
    runs.append(run(listing()))
    if M.snapshot(spark, root, db) != before:
        raise RuntimeError("a malformed file has changed landing or ledger")
    runs.append(run(listing("part-0*")))
    return root, db, runs


@query("ledger_ingest", ORACLES["incremental_ingest"])
def ledger_ingest(spark, sf_dir):
    """S20/W1/W2/W5 with a ledger of landed files: staging after the four runs."""
    root, db, _ = _ledger_runs(spark, sf_dir)
    rows = ledger.read(spark, M.snapshot(spark, root, db), ledger.STAGING)
    return rows.select("claim_id", "item_part", "item_line", "batch_id")


@query("ledger_runs", """
WITH y AS (SELECT max(year(o_orderdate)) AS last FROM orders),
n AS (SELECT count(*) FILTER (year(o_orderdate) < last) AS old, count(*) FILTER (year(o_orderdate) = last) AS new FROM orders, y),
h AS (SELECT * FROM (VALUES (1, true), (2, true), (3, false), (4, true)) t(run, ok))
SELECT CAST(run AS INTEGER) AS run, ok, CAST(CASE run WHEN 1 THEN old WHEN 2 THEN new ELSE 0 END AS BIGINT) AS claims_landed,
       CASE WHEN ok THEN 'SUCCEEDED' ELSE 'FAILED' END AS root_state, CASE WHEN ok THEN 'SUCCEEDED' END AS child_state
FROM h, n""")
def ledger_runs(spark, sf_dir):
    """W4/W5/F-20: what each of the four runs landed, and the states of its two steps in the run
    history (the third fails at its malformed file, lands nothing and starts no dependent step)."""
    root, db, runs = _ledger_runs(spark, sf_dir)
    landed = ledger.read(spark, M.snapshot(spark, root, db), ledger.LANDING)
    claims = landed.select((F.col("batch_id") + 1).cast("int").alias("run"), F.variant_get("raw", "$.claim_id", "bigint").alias("c")) \
        .groupBy("run").agg(F.count_distinct("c").alias("claims"))
    history = A.run_history(spark, root, hours=24, limit=100).withColumn("at", F.row_number().over(
        Window.partitionBy("name").orderBy("scheduled_time")))
    told = spark.createDataFrame([(n + 1, r.ok) for n, r in enumerate(runs)], "run int, ok boolean")
    child_at = F.count_if("ok").over(Window.orderBy("run"))  # one row per run of this query
    told = told.withColumn("child_at", F.when(F.col("ok"), child_at))

    def state(name, alias):
        return history.filter(F.col("name") == name).select(F.col("at").alias(f"{alias}_at"), F.col("state").alias(alias))
    return (told.join(claims, "run", "left").join(state(ROOT_TASK, "root_state"), F.col("run") == F.col("root_state_at"), "left")
            .join(state(CHILD_TASK, "child_state"), F.col("child_at") == F.col("child_state_at"), "left")
            .select("run", "ok", F.coalesce("claims", F.lit(0)).alias("claims_landed"), "root_state", "child_state"))


@query("versions_swept", """
SELECT CAST(2 AS BIGINT) AS manifests, CAST(2 AS BIGINT) AS versions, o_orderstatus AS status, count(*) AS rows FROM orders GROUP BY o_orderstatus""")
def versions_swept(spark, sf_dir):
    """Five reloads of a table and a sweep that keeps two states; the live rows are whole."""
    t = SI.reader(spark, sf_dir)
    root, db = work_path(spark, "sweep"), _schema_name("swept")
    ensure_database(spark, db, root)
    for _ in range(5):
        publish_all(spark, {f"{db}.orders": t("orders")}, root)
    retention.sweep(spark, root, db, keep=2)
    left = len(M.numbers(spark, root, db)), len(retention._version_folders(spark, root, db))
    rows = M.snapshot(spark, root, db).table(spark, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("rows"))
    return rows.select(F.lit(left[0]).cast("long").alias("manifests"), F.lit(left[1]).cast("long").alias("versions"), "status", "rows")


# --- the first error of a file ----------------------------------------------------------------

@query("first_load_errors", """
WITH f AS (SELECT *, year(o_orderdate) AS file_year, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) + 1 AS line FROM orders),
bad AS (SELECT * FROM f WHERE o_orderpriority = '5-LOW' QUALIFY row_number() OVER (PARTITION BY file_year ORDER BY line) = 1)
SELECT 'PARTIALLY_LOADED' AS status, n.rows, (SELECT count(*) FROM f WHERE f.file_year = bad.file_year AND o_orderpriority = '5-LOW')
       || ' row(s) rejected; first error: line ' || line || ': o_totalprice: cannot convert ''USD ' || CAST(o_totalprice AS VARCHAR)
       || ''' to double' AS error
FROM bad JOIN (SELECT file_year, count(*) FILTER (o_orderpriority <> '5-LOW') AS rows FROM f GROUP BY 1) n USING (file_year)""")
def first_load_errors(spark, sf_dir):
    """One file for each year, sorted by claim, low-priority rows damaged; the audit names
    the first bad line of every file."""
    t = SI.reader(spark, sf_dir)
    root, db = work_path(spark, "first-errors"), _schema_name()
    orders = t("orders")
    c = contract_from_schema("orders", orders.schema, ("o_orderkey",))
    text = to_csv_strings(_corrupt_low_priority(orders)).withColumn("y", F.year("o_orderdate"))
    for year in [r[0] for r in text.select("y").distinct().collect()]:  # a write each: file names differ
        (text.filter(F.col("y") == year).drop("y").repartition(1).sortWithinPartitions(F.col("o_orderkey").cast("long"))
         .write.option("header", True).option("nullValue", "").option("emptyValue", '""').csv(f"{root}/extract/y{year}"))
    res = load_table(spark, c, f"{root}/extract/y*", root, schema=db, on_error="continue")
    if not res.ok:
        raise RuntimeError(res.error)
    return A.read_audit(spark, root).select("status", "rows", "error")


# --- drift of schema-on-read documents --------------------------------------------------------

_ITEM_TYPES = {"part": "BIGINT", "supplier": "BIGINT", "line": "BIGINT", "quantity": "DECIMAL", "price": "DECIMAL",
               "discount": "DECIMAL", "tax": "DECIMAL", "return_flag": "STRING", "line_status": "STRING", "shipped_at": "STRING"}
_CLAIM_TYPES = {"claim_id": "BIGINT", "policy_number": "BIGINT", "status": "STRING", "estimated_damage_usd": "DECIMAL",
                "reported_at": "STRING", "incident_type": "STRING", "items": "ARRAY"}


@query("variant_profile", f"""
WITH o AS (SELECT count(*) AS docs, count(*) FILTER (EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) AS full_docs FROM orders),
p AS (SELECT '$' AS path, 'OBJECT' AS type, false AS item
      UNION ALL SELECT * FROM (VALUES {', '.join(f"('$.{k}', '{v}', false)" for k, v in _CLAIM_TYPES.items())})
      UNION ALL SELECT '$.items[]', 'OBJECT', true
      UNION ALL SELECT * FROM (VALUES {', '.join(f"('$.items[].{k}', '{v}', true)" for k, v in _ITEM_TYPES.items())}))
SELECT path, type, CASE WHEN item THEN full_docs ELSE docs END AS docs FROM p, o""")
def variant_profile(spark, sf_dir):
    """D10/F-19: every path of the landed claim documents with its type and the documents that have it."""
    landing = SI.claim_landing_table(spark, sf_dir).withColumn("batch_id", F.lit(0))
    return variant_drift.profile(landing).select("path", "type", "docs")


@query("variant_drift", """
WITH n AS (SELECT event_id % 3 AS batch, count(*) AS docs, count(*) FILTER (value > 50) AS large FROM events GROUP BY 1),
s AS (SELECT batch, large / docs AS share FROM n)
SELECT 1 AS batch, '$.channel' AS path, 'added' AS kind, NULL AS old_type, 'STRING' AS new_type, CAST(NULL AS DOUBLE) AS old_share, 1.0::DOUBLE AS new_share
UNION ALL SELECT 1, '$.k', 'widened', 'BIGINT', 'DECIMAL', 1.0, 1.0
UNION ALL SELECT 2, '$.channel', 'gone', 'STRING', NULL, 1.0, NULL
UNION ALL SELECT 2, '$.k', 'changed', 'DECIMAL', 'STRING', 1.0, 1.0
UNION ALL SELECT 2, '$.' || k, 'added', NULL, t, NULL, share
FROM s, (VALUES ('extra', 'ARRAY'), ('extra[]', 'OBJECT'), ('extra[].v', 'STRING')) x(k, t) WHERE s.batch = 2""")
def variant_drift_key(spark, sf_dir):
    """The events' documents in three batches; the second has a new key and fractions for whole
    numbers, the third loses the key, holds texts for numbers and, of large values, a nested list."""
    e, batch = SI.reader(spark, sf_dir)("events"), (F.col("event_id") % 3).cast("int")
    k = F.get_json_object("props", "$.k")
    text = (F.when(batch == 0, F.col("props")).when(batch == 1, F.concat(F.lit('{"k": '), k, F.lit('.5, "channel": "'), F.col("event_type"), F.lit('"}')))
            .otherwise(F.concat(F.lit('{"k": "'), k, F.lit('"'), F.when(F.col("value") > 50, F.concat(
                F.lit(', "extra": [{"v": "'), F.col("event_type"), F.lit('"}]'))).otherwise(F.lit("")), F.lit("}"))))
    return variant_drift.drift(variant_drift.profile(e.select(batch.alias("batch_id"), F.parse_json(text).alias("raw"))))


# --- access paths with a layout behind them ---------------------------------------------------

BUCKETS = 16


@query("bills_of_policy_bucketed", ORACLES["bills_of_policy"])
def bills_of_policy_bucketed(spark, sf_dir, policy_id: int = 7):
    """The bills of one policy from a table in buckets of the policy, sorted by due date: the
    lookup reads one bucket's file (``tests/test_layout.py`` counts)."""
    t = SI.reader(spark, sf_dir)
    root, db = work_path(spark, "bucketed"), _schema_name("lookup")
    ensure_database(spark, db, root)
    publish_bucketed(spark, SI.bills(t), f"{db}.bill", root, "policy_id", buckets=BUCKETS, sort=("due_date", "id"))
    return (spark.table(f"{db}.bill").where(F.col("policy_id") == policy_id)
            .select("id", "policy_id", "due_date", "balance").orderBy("due_date", "id"))


@query("bucketed_join", """
SELECT o_orderpriority AS priority, count(*) AS items, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS quantity
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_orderpriority""")
def bucketed_join(spark, sf_dir):
    """Child and parent in equal buckets of the shared key are joined without moving either."""
    t = SI.reader(spark, sf_dir)
    root, db = work_path(spark, "bucketed"), _schema_name("lookup")
    ensure_database(spark, db, root)
    publish_bucketed(spark, t("orders").select(F.col("o_orderkey").alias("claim"), "o_orderpriority"), f"{db}.claim", root, "claim", buckets=BUCKETS)
    publish_bucketed(spark, t("lineitem").select(F.col("l_orderkey").alias("claim"), "l_quantity"), f"{db}.item", root, "claim", buckets=BUCKETS)
    return (spark.table(f"{db}.item").join(spark.table(f"{db}.claim"), "claim").groupBy(F.col("o_orderpriority").alias("priority"))
            .agg(F.count("*").alias("items"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(28,2)").alias("quantity")))
