"""Query catalogue: every operator as a (spark, sf_dir) -> DataFrame over the driver's tables,
with an equivalent DuckDB SQL oracle where one exists.

Queries that load files (landing documents, CSV extracts, versions) write them under the shared
work folder first (``spark.checkpoint.dir``) and return a lazy DataFrame over the result.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import claims as C
from tessera.operators.flatten import (
    one_row_per_key,
    flatten, line_total_offenders, reconcile, with_flattened_at,
)
from tessera.plans import standins as SI
from tessera.sources.readers import read_json_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle.strip()
        return fn
    return register


def _staged_claims(spark: SparkSession, sf_dir: str, outer: bool = True,
                   from_json: bool = False) -> DataFrame:
    """Flattened claims, from the JSON files (``from_json``) or the Parquet landing table."""
    if from_json:
        landing = read_json_documents(spark, SI.land_claim_documents(spark, sf_dir),
                                      outer_array=False)
    else:
        landing = SI.claim_landing_table(spark, sf_dir)
    return flatten(landing, SI.ORDER_CLAIM_SPEC, outer=outer)


_FLAT_COLS = """
    o.o_orderkey AS claim_id, o.o_custkey AS policy_number, o.o_orderstatus AS claim_status,
    o.o_totalprice AS estimated_damage_usd, o.o_orderdate AS reported_at,
    o.o_orderpriority AS incident_type, l.l_partkey AS item_part, l.l_suppkey AS item_supplier,
    l.l_linenumber AS item_line, l.l_quantity AS item_quantity, l.l_extendedprice AS item_price,
    l.l_discount AS item_discount, l.l_tax AS item_tax, l.l_returnflag AS item_return_flag,
    l.l_linestatus AS item_line_status, l.l_shipdate AS item_shipped_at"""


@query("flatten_outer", f"SELECT {_FLAT_COLS} FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey")
def flatten_outer(spark, sf_dir):
    """S18+S19+J4+F3: documents landed as VARIANT, outer flatten (claims without items kept)."""
    return _staged_claims(spark, sf_dir, outer=True, from_json=True).drop(
        "_source_file", "_source_path", "_loaded_at")


@query("flatten_inner", f"SELECT {_FLAT_COLS} FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey")
def flatten_inner(spark, sf_dir):
    """J3+F2: inner flatten; a document with an empty array yields no row."""
    return _staged_claims(spark, sf_dir, outer=False, from_json=True).drop(
        "_source_file", "_source_path", "_loaded_at")


@query("variant_paths", """
SELECT event_id, event_type,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       CAST(json_extract_string(props, '$.absent') AS VARCHAR) AS absent
FROM events""")
def variant_paths(spark, sf_dir):
    """P3+D10: schema-on-read path access with strict casts; an absent key is NULL."""
    e = SI.reader(spark, sf_dir)("events")
    v = F.parse_json("props")
    return e.select("event_id", "event_type", F.variant_get(v, "$.k", "int").alias("k"),
                    F.variant_get(v, "$.absent", "string").alias("absent"))


_BY_POLICY_SQL = """
SELECT c.c_custkey AS policy_number, c.c_name AS policy_name, count(*) AS claims,
       CAST(round(sum(CAST(o.o_totalprice AS DECIMAL(18,2))), 2) AS DECIMAL(38,2)) AS damage_usd
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
GROUP BY c.c_custkey, c.c_name"""


def _policies(spark, sf_dir):
    return SI.reader(spark, sf_dir)("customer").select(
        F.col("c_custkey").alias("policy_number"), F.col("c_name").alias("policy_name"))


@query("claims_by_policy", _BY_POLICY_SQL)
def claims_by_policy(spark, sf_dir):
    """F4 (correct): one row per claim before summing damage per policy, joined to policies."""
    return C.claims_by_policy(_staged_claims(spark, sf_dir), _policies(spark, sf_dir),
                              policy_columns=("policy_name",))


@query("top_policies_by_damage", _BY_POLICY_SQL + """
ORDER BY damage_usd DESC, policy_number""")
def top_policies_by_damage(spark, sf_dir):
    """O2: the whole policy report ordered by damage (descending, key as tie-break)."""
    return C.ranked(claims_by_policy(spark, sf_dir))


@query("claims_by_policy_as_reference", """
SELECT c.c_custkey AS policy_number, c.c_name AS policy_name,
       count(DISTINCT o.o_orderkey) AS claims,
       CAST(round(sum(CAST(o.o_totalprice AS DECIMAL(18,2))), 2) AS DECIMAL(38,2)) AS damage_usd
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY c.c_custkey, c.c_name""")
def claims_by_policy_as_reference(spark, sf_dir):
    """F4 (fanned, for parity): damage summed over every flattened row."""
    return C.claims_by_policy_as_reference(_staged_claims(spark, sf_dir),
                                           _policies(spark, sf_dir),
                                           policy_columns=("policy_name",))


@query("flatten_reconcile", """
WITH f AS (SELECT o.o_orderkey, count(l.l_orderkey) AS n
           FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey)
SELECT count(*) AS claims, CAST(sum(greatest(n, 1)) AS BIGINT) AS staged_rows,
       CAST(sum(greatest(n, 1)) AS BIGINT) AS expected_rows, CAST(0 AS BIGINT) AS missing_keys, true AS ok
FROM f""")
def flatten_reconcile(spark, sf_dir):
    """landing vs the published staging table: staged rows = sum(max(1, items)) and no claim
    missing."""
    landing = SI.claim_landing_table(spark, sf_dir)
    root, schema = work_path(spark, "reconcile"), _schema_name()
    ensure_database(spark, schema, root)
    publish(spark, flatten(landing, SI.ORDER_CLAIM_SPEC, outer=True), f"{schema}.stg_claims", root)
    return reconcile(landing, spark.table(f"{schema}.stg_claims"), SI.ORDER_CLAIM_SPEC, "claim_id").drop("documents")


@query("line_total_rule", """
WITH s AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS line_sum
           FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey AS claim_id, CAST(o.o_totalprice AS DECIMAL(18,2)) AS total,
       CAST(coalesce(s.line_sum, 0) AS DECIMAL(38,2)) AS line_sum
FROM orders o LEFT JOIN s ON s.l_orderkey = o.o_orderkey
WHERE abs(CAST(o.o_totalprice AS DECIMAL(18,2)) - coalesce(s.line_sum, 0)) > 0.005""")
def line_total_rule(spark, sf_dir):
    """claims whose declared total differs from the sum of their item costs."""
    staged = _staged_claims(spark, sf_dir)
    docs = one_row_per_key(staged, "claim_id", ["estimated_damage_usd"])
    lines = staged.where(F.col("item_price").isNotNull()).select("claim_id", "item_price")
    out = line_total_offenders(docs, lines, "claim_id", "estimated_damage_usd", "item_price")
    return out.select("claim_id", "total", F.col("line_sum").cast("decimal(38,2)").alias("line_sum"))


# ----------------------------------------------------------------------------------------------
# Data quality (Q1-Q12)
# ----------------------------------------------------------------------------------------------
from tessera.operators import quality as Q  # noqa: E402


def _counts_of(spark, sf_dir, prefix: tuple[str, ...]) -> DataFrame:
    t = SI.reader(spark, sf_dir)
    rules = [r for r in SI.standin_rules() if r.name.startswith(prefix)]
    return Q.rule_counts(t, rules)


def _sql_pk_null(t, pk):
    cond = " OR ".join(f"{k} IS NULL" for k in pk)
    return f"SELECT 'pk_not_null[{t}]' AS name, count(*) FILTER (WHERE {cond}) AS n FROM {t}"


def _sql_unique(t, keys, name=None):
    k = ", ".join(keys)
    return (f"SELECT '{name or f'pk_unique[{t}]'}' AS name, count(*) AS n FROM "
            f"(SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)")


def _sql_orphans(name, child, fk, parent, pk):
    return (f"SELECT '{name}' AS name, count(*) AS n FROM {child} c WHERE c.{fk} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})")


def _sql_not_empty(t):
    return f"SELECT 'not_empty[{t}]' AS name, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS n FROM {t}"


def _report_sql(parts):
    body = "\nUNION ALL ".join(parts)
    return f"SELECT name, n = 0 AS ok, CAST(n AS BIGINT) AS n_offenders FROM ({body})"


_PK_NULL_SQL = [_sql_pk_null(t, pk) for t, (pk, _) in SI.KEYS.items()]
_UNIQUE_SQL = [_sql_unique(t, pk) for t, (pk, _) in SI.KEYS.items()]
_ORPHAN_SQL = ([_sql_orphans(f"no_orphans[{t}.{fk}]", t, fk, parent, pk)
                for t, (_, fks) in SI.KEYS.items() for fk, parent, pk in fks]
               + [_sql_orphans(*r) for r in SI.REVERSE])
_NOT_EMPTY_SQL = [_sql_not_empty(t) for t in SI.KEYS]
_EXTRA_SQL = [
    _sql_unique("customer", ("c_name",), "unique[customer.c_name]"),
    "SELECT 'max_length[customer.c_name]' AS name, count(*) FILTER (WHERE length(c_name) > 20) AS n FROM customer",
    "SELECT 'date_order[lineitem]' AS name, count(*) AS n FROM lineitem l JOIN orders o "
    "ON o.o_orderkey = l.l_orderkey WHERE l.l_shipdate < o.o_orderdate",
    "SELECT 'paid_zero_balance[orders]' AS name, count(*) FILTER (WHERE upper(o_orderstatus) = 'F' "
    "AND coalesce(o_totalprice, 0) <> 0) AS n FROM orders",
]


@query("dq_pk_null", _report_sql(_PK_NULL_SQL))
def dq_pk_null(spark, sf_dir):
    """Q2: key columns must not be NULL (fused per table)."""
    return _counts_of(spark, sf_dir, ("pk_not_null",))


@query("dq_pk_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS times FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def dq_pk_unique(spark, sf_dir):
    """Q3/A2: duplicate keys with their multiplicity (a real failing case)."""
    t = SI.reader(spark, sf_dir)
    return Q.unique("lineitem", ("l_orderkey", "l_linenumber")).offenders(t)


@query("dq_unique_report", _report_sql(_UNIQUE_SQL))
def dq_unique_report(spark, sf_dir):
    """Q3 over every table: number of duplicated keys per table."""
    return _counts_of(spark, sf_dir, ("pk_unique",))


@query("dq_orphans", _report_sql(_ORPHAN_SQL))
def dq_orphans(spark, sf_dir):
    """Orphan counts per relation, incl. parents without children."""
    t = SI.reader(spark, sf_dir)
    rules = [r for r in SI.standin_rules()
             if r.name.startswith("no_orphans") or r.name in {x[0] for x in SI.REVERSE}]
    return Q.rule_counts(t, rules)


@query("dq_orphan_rows", """
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def dq_orphan_rows(spark, sf_dir):
    """Q4 offender rows (left anti join): claims without any item."""
    t = SI.reader(spark, sf_dir)
    return Q.no_orphans("orders", ("o_orderkey",), "lineitem", ("l_orderkey",),
                        child_columns=("o_orderkey", "o_custkey", "o_orderdate")).offenders(t)


@query("dq_date_order", """
SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_orderdate FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE l.l_shipdate < o.o_orderdate""")
def dq_date_order(spark, sf_dir):
    """Q5/P5: column-vs-column order (NULL on either side is not an offence)."""
    return SI.date_order_offenders(SI.reader(spark, sf_dir))


@query("dq_paid_balance", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE upper(o_orderstatus) = 'F' AND coalesce(o_totalprice, 0) <> 0""")
def dq_paid_balance(spark, sf_dir):
    """Settled rows must carry a zero balance."""
    t = SI.reader(spark, sf_dir)
    rule = next(r for r in SI.standin_rules() if r.name == "paid_zero_balance[orders]")
    return rule.offenders(t)


@query("dq_not_empty", _report_sql(_NOT_EMPTY_SQL))
def dq_not_empty(spark, sf_dir):
    """Q7: every table has at least one row (count fused with the table's row rules)."""
    return _counts_of(spark, sf_dir, ("not_empty",))


@query("dq_report", _report_sql(_PK_NULL_SQL + _UNIQUE_SQL + _ORPHAN_SQL + _NOT_EMPTY_SQL + _EXTRA_SQL))
def dq_report(spark, sf_dir):
    """Q8: the whole rule set, one row per rule (name, ok, n_offenders)."""
    return Q.rule_counts(SI.reader(spark, sf_dir), SI.standin_rules())


@query("dq_summary", f"""
SELECT count(*) FILTER (WHERE ok) AS passed, count(*) FILTER (WHERE NOT ok) AS failed,
       count(*) AS total
FROM ({_report_sql(_PK_NULL_SQL + _UNIQUE_SQL + _ORPHAN_SQL + _NOT_EMPTY_SQL + _EXTRA_SQL)})""")
def dq_summary(spark, sf_dir):
    """Passed / failed / total of the rule report."""
    return Q.summary(Q.rule_counts(SI.reader(spark, sf_dir), SI.standin_rules()))


# ----------------------------------------------------------------------------------------------
# Late fee and payments
# ----------------------------------------------------------------------------------------------
from tessera.functions.scalars import late_fee_rate, register_sql_functions  # noqa: E402
from tessera.operators.payments import apply_payments  # noqa: E402

_RATE_SQL = """CASE WHEN {d} IS NULL OR {b} IS NULL THEN NULL
            WHEN {d} <= 0 THEN CAST(0.000 AS DECIMAL(4,3)) WHEN {d} <= 15 THEN CAST(0.020 AS DECIMAL(4,3))
            WHEN {d} <= 30 THEN CAST(0.050 AS DECIMAL(4,3)) ELSE CAST(0.100 AS DECIMAL(4,3)) END"""

_LATE_FEE_SQL = f"""
WITH x AS (
  SELECT l.l_orderkey, l.l_linenumber, CAST(date_diff('day', o.o_orderdate, l.l_shipdate) AS INTEGER) AS days_late,
         CAST(o.o_totalprice AS DECIMAL(10,2)) AS balance
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT l_orderkey, l_linenumber, days_late, balance, {_RATE_SQL.format(d='days_late', b='balance')} AS rate,
       CAST(round(balance * ({_RATE_SQL.format(d='days_late', b='balance')}), 2) AS DECIMAL(12,2)) AS surcharge
FROM x"""


def _late_fee_input(spark, sf_dir):
    t = SI.reader(spark, sf_dir)
    o = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_totalprice")
    return (t("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(o, "l_orderkey")
            .select("l_orderkey", "l_linenumber",
                    F.datediff("l_shipdate", "o_orderdate").alias("days_late"),
                    F.col("o_totalprice").cast("decimal(10,2)").alias("balance")))


@query("late_fee", _LATE_FEE_SQL)
def late_fee(spark, sf_dir):
    """U1 as a column expression: rate by days late (NULL-in -> NULL; negative balance raises)."""
    x = _late_fee_input(spark, sf_dir)
    rate = late_fee_rate("days_late", "balance")
    return x.select("l_orderkey", "l_linenumber", "days_late", "balance", rate.alias("rate"),
                    F.round(F.col("balance") * rate, 2).cast("decimal(12,2)").alias("surcharge"))


@query("late_fee_sql_function", _LATE_FEE_SQL)
def late_fee_sql_function(spark, sf_dir):
    """U1 as a SQL function (inlined SQL body, no Python)."""
    register_sql_functions(spark)
    _late_fee_input(spark, sf_dir).createOrReplaceTempView("late_fee_input")
    return spark.sql("""
        SELECT l_orderkey, l_linenumber, days_late, balance,
               fn_calculate_late_fee(days_late, balance) AS rate,
               CAST(round(balance * fn_calculate_late_fee(days_late, balance), 2) AS DECIMAL(12,2)) AS surcharge
        FROM late_fee_input""")


_PAY_SQL_BASE = f"""
WITH RECURSIVE
b AS (SELECT o_orderkey AS id, o_custkey AS policy_id, CAST(o_orderdate AS DATE) + 30 AS due_date,
             CAST(o_totalprice AS DECIMAL(10,2)) AS balance,
             CASE o_orderstatus WHEN 'F' THEN 'Paid' WHEN 'O' THEN 'Pending' ELSE 'Overdue' END AS status
      FROM orders),
pay AS (SELECT l_orderkey AS bill_id, l_linenumber AS pay_line, l_partkey AS pay_part,
               l_suppkey AS pay_supplier,
               CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) - 2000, 2) AS DECIMAL(10,2)) AS amount,
               CASE WHEN l_returnflag = 'R' THEN 'credit_card' WHEN l_returnflag = 'A' THEN 'bank_transfer'
                    WHEN l_linestatus = 'O' THEN 'international_wire_transfer' ELSE 'cash' END AS payment_method,
               'supplier-' || CAST(l_suppkey AS VARCHAR) AS edited_by
        FROM lineitem),
chk AS (SELECT pay.*, b.policy_id, b.balance AS start_balance, b.id IS NOT NULL AS found,
               greatest(DATE '{SI.PAYMENTS_AS_OF}' - b.due_date, 0) AS days_late,
               CASE WHEN pay.pay_line IS NULL OR pay.pay_part IS NULL OR pay.pay_supplier IS NULL
                         OR pay.amount IS NULL OR pay.payment_method IS NULL THEN 'payment order key is NULL'
                    WHEN b.id IS NULL THEN 'bill ' || CAST(pay.bill_id AS VARCHAR) || ' does not exist'
                    WHEN pay.amount IS NULL OR pay.amount <= 0 THEN 'amount must be greater than zero'
                    WHEN b.balance IS NULL THEN 'bill balance is NULL'
                    WHEN b.balance < 0 THEN 'bill balance cannot be negative (got ' || CAST(b.balance AS VARCHAR) || ')'
                    WHEN length(pay.payment_method) > 20 THEN 'payment_method longer than 20 characters'
               END AS reject_reason
        FROM pay LEFT JOIN b ON b.id = pay.bill_id),
v AS (SELECT *, {_RATE_SQL.format(d='days_late', b='start_balance')} AS rate,
             row_number() OVER (PARTITION BY bill_id ORDER BY pay_line, pay_part, pay_supplier, amount, payment_method) AS seq
      FROM chk WHERE reject_reason IS NULL),
r AS (SELECT bill_id, CAST(0 AS BIGINT) AS seq, CAST(max(start_balance) AS DECIMAL(12,2)) AS bal,
             CAST(NULL AS DECIMAL(12,2)) AS surcharge
      FROM v GROUP BY bill_id
      UNION ALL
      SELECT r.bill_id, v.seq,
             CAST(greatest(r.bal + CAST(round(r.bal * v.rate, 2) AS DECIMAL(12,2)) - v.amount, 0) AS DECIMAL(12,2)),
             CAST(round(r.bal * v.rate, 2) AS DECIMAL(12,2))
      FROM r JOIN v ON v.bill_id = r.bill_id AND v.seq = r.seq + 1),
applied AS (SELECT v.*, r.bal AS new_balance, r.surcharge FROM v JOIN r ON r.bill_id = v.bill_id AND r.seq = v.seq)
"""


_BILLS_SELECT = """
, last AS (SELECT bill_id, arg_max(new_balance, seq) AS nb, arg_max(payment_method, seq) AS pm
           FROM applied GROUP BY bill_id)
SELECT b.id, b.policy_id, b.due_date,
       CASE WHEN last.bill_id IS NULL THEN b.balance ELSE CAST(last.nb AS DECIMAL(10,2)) END AS balance,
       CASE WHEN last.bill_id IS NOT NULL AND last.nb = 0 THEN 'Paid' ELSE b.status END AS status,
       last.pm AS payment_method
FROM b LEFT JOIN last ON last.bill_id = b.id"""

_LOG_SELECT = f"""
SELECT (SELECT max(o_orderkey) + 1 FROM orders) + row_number() OVER (ORDER BY bill_id, seq) AS id,
       policy_id, 'Bill' AS edited_table_name, TIMESTAMP '{SI.PAYMENTS_EDITED_AT}' AS edited_date,
       'Pago de ' || CAST(amount AS VARCHAR) || ' registrado vía ' || payment_method ||
       '. Recargo por mora: ' || CAST(surcharge AS VARCHAR) || ' (' || CAST(days_late AS VARCHAR) ||
       ' dias). Nuevo saldo: ' || CAST(new_balance AS VARCHAR) AS additional_info,
       edited_by
FROM applied"""


@query("apply_payments_bills", _PAY_SQL_BASE + _BILLS_SELECT)
def apply_payments_bills(spark, sf_dir):
    """U2 set-based: bills after applying a batch of ordered payments."""
    return _apply(spark, sf_dir)["bills"].select("id", "policy_id", "due_date", "balance", "status",
                                                 "payment_method")


@query("apply_payments_log", _PAY_SQL_BASE + _LOG_SELECT)
def apply_payments_log(spark, sf_dir):
    """U2 set-based: one edit-log row per applied payment, ids continuing the existing log."""
    return _apply(spark, sf_dir)["log"]


@query("payment_rejects", _PAY_SQL_BASE + """
SELECT bill_id, pay_line, pay_part, pay_supplier, amount, payment_method, edited_by, reject_reason
FROM chk WHERE reject_reason IS NOT NULL""")
def payment_rejects(spark, sf_dir):
    """Payments refused (unknown bill, amount <= 0, bad balance, method too long)."""
    return _apply(spark, sf_dir)["rejects"]


_RUNS: dict[tuple, object] = {}


def _apply(spark, sf_dir):
    """One payment run per application and input folder: bills, log and rejects are the
    three outputs of the same job (its applied payments are staged in the work folder)."""
    key = SI.input_version(spark, sf_dir)
    if key not in _RUNS:
        t = SI.reader(spark, sf_dir)
        _RUNS[key] = apply_payments(spark, SI.bills(t), SI.payments(t), SI.edit_log(t),
                                    as_of=SI.PAYMENTS_AS_OF, edited_at=SI.PAYMENTS_EDITED_AT,
                                    order_cols=SI.PAYMENT_ORDER)
    return _RUNS[key]


# A hot key from the driver's data: every credit-card payment (l_returnflag = 'R', a third of
# all payment rows) is made against one bill, the overdue bill with the smallest balance. Its
# first valid payment settles it, so nearly all of its payments take the parallel settled path
# of the hot overdue split. The oracle stops its recursion once a balance is zero (a zero
# balance stays zero: no surcharge on 0, every valid amount positive) and fills zeros after.
_HOT_PAY_SQL_BASE = (
    _PAY_SQL_BASE
    .replace("pay AS (SELECT l_orderkey AS bill_id,", f"""hot AS (SELECT min(id) AS id FROM b
        WHERE due_date < DATE '{SI.PAYMENTS_AS_OF}' - 30
          AND balance = (SELECT min(balance) FROM b WHERE due_date < DATE '{SI.PAYMENTS_AS_OF}' - 30)),
pay AS (SELECT CASE WHEN l_returnflag = 'R' THEN (SELECT id FROM hot) ELSE l_orderkey END AS bill_id,""")
    .replace("FROM r JOIN v ON v.bill_id = r.bill_id AND v.seq = r.seq + 1),",
             "FROM r JOIN v ON v.bill_id = r.bill_id AND v.seq = r.seq + 1 WHERE r.bal > 0),")
    .replace("applied AS (SELECT v.*, r.bal AS new_balance, r.surcharge FROM v JOIN r ON r.bill_id = v.bill_id AND r.seq = v.seq)",
             "applied AS (SELECT v.*, coalesce(r.bal, CAST(0 AS DECIMAL(12,2))) AS new_balance, "
             "coalesce(r.surcharge, CAST(0 AS DECIMAL(12,2))) AS surcharge "
             "FROM v LEFT JOIN r ON r.bill_id = v.bill_id AND r.seq = v.seq)"))
assert _HOT_PAY_SQL_BASE.count("WHERE r.bal > 0") == 1 and "hot AS" in _HOT_PAY_SQL_BASE \
    and "LEFT JOIN r" in _HOT_PAY_SQL_BASE


def hot_bill_payments(t) -> DataFrame:
    """Stand-in payments with every credit-card payment moved to the overdue bill with the
    smallest balance (ties: smallest id); the bill is found with one aggregate (one value)."""
    b = SI.bills(t)
    late = b.where(F.col("due_date") < F.date_sub(F.lit(SI.PAYMENTS_AS_OF).cast("date"), 30))
    hot = late.agg(F.min_by("id", F.struct("balance", "id")).alias("id")).first()["id"]
    return SI.payments(t).withColumn(
        "bill_id", F.when(F.col("payment_method") == "credit_card", F.lit(hot))
        .otherwise(F.col("bill_id")))


def _apply_hot(spark, sf_dir):
    key = (*SI.input_version(spark, sf_dir), "hot")
    if key not in _RUNS:
        t = SI.reader(spark, sf_dir)
        _RUNS[key] = apply_payments(spark, SI.bills(t), hot_bill_payments(t), SI.edit_log(t),
                                    as_of=SI.PAYMENTS_AS_OF, edited_at=SI.PAYMENTS_EDITED_AT,
                                    order_cols=SI.PAYMENT_ORDER)
    return _RUNS[key]


@query("hot_bill_payments_log", _HOT_PAY_SQL_BASE + _LOG_SELECT)
def hot_bill_payments_log(spark, sf_dir):
    """U2 with one bill holding a third of all payments: every payment's surcharge and new
    balance in the log, ids in (bill, payment order)."""
    return _apply_hot(spark, sf_dir)["log"]


@query("hot_bill_bills", _HOT_PAY_SQL_BASE + _BILLS_SELECT)
def hot_bill_bills(spark, sf_dir):
    """U2 with one bill holding a third of all payments: the bills afterwards."""
    return _apply_hot(spark, sf_dir)["bills"].select("id", "policy_id", "due_date", "balance",
                                                     "status", "payment_method")


@query("bills_of_policy", """
SELECT o_orderkey AS id, o_custkey AS policy_id, CAST(o_orderdate AS DATE) + 30 AS due_date,
       CAST(o_totalprice AS DECIMAL(10,2)) AS balance
FROM orders WHERE o_custkey = 7""")
def bills_of_policy(spark, sf_dir, policy_id: int = 7):
    """P10: the access path 'bills of one policy ordered by due date' (a point lookup is the
    feature; min/max statistics let the scan skip row groups)."""
    b = SI.bills(SI.reader(spark, sf_dir))
    return (b.where(F.col("policy_id") == policy_id)
            .select("id", "policy_id", "due_date", "balance").orderBy("due_date", "id"))


@query("time_to_pay", """
WITH paid AS (SELECT l_orderkey, max(l_shipdate) AS paid_at FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey AS id, CAST(o.o_orderdate AS DATE) + 30 AS due_date,
       CAST(p.paid_at AS DATE) AS paid_date,
       CAST(CAST(p.paid_at AS DATE) - (CAST(o.o_orderdate AS DATE) + 30) AS INTEGER) AS days_to_pay
FROM orders o LEFT JOIN paid p ON p.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus = 'F'""")
def time_to_pay(spark, sf_dir):
    """Days between due date and paid date for settled bills; unknown stays NULL."""
    t = SI.reader(spark, sf_dir)
    paid = t("lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("paid_at"))
    b = SI.bills(t).where(F.col("status") == "Paid")
    j = b.join(paid, b.id == paid.l_orderkey, "left")
    return j.select("id", "due_date", F.col("paid_at").cast("date").alias("paid_date"),
                    F.datediff(F.col("paid_at").cast("date"), F.col("due_date")).alias("days_to_pay"))


# ----------------------------------------------------------------------------------------------
# Loads: CSV contract round trip, seed files, versioned reload, rejects, drift, audit (S*, D*, B*)
# ----------------------------------------------------------------------------------------------
import re  # noqa: E402
import uuid  # noqa: E402

from tessera.operators.backfill import missing_dimension_rows  # noqa: E402
from tessera.operators.drift import compare_columns, drift_frame  # noqa: E402
from tessera.plans import audit as A  # noqa: E402
from tessera.plans.load import load_all, load_table  # noqa: E402
from tessera.plans.publish import ensure_database, publish  # noqa: E402
from tessera.session import work_path  # noqa: E402
from tessera.sources.contracts import contract_from_schema  # noqa: E402
from tessera.sources.readers import CsvContract, list_files, read_seed  # noqa: E402
from tessera.sources.sinks import extract_tables, write_csv  # noqa: E402

RELATIONAL_STANDINS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _contract(t, name):
    pk, fks = SI.KEYS[name]
    from tessera.sources.contracts import ForeignKey
    return contract_from_schema(name, t(name).schema, pk,
                                tuple(ForeignKey(f, p, k) for f, p, k in fks))


def _schema_name(prefix="raw"):
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


def _extract(spark, t, name, root, reverse=False, transform=None):
    df = t(name)
    if transform is not None:
        df = transform(df)
    cols = list(reversed(df.columns)) if reverse else df.columns
    path = f"{root}/extract/{name}"
    write_csv(df, path, column_order=cols)
    return path


@query("csv_roundtrip_by_name", "SELECT * FROM orders")
def csv_roundtrip_by_name(spark, sf_dir):
    """S7+S9+S11+S10: extract with the CSV contract in reversed column order, load back by
    column name with strict casts into a versioned RAW table."""
    t = SI.reader(spark, sf_dir)
    root = work_path(spark, "csv-roundtrip")
    path = _extract(spark, t, "orders", root, reverse=True)
    c = _contract(t, "orders")
    res = load_table(spark, c, path, root, schema=_schema_name())
    if not res.ok:
        raise RuntimeError(res.error)
    return spark.table(res.table).select(*c.column_names)


@query("seed_typed_load", "SELECT * FROM customer")
def seed_typed_load(spark, sf_dir):
    """S1+S2: all-string JSON seed objects converted by the contract's per-column rules."""
    t = SI.reader(spark, sf_dir)
    c = _contract(t, "customer")
    path = work_path(spark, "seed") + "/customer"
    t("customer").select(F.to_json(F.struct(*[F.col(x).cast("string").alias(x)
                                              for x in c.column_names])).alias("value")
                         ).write.text(path)
    return read_seed(spark, path, c, multi_line=False)


@query("reload_idempotent", "SELECT * FROM orders")
def reload_idempotent(spark, sf_dir):
    """Publishing the same source twice leaves exactly one copy of each row."""
    t = SI.reader(spark, sf_dir)
    root = work_path(spark, "reload")
    name = f"{_schema_name()}.orders"
    from tessera.plans.publish import ensure_database
    ensure_database(spark, name.split(".")[0], root)
    publish(spark, t("orders"), name, root)
    publish(spark, t("orders"), name, root)
    return spark.table(name)


def _corrupt_low_priority(df):
    """Planted defect derived from the data: low-priority rows carry a currency prefix."""
    return df.withColumn("o_totalprice", F.when(
        F.col("o_orderpriority") == "5-LOW",
        F.concat(F.lit("USD "), F.col("o_totalprice").cast("string")))
        .otherwise(F.col("o_totalprice").cast("string")))


@query("partial_load_rejects", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, 'o_totalprice' AS "column",
       'cannot convert ''USD ' || CAST(o_totalprice AS VARCHAR) || ''' to double' AS reason
FROM orders WHERE o_orderpriority = '5-LOW'""")
def partial_load_rejects(spark, sf_dir):
    """on_error=continue loads the good rows and sets aside the ones that do not convert."""
    t = SI.reader(spark, sf_dir)
    root = work_path(spark, "partial")
    path = _extract(spark, t, "orders", root, transform=_corrupt_low_priority)
    schema = _schema_name()
    res = load_table(spark, _contract(t, "orders"), path, root, schema=schema,
                     on_error="continue")
    if not res.ok:
        raise RuntimeError(res.error)
    rej = spark.read.parquet(f"{root}/{schema}/orders__rejects/*")
    return rej.select(F.get_json_object("raw", "$.o_orderkey").alias("o_orderkey"),
                      F.col("column"), F.col("reason"))


_DECLARED_EVENTS = ("event_id", "ts", "user_id", "event_type", "value", "session_id")


@query("drift_report", f"""
SELECT 'events' AS table_name, upper(column_name) AS column_name, 'new' AS kind,
       'ALTER TABLE raw.events ADD COLUMNS (`' || upper(column_name) || '` STRING);' AS suggested_ddl
FROM (DESCRIBE events) WHERE column_name NOT IN {tuple(_DECLARED_EVENTS)}
UNION ALL SELECT 'events', 'SESSION_ID', 'missing', NULL""")
def drift_report(spark, sf_dir):
    """D1+D2+D4+D6: extract header vs declared target columns (case-insensitive): new columns
    with the suggested DDL, missing ones flagged; the load itself is refused and audited."""
    t = SI.reader(spark, sf_dir)
    root = work_path(spark, "drift")
    path = _extract(spark, t, "events", root)
    from tessera.sources.readers import csv_header
    report = compare_columns("events", csv_header(spark, path), list(_DECLARED_EVENTS))
    return drift_frame(spark, [report])


@query("dq_counts_source_target", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS source_rows, count(*) AS target_rows, true AS ok FROM {n}"
    for n in RELATIONAL_STANDINS))
def dq_counts_source_target(spark, sf_dir):
    """Q1+S4+S8+S24: extract all seven relational tables, load them all, compare row counts
    of source and target per table (one pass over both sides per table)."""
    t = SI.reader(spark, sf_dir)
    root = work_path(spark, "counts")
    schema = _schema_name()
    sources = extract_tables({n: t(n) for n in RELATIONAL_STANDINS}, f"{root}/extract")
    res = load_all(spark, {n: _contract(t, n) for n in RELATIONAL_STANDINS}, sources, root,
                   schema=schema)
    if res.where(~F.col("ok")).limit(1).collect():
        raise RuntimeError("load failed")
    parts = [Q.source_target_counts(t(n), spark.table(f"{schema}.{n}"))
             .select(F.lit(n).alias("table_name"), "*") for n in RELATIONAL_STANDINS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("ok", F.col("source_rows") == F.col("target_rows"))


@query("load_audit_per_file", """
SELECT 'LINEITEM' AS table_name, 'LOADED' AS status, count(*) AS rows_loaded FROM lineitem""")
def load_audit_per_file(spark, sf_dir):
    """B1+B2+A7: one audit row per loaded file with its row count; summed per table and status."""
    t = SI.reader(spark, sf_dir)
    root = work_path(spark, "audit")
    path = _extract(spark, t, "lineitem", root)
    res = load_table(spark, _contract(t, "lineitem"), path, root, schema=_schema_name())
    if not res.ok:
        raise RuntimeError(res.error)
    a = A.read_audit(spark, root)
    return a.groupBy("table_name", "status").agg(
        F.sum(F.coalesce(F.col("rows"), F.lit(0))).cast("bigint").alias("rows_loaded"))


@query("latest_loads", " UNION ALL ".join(
    f"SELECT '{n.upper()}' AS table_name, 'LOADED' AS status, count(*) AS rows_loaded FROM {n}"
    for n in RELATIONAL_STANDINS))
def latest_loads(spark, sf_dir):
    """The audit rows of a load of all seven tables, summed per table and status (their order:
    ``latest_load_order``)."""
    t = SI.reader(spark, sf_dir)
    root = work_path(spark, "latest")
    schema = _schema_name()
    sources = extract_tables({n: t(n) for n in RELATIONAL_STANDINS}, f"{root}/extract")
    load_all(spark, {n: _contract(t, n) for n in RELATIONAL_STANDINS}, sources, root, schema=schema)
    return A.read_audit(spark, root).groupBy("table_name", "status").agg(F.sum(F.coalesce("rows", F.lit(0))).cast("bigint").alias("rows_loaded"))


@query("load_statuses", """
SELECT 'nation' AS table_name, true AS ok, 'LOADED' AS status, count(*) AS loaded FROM nation
UNION ALL SELECT 'region', false, 'LOAD_FAILED', 0 UNION ALL SELECT 'supplier', false, 'LOAD_FAILED', 0
UNION ALL SELECT 'customer', false, 'LOAD_FAILED', 0""")
def load_statuses(spark, sf_dir):
    """One good, one missing, one drifting and one corrupt source in one load; every
    failure is a result and an audit row, and the good table is loaded."""
    t = SI.reader(spark, sf_dir)
    root = work_path(spark, "statuses")
    names = ("nation", "region", "supplier", "customer")
    sources = {"nation": _extract(spark, t, "nation", root), "region": f"{root}/extract/not-there",
               "supplier": f"{root}/drifting", "customer": f"{root}/corrupt"}
    write_csv(t("supplier").withColumn("_risk", F.lit("x")), sources["supplier"])
    # Not a gzip file, although its name says so.
    spark.range(1).select(F.lit("not compressed").alias("value")).coalesce(1).write.text(f"{root}/plain")
    _rename_parts(spark, f"{root}/plain", sources["customer"], ".csv.gz")
    res = load_all(spark, {n: _contract(t, n) for n in names}, sources, root, schema=_schema_name())
    return res.select(F.substring_index("table_name", ".", -1).alias("table_name"), "ok", "status",
                      F.col("rows").alias("loaded"))


def _rename_parts(spark, source: str, target: str, suffix: str) -> None:
    """Move the part files of a folder to a new one under another suffix (file metadata only)."""
    jvm = spark._jvm
    src, dst = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = src.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(dst)
    for i, st in enumerate(fs.listStatus(src)):
        if st.getPath().getName().startswith("part-"):
            fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(dst, f"part-{i}{suffix}"))


@query("drift_repair_load", """
SELECT 'loaded' AS step, s_suppkey, s_acctbal, upper(s_name) AS late_fee FROM supplier
UNION ALL SELECT 'loaded again', s_suppkey, s_acctbal, upper(s_name) FROM supplier""")
def drift_repair_load(spark, sf_dir):
    """An extract with a new column (its name starts with ``_``) is refused; after
    the suggested DDL the same extract loads with that column, and so does the next one."""
    t = SI.reader(spark, sf_dir)
    root, schema = work_path(spark, "repair"), _schema_name()
    c = _contract(t, "supplier")
    if not load_table(spark, c, _extract(spark, t, "supplier", root), root, schema=schema).ok:
        raise RuntimeError("the first load failed")
    wide = f"{root}/wide"
    write_csv(t("supplier").withColumn("_late_fee", F.upper("s_name")), wide)
    refused = load_table(spark, c, wide, root, schema=schema)
    ddl = re.findall(r"ALTER TABLE [^;]+;", refused.error or "")
    if refused.ok or len(ddl) != 1:
        raise RuntimeError(f"drift was not refused with one repair: {refused}")
    spark.sql(ddl[0].rstrip(";"))
    out = []
    for step in ("loaded", "loaded again"):
        res = load_table(spark, c, wide, root, schema=schema)
        if not res.ok:
            raise RuntimeError(res.error)
        out.append(spark.read.parquet(res.version).select(F.lit(step).alias("step"), "s_suppkey", "s_acctbal",
                                                          F.col("_LATE_FEE").alias("late_fee")))
    return out[0].unionByName(out[1])


@query("csv_text_fidelity", """
SELECT doc_id, '  ' || text || ' ' AS text, lang = 'en' AS english FROM documents""")
def csv_text_fidelity(spark, sf_dir):
    """S7/S9/F-7: texts with line feeds, quotes and outer spaces, and booleans, through the CSV
    extract and back (the contract asks for multi-line records)."""
    docs = SI.reader(spark, sf_dir)("documents")
    path = f"{work_path(spark, 'fidelity')}/documents"
    write_csv(docs.select("doc_id", F.concat(F.lit("  "), "text", F.lit(" ")).alias("text"),
                          (F.col("lang") == "en").alias("english")), path)
    back = CsvContract(multi_line=True).reader(spark).load(path)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", (F.col("english") == "TRUE").alias("english"))


@query("backfill_dimension", """
SELECT d.doc_id, 'VIN-PENDIENTE-' || CAST(d.doc_id AS VARCHAR) AS vin
FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def backfill_dimension(spark, sf_dir):
    """Distinct orphan keys of a fact get a placeholder dimension row (re-runnable)."""
    t = SI.reader(spark, sf_dir)
    return missing_dimension_rows(t("documents"), "doc_id", t("labels"), "doc_id",
                                  placeholder_column="vin")


@query("stage_listing")
def stage_listing(spark, sf_dir):
    """Staged files with size and modification time (rows-only: sizes are not SQL)."""
    path = SI.land_claim_documents(spark, sf_dir)
    return list_files(spark, path, "part-*").select("name", "size", "last_modified")


@query("variant_schema_report")
def variant_schema_report(spark, sf_dir):
    """Observed union schema of schema-on-read documents (rows-only)."""
    from tessera.operators.drift import variant_schema_report as report
    e = SI.reader(spark, sf_dir)("events")
    return report(e.select(F.parse_json("props").alias("raw")))


# ----------------------------------------------------------------------------------------------
# Masking (G1-G3, U3, U4)
# ----------------------------------------------------------------------------------------------
from tessera.functions.scalars import ROLE_ANALYST, ROLE_MANAGER  # noqa: E402
from tessera.operators import masking as M  # noqa: E402

_PERSON_SQL = """
WITH p AS (SELECT c_custkey, c_name AS party_name,
                  '+57-3' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-' || lpad(CAST(c_custkey AS VARCHAR), greatest(7, length(CAST(c_custkey AS VARCHAR)))::INTEGER, '0') AS party_phone,
                  c_mktsegment || ' district ' || CAST(c_nationkey AS VARCHAR) AS party_address
           FROM customer)
SELECT c_custkey, party_name, {phone} AS party_phone, {address} AS party_address FROM p"""


def _masked_persons(spark, sf_dir, role):
    p = SI.persons(SI.reader(spark, sf_dir))
    return M.masked(p, M.STAGING, role)


@query("mask_analyst", _PERSON_SQL.format(phone="party_phone", address="party_address"))
def mask_analyst(spark, sf_dir):
    """G1: the analyst role sees phone and address in full."""
    return _masked_persons(spark, sf_dir, ROLE_ANALYST)


@query("mask_manager", _PERSON_SQL.format(phone="left(party_phone, 7) || '-***-****'",
                                          address="'*** direccion protegida ***'"))
def mask_manager(spark, sf_dir):
    """The manager sees a 7-character phone prefix (NULL stays NULL), no address."""
    return _masked_persons(spark, sf_dir, ROLE_MANAGER)


@query("mask_other", _PERSON_SQL.format(phone="'+**-***-***-****'",
                                        address="'*** direccion protegida ***'"))
def mask_other(spark, sf_dir):
    """G1 closed default: any other role (administrators included) gets constants."""
    return _masked_persons(spark, sf_dir, "ACCOUNTADMIN")


def _one_column_sql(col, expr):
    return _PERSON_SQL.format(phone="party_phone", address="party_address").replace(
        "SELECT c_custkey, party_name, party_phone AS party_phone, party_address AS party_address FROM p",
        f"SELECT c_custkey, {expr} AS {col} FROM p")


@query("mask_phone_analyst", _one_column_sql("party_phone", "party_phone"))
def mask_phone_analyst(spark, sf_dir):
    """U3 for the analyst: the full phone."""
    return _masked_persons(spark, sf_dir, ROLE_ANALYST).select("c_custkey", "party_phone")


@query("mask_phone_manager", _one_column_sql("party_phone", "left(party_phone, 7) || '-***-****'"))
def mask_phone_manager(spark, sf_dir):
    """U3 for the manager: prefix + fixed suffix."""
    return _masked_persons(spark, sf_dir, ROLE_MANAGER).select("c_custkey", "party_phone")


@query("mask_phone_other", _one_column_sql("party_phone", "'+**-***-***-****'"))
def mask_phone_other(spark, sf_dir):
    """U3 closed default for any other role."""
    return _masked_persons(spark, sf_dir, "ACCOUNTADMIN").select("c_custkey", "party_phone")


@query("mask_address", _one_column_sql("party_address", "'*** direccion protegida ***'"))
def mask_address_query(spark, sf_dir):
    """U4: the address is hidden from every role but the analyst (manager shown)."""
    return _masked_persons(spark, sf_dir, ROLE_MANAGER).select("c_custkey", "party_address")


@query("mask_null_phone", """
SELECT c_custkey, role, CASE WHEN role = 'other' THEN '+**-***-***-****'
       WHEN c_custkey % 2 = 0 THEN NULL WHEN role = 'analyst' THEN 'p' || c_custkey
       ELSE left('p' || c_custkey, 7) || '-***-****' END AS party_phone
FROM customer CROSS JOIN (SELECT unnest(['analyst', 'manager', 'other']) AS role)""")
def mask_null_phone(spark, sf_dir):
    """A NULL phone stays NULL for analyst and manager, and is the constant for others."""
    p = SI.reader(spark, sf_dir)("customer").select("c_custkey", F.when(
        F.col("c_custkey") % 2 != 0, F.concat(F.lit("p"), F.col("c_custkey").cast("string"))).alias("party_phone"))
    out = [M.masked(p, M.STAGING, role).withColumn("role", F.lit(name))
           for name, role in (("analyst", ROLE_ANALYST), ("manager", ROLE_MANAGER), ("other", "ACCOUNTADMIN"))]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("access_matrix_rows", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {int(m)}::BIGINT AS manager_rows, {int(a)}::BIGINT AS analyst_rows"
    " WHERE (SELECT count(*) FROM region) > 0"
    for t, m, a in [*[(n, True, False) for n in sorted(M.RELATIONAL)], (M.LANDING, False, False), (M.STAGING, True, True)]))
def access_matrix_rows(spark, sf_dir):
    """Role x table -> rows read of one row of data; a refused read counts as none."""
    one = SI.reader(spark, sf_dir)("region").limit(1)
    names = [*sorted(M.RELATIONAL), M.LANDING, M.STAGING]
    tables = {n: one for n in names}

    def rows(role, name):
        try:
            return M.read_as(role, name, tables).select(F.lit(1).alias("n"))
        except M.AccessDenied:
            return one.limit(0).select(F.lit(1).alias("n"))
    parts = [rows(r, n).select(F.lit(n).alias("table_name"), F.lit(r == ROLE_MANAGER).cast("int").alias("m"),
                               F.lit(r == ROLE_ANALYST).cast("int").alias("a"))
             for n in names for r in (ROLE_MANAGER, ROLE_ANALYST, "ACCOUNTADMIN")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    listed = spark.createDataFrame([(n,) for n in names], "table_name string")
    return listed.join(out, "table_name", "left").groupBy("table_name").agg(
        F.coalesce(F.sum("m"), F.lit(0)).cast("bigint").alias("manager_rows"),
        F.coalesce(F.sum("a"), F.lit(0)).cast("bigint").alias("analyst_rows"))


@query("masked_view_session_role", _PERSON_SQL.format(phone="left(party_phone, 7) || '-***-****'",
                                                      address="'*** direccion protegida ***'"))
def masked_view_session_role(spark, sf_dir):
    """A masked temp view driven by the session variable ``active_role``; only views
    the role may read are registered."""
    p = SI.persons(SI.reader(spark, sf_dir))
    M.declare_role(spark, ROLE_ANALYST)
    src, view = f"persons_src_{uuid.uuid4().hex[:8]}", f"persons_{uuid.uuid4().hex[:8]}"
    p.createOrReplaceTempView(src)
    M.create_masked_view(spark, src, view, M.STAGING, p.columns)
    M.declare_role(spark, ROLE_MANAGER)  # the view re-reads the role at query time
    return spark.table(view)


# ----------------------------------------------------------------------------------------------
# Incremental ingest
# ----------------------------------------------------------------------------------------------
from tessera.streaming.ingest import read_landing, run_ingest  # noqa: E402
from tessera.plans.audit import run_history as _run_history  # noqa: E402
from tessera.plans.manifest import file_system  # noqa: E402


def _two_runs(spark, sf_dir, extra_empty_run=False, incremental=False):
    """Land all claims but those of the last year, run; land the last year, run again."""
    t = SI.reader(spark, sf_dir)
    root = work_path(spark, "ingest")
    o, li = t("orders"), t("lineitem")
    last = o.agg(F.max(F.year("o_orderdate")).alias("y")).first()["y"]

    # The documents of both runs are made in one pass, in a folder for each run that becomes its source
    # when the run begins.
    run = F.when(F.year("o_orderdate") < last, "run1").when(F.year("o_orderdate") == last, "run2")
    claims = o.withColumn("run", run).where(F.col("run").isNotNull())
    SI.write_documents(SI.claim_documents(claims, li, keep=("run",)), f"{root}/made", by="run")

    def documents(name):
        fs, made = file_system(spark, f"{root}/made/run={name}")
        _, source = file_system(spark, f"{root}/src/{name}")
        fs.mkdirs(source.getParent())
        if fs.exists(made) and not fs.rename(made, source):
            raise RuntimeError(f"the documents of {name} could not be put into the source folder")

    documents("run1")
    schema = _schema_name("raw_json")
    from tessera.plans.publish import ensure_database
    ensure_database(spark, schema, root)
    staging = f"{schema}.stg_claims_flattened"

    def rebuild(landing):
        return with_flattened_at(flatten(landing, SI.ORDER_CLAIM_SPEC, outer=True,
                                         keep=("batch_id",)))

    glob = f"{root}/src/*/"
    r1 = run_ingest(spark, glob, root, rebuild=rebuild, staging_table=staging,
                    incremental=incremental)
    documents("run2")
    r2 = run_ingest(spark, glob, root, rebuild=rebuild, staging_table=staging,
                    incremental=incremental)
    if extra_empty_run:
        run_ingest(spark, glob, root, rebuild=rebuild, staging_table=staging,
                   incremental=incremental)
    if not (r1.ok and r2.ok):
        raise RuntimeError(r1.error or r2.error)
    return root, staging


@query("incremental_ingest", """
SELECT o.o_orderkey AS claim_id, l.l_partkey AS item_part, l.l_linenumber AS item_line,
       CAST(CASE WHEN year(o.o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) THEN 1 ELSE 0 END AS BIGINT) AS batch_id
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey""")
def incremental_ingest(spark, sf_dir):
    """S20+W1+W2: two stream runs; each file lands once, in the batch of the run that found it;
    the staging table is rebuilt after each successful root run."""
    _, staging = _two_runs(spark, sf_dir)
    return spark.table(staging).select("claim_id", "item_part", "item_line", "batch_id")


@query("incremental_ingest_by_batch", ORACLES["incremental_ingest"])
def incremental_ingest_by_batch(spark, sf_dir):
    """S20+W1+W2 with incremental staging: the staging table is partitioned by batch_id and
    each run flattens and publishes only its new batches (the second run does not re-read the
    first run's documents). Same rows as the full rebuild."""
    _, staging = _two_runs(spark, sf_dir, incremental=True)
    return spark.table(staging).select("claim_id", "item_part", "item_line", "batch_id")


@query("landing_batches", """
SELECT CAST(CASE WHEN year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) THEN 1 ELSE 0 END AS BIGINT) AS batch_id,
       count(*) AS claims
FROM orders GROUP BY 1""")
def landing_batches(spark, sf_dir):
    """Claims landed per micro-batch (documents of one claim counted once)."""
    root, _ = _two_runs(spark, sf_dir)
    land = read_landing(spark, f"{root}/landing/claims")
    return (land.select("batch_id", F.variant_get("raw", "$.claim_id", "bigint").alias("claim_id"))
            .groupBy("batch_id").agg(F.count_distinct("claim_id").alias("claims")))


@query("run_history")
def run_history(spark, sf_dir):
    """Run history of the last 6 hours, newest first, top 10 (rows-only: times vary)."""
    root, _ = _two_runs(spark, sf_dir, extra_empty_run=True)
    return _run_history(spark, root).select("name", "state", "error_message")


# ----------------------------------------------------------------------------------------------
# Seeds, presence, schema evolution, lookups, second document source (S3-S6, S17, D7, D8, F1,
# F6, F7, J5, P11)
# ----------------------------------------------------------------------------------------------
from tessera.operators.flatten import REPAIR_SPEC, project_document  # noqa: E402
from tessera.plans.migrate import add_columns, change_column_type  # noqa: E402
from tessera.plans.seed import presence_report, rebuild_from_seeds  # noqa: E402
from tessera.sources.readers import preview  # noqa: E402


def _write_seeds(spark, t, names, root):
    paths = {}
    for n in names:
        cols = t(n).columns
        path = f"{root}/seed/{n}"
        t(n).select(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in cols]))
                    .alias("value")).write.text(path)
        paths[n] = path
    return paths


@query("seed_rebuild_counts", " UNION ALL ".join(
    f"SELECT 'raw_seed.{n}' AS table_name, count(*) AS expected_rows, count(*) AS rows FROM {n}"
    for n in RELATIONAL_STANDINS))
def seed_rebuild_counts(spark, sf_dir):
    """S3+S4: rebuild all seven tables from all-string seed files in one unit (parents first,
    every write verified against the expected count before any table is swapped)."""
    t = SI.reader(spark, sf_dir)
    root = work_path(spark, "seed-rebuild")
    seeds = _write_seeds(spark, t, RELATIONAL_STANDINS, root)
    expected = {n: r["n"] for n in RELATIONAL_STANDINS
                for r in [t(n).agg(F.count(F.lit(1)).alias("n")).first()]}
    schema = _schema_name("raw_seed")
    out = rebuild_from_seeds(spark, {n: _contract(t, n) for n in RELATIONAL_STANDINS}, seeds,
                             root, schema=schema, expected=expected, multi_line=False)
    return out.withColumn("table_name", F.regexp_replace("table_name", f"^{schema}", "raw_seed"))


@query("table_presence", " UNION ALL ".join(
    [f"SELECT 'raw_p.{n}' AS table_name, count(*) AS rows FROM {n}" for n in RELATIONAL_STANDINS]
    + ["SELECT 'raw_p.vehicle' AS table_name, CAST(-1 AS BIGINT) AS rows"]))
def table_presence(spark, sf_dir):
    """Presence and row count per expected table without writing; -1 when missing."""
    t = SI.reader(spark, sf_dir)
    root = work_path(spark, "presence")
    schema = _schema_name("raw_p")
    from tessera.plans.publish import ensure_database
    ensure_database(spark, schema, root)
    for n in RELATIONAL_STANDINS:
        t(n).createOrReplaceTempView(f"src_{n}")
        spark.sql(f"CREATE TABLE {schema}.{n} USING parquet LOCATION '{root}/{n}' "
                  f"AS SELECT * FROM src_{n}")
    rep = presence_report(spark, [f"{schema}.{n}" for n in RELATIONAL_STANDINS + ("vehicle",)])
    return rep.withColumn("table_name", F.regexp_replace("table_name", f"^{schema}", "raw_p"))


@query("schema_evolution", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CAST(CASE WHEN o_orderpriority IS NULL THEN NULL ELSE CAST(left(o_orderpriority, 1) AS INTEGER) END AS VARCHAR) AS priority_code,
       CAST(NULL AS VARCHAR) AS payment_method
FROM orders""")
def schema_evolution(spark, sf_dir):
    """D7+D8: add a nullable column (old rows read NULL, nothing rewritten), then change a
    column's type by writing a new version with the cast and swapping it in."""
    t = SI.reader(spark, sf_dir)
    root = work_path(spark, "evolve")
    name = f"{_schema_name()}.orders"
    from tessera.plans.publish import ensure_database
    ensure_database(spark, name.split(".")[0], root)
    publish(spark, t("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority_code")), name, root)
    add_columns(spark, name, {"payment_method": "STRING"})
    change_column_type(spark, name, "priority_code", "string", root)
    return spark.table(name)


@query("claim_headers", """
SELECT o_orderkey AS claim_id, o_custkey AS policy_number, o_orderstatus AS claim_status,
       o_totalprice AS estimated_damage_usd, o_orderdate AS reported_at, o_orderpriority AS incident_type
FROM orders""")
def claim_headers(spark, sf_dir):
    """Document-level typed paths, one row per claim."""
    heads = project_document(SI.claim_landing_table(spark, sf_dir), SI.ORDER_CLAIM_SPEC)
    cols = [f.name for f in SI.ORDER_CLAIM_SPEC.doc_fields if f.name != "claim_id"]
    return one_row_per_key(heads, "claim_id", cols)


@query("claims_with_vehicle", """
SELECT o.o_orderkey AS claim_id, l.l_partkey AS item_part, p.p_brand AS vehicle_brand
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey""")
def claims_with_vehicle(spark, sf_dir):
    """Flattened claims joined to the vehicle dimension on its business key."""
    t = SI.reader(spark, sf_dir)
    staged = _staged_claims(spark, sf_dir, outer=False)
    vehicles = t("part").select(F.col("p_partkey").alias("item_part"),
                                F.col("p_brand").alias("vehicle_brand"))
    return staged.join(vehicles, "item_part").select("claim_id", "item_part", "vehicle_brand")


@query("policy_lookup", """
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_name = 'Customer#000000007'""")
def policy_lookup(spark, sf_dir, policy_number: str = "Customer#000000007"):
    """Point lookup by business key (pushed to the scan; min/max statistics prune)."""
    c = SI.reader(spark, sf_dir)("customer")
    return c.where(F.col("c_name") == policy_number).select("c_custkey", "c_name", "c_mktsegment")


def _repair_landing(spark, sf_dir):
    t = SI.reader(spark, sf_dir)
    path = work_path(spark, "repair")
    SI.write_documents(SI.repair_documents(t("orders"), t("lineitem")), path)
    return read_json_documents(spark, path, outer_array=False)


@query("repair_flatten", """
SELECT CAST(o.o_orderkey AS VARCHAR) AS claim_id, CAST(o.o_custkey AS VARCHAR) AS policy_number,
       o.o_orderdate AS reported_at, o.o_orderpriority AS claim_type, o.o_orderstatus AS status,
       'adjuster' || CAST(o.o_custkey AS VARCHAR) || '@example.com' AS adjuster_email,
       CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'AG-' || CAST(o.o_custkey AS VARCHAR) END AS adjuster_agency,
       CAST(coalesce(s.total, 0) AS DECIMAL(12,2)) AS estimated_total_cost,
       CAST(l.l_partkey AS VARCHAR) AS part, l.l_returnflag AS damage_severity,
       l.l_quantity AS labor_hours, CAST(l.l_extendedprice AS DECIMAL(12,2)) AS estimated_cost
FROM orders o
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS total FROM lineitem GROUP BY 1) s
  ON s.l_orderkey = o.o_orderkey""")
def repair_flatten(spark, sf_dir):
    """second nested source; optional nested key gives NULL, 'Z' timestamps as NTZ."""
    return flatten(_repair_landing(spark, sf_dir), REPAIR_SPEC, outer=True).drop(
        "_source_file", "_source_path", "_loaded_at")


@query("repair_total_rule", """
WITH s AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS t FROM lineitem GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS claim_id, CAST(coalesce(t, 0) + 1 AS DECIMAL(18,2)) AS total,
       CAST(coalesce(t, 0) AS DECIMAL(38,2)) AS line_sum
FROM orders LEFT JOIN s ON l_orderkey = o_orderkey WHERE o_orderkey % 13 = 0""")
def repair_total_rule(spark, sf_dir):
    """repair claims whose declared total is not the sum of their line costs; every 13th claim
    declares one unit too much."""
    landing = _repair_landing(spark, sf_dir)
    heads = one_row_per_key(project_document(landing, REPAIR_SPEC), "claim_id",
                            ["estimated_total_cost"])
    heads = heads.withColumn("estimated_total_cost", F.col("estimated_total_cost") + F.when(
        F.col("claim_id").cast("bigint") % 13 == 0, 1).otherwise(0))
    lines = flatten(landing, REPAIR_SPEC, outer=False)
    out = line_total_offenders(heads, lines, "claim_id", "estimated_total_cost", "estimated_cost")
    return out.select("claim_id", "total", F.col("line_sum").cast("decimal(38,2)").alias("line_sum"))


@query("landing_preview")
def landing_preview(spark, sf_dir):
    """Look at landed files in place before loading (any 3 rows; rows-only)."""
    landing = read_json_documents(spark, SI.land_claim_documents(spark, sf_dir), outer_array=False)
    return preview(landing.select(F.col("raw").cast("string").alias("doc")), 3)


from tessera.plans import catalog_more, catalog_state  # noqa: E402, F401 - they register further queries
