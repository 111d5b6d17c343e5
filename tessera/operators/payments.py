"""Set-based payment registration (a batch of payments applied to bills in one job).

Per payment, in order within its bill: days late = max(as_of - due_date, 0); rate = late-fee
rate(days, balance); surcharge = round(balance * rate, 2); new balance = max(balance + surcharge
- amount, 0); status becomes 'Paid' when the new balance is 0; the payment method is set; one
edit-log row with the next id and a formatted text is appended.

Plan:
1. payments LEFT JOIN bills on the bill id (one shuffle; AQE splits a skewed bill). Unknown
   bill, amount <= 0, NULL or negative balance, or a method longer than 20 characters -> rejects.
   So does, in the fold, a payment after which the balance would not fit its column (the bill keeps
   the balance it had, as where each payment is a call of its own that fails).
2. Payments of one bill depend on each other (the surcharge applies to the running balance), so
   they are folded in order. Bills with at most ``max_fold`` payments: ``aggregate()`` over the
   bill's sorted payment array (JVM higher-order function, bounded array). Bills with more
   ("hot" bills) that are not overdue (rate 0): the balance is max(start - running sum, 0), an
   exact distributed prefix sum over range partitions. Hot overdue bills: what follows a
   certified zero is settled in parallel, and the payments up to there (all of them, if the bill
   never gets to zero) are folded piece by piece at the same time (``balance_pieces``).
3. Per-bill result = last payment by order (``max_by``, partial aggregation). Bills are rebuilt
   by a join (Parquet has no MERGE) and the log rows are appended.
4. Log ids: max(existing id) + global ordinal over (bill, payment order). The rows are
   range-partitioned by that order, ranks inside a partition come from the row position, and
   partition offsets come from per-partition counts (one row per partition), so no single task
   numbers everything. The staged rows are written once so both passes see the same partitions.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalars import late_fee_rate
from tessera.operators.balance_pieces import LARGEST, fold_in_pieces, money
from tessera.session import work_path

# ---------------------------------------------------------------------------------------------
# Log text template (Spanish, verbatim), table name written to the log, status.
LOG_TEMPLATE = "Pago de %s registrado vía %s. Recargo por mora: %s (%s dias). Nuevo saldo: %s"
LOG_TABLE_NAME = "Bill"
PAID_STATUS = "Paid"
METHOD_MAX_LENGTH = 20
# ---------------------------------------------------------------------------------------------

BAL = "decimal(12,2)"
DEFAULT_MAX_FOLD = 1000
REFUSED = "_refused"


def largest_balance(kind: T.DataType) -> int:
    """The largest balance in cents that a column of this type takes, and the fold can hold."""
    return min(10 ** (kind.precision - kind.scale + 2) - 1, LARGEST) if isinstance(kind, T.DecimalType) else LARGEST


def _dec(c: Column) -> Column:
    return c.cast(BAL)


def validate(payments: DataFrame, bills: DataFrame, *, bill_key: str = "bill_id",
             as_of: Column, order_cols: tuple[str, ...] = ()) -> DataFrame:
    """Payments joined to their bill with a reject reason (NULL = valid) and bill context.
    The payment order must be a total order, so a NULL in an ordering column is rejected."""
    b = bills.select(F.col("id").alias(bill_key), F.col("policy_id"), F.col("due_date"),
                     F.col("balance").alias("_start_balance"), F.lit(True).alias("_found"))
    j = payments.join(b, bill_key, "left")
    no_order = F.lit(False)
    for c in order_cols:
        no_order = no_order | F.col(c).isNull()
    reason = (F.when(no_order, F.lit("payment order key is NULL"))
              .when(F.col("_found").isNull(),
                     F.format_string("bill %s does not exist", F.col(bill_key).cast("string")))
              .when(F.col("amount").isNull() | (F.col("amount") <= 0),
                    F.lit("amount must be greater than zero"))
              .when(F.col("amount") != F.round("amount", 2), F.lit("amount has more than two decimals"))
              .when(F.col("_start_balance").isNull(), F.lit("bill balance is NULL"))
              .when(F.col("_start_balance") < 0,
                    F.format_string("bill balance cannot be negative (got %s)",
                                    F.col("_start_balance").cast("string")))
              .when(F.length("payment_method") > METHOD_MAX_LENGTH,
                    F.lit(f"payment_method longer than {METHOD_MAX_LENGTH} characters")))
    days = F.greatest(F.datediff(as_of, F.col("due_date")), F.lit(0))
    return j.withColumn("reject_reason", reason).withColumn(
        "days_late", F.when(F.col("_found").isNotNull(), days))


def _fold_small(valid: DataFrame, bill_key: str, order_cols: list[str],
                pay_cols: list[str], largest: int = LARGEST) -> DataFrame:
    """aggregate() over the sorted payment array of each bill -> one row per payment."""
    item = F.struct(*[F.col(c) for c in order_cols + [c for c in pay_cols if c not in order_cols]])
    grouped = valid.groupBy(bill_key).agg(
        F.array_sort(F.collect_list(item)).alias("_ps"),
        F.max("_start_balance").alias("_start_balance"),
        F.max("_rate").alias("_rate"))
    step_type = f"array<struct<surcharge:{BAL},new_balance:{BAL},{REFUSED}:boolean>>"
    init = F.struct(_dec(F.col("_start_balance")).alias("bal"),
                    F.array().cast(step_type).alias("out"))

    def merge(acc, p):
        s = _dec(F.round(acc["bal"] * F.col("_rate"), 2))
        after = F.greatest(acc["bal"] + s - p["amount"], F.lit(0))
        refused = after > F.lit(Decimal(largest) / 100)
        nb = _dec(F.when(refused, acc["bal"]).otherwise(after))
        return F.struct(nb.alias("bal"), F.concat(acc["out"], F.array(F.struct(
            s.alias("surcharge"), nb.alias("new_balance"), refused.alias(REFUSED)))).alias("out"))

    folded = grouped.select(bill_key, "_ps", F.aggregate("_ps", init, merge)["out"].alias("_out"))
    z = folded.select(bill_key, F.posexplode(F.arrays_zip("_ps", "_out")).alias("pos", "z"))
    return z.select(bill_key, (F.col("pos") + 1).cast("bigint").alias("seq"),
                    *[F.col("z._ps")[c].alias(c) for c in order_cols
                      + [c for c in pay_cols if c not in order_cols]],
                    F.col("z._out.surcharge").alias("surcharge"),
                    F.col("z._out.new_balance").alias("new_balance"), F.col(f"z._out.{REFUSED}").alias(REFUSED))


def _fold_hot(valid: DataFrame, bill_key: str, order_cols: list[str], pay_cols: list[str],
              n_partitions: int, stage_path: str, largest: int = LARGEST) -> DataFrame:
    """Exact fold of bills with many payments, over range pieces of a bill at the same time (see
    ``balance_pieces``). Money crosses into Python as integer cents and the rate as integer
    thousandths, so the loop is plain integer arithmetic; Spark converts back to decimals (exact)
    afterwards."""
    cols = [bill_key] + order_cols + [c for c in pay_cols if c not in order_cols]
    src = valid.select(*cols, (F.col("amount") * 100).cast("bigint").alias("_amount_c"),
                       (F.col("_start_balance") * 100).cast("bigint").alias("_start_c"),
                       (F.col("_rate") * 1000).cast("bigint").alias("_rate_m"))
    return fold_in_pieces(src, bill_key, order_cols, cols, n_partitions, stage_path, largest).select(
        *cols, "seq", money("_surcharge_c", BAL).alias("surcharge"), money("_balance_c", BAL).alias("new_balance"), REFUSED)


def _bill_prefix(df: DataFrame, bill_key: str, order_cols: list[str], value: Column,
                 n_partitions: int, stage_path: str) -> DataFrame:
    """Adds ``seq`` (1-based position of each row in its bill's payment order) and ``_run``
    (running sum of ``value`` up to the row). Rows are range-partitioned by (bill, payment order), so a hot bill spreads
    over many tasks: positions and sums are taken inside each (bill, partition) piece, then
    shifted by the totals of the bill's earlier pieces (one row per piece). The piece id is
    staged with the rows: the rows and the piece totals are two branches, and two separately
    sampled range partitionings of shuffled input need not agree."""
    (df.withColumn("_v", value)
     .repartitionByRange(n_partitions, bill_key, *order_cols)
     .withColumn("_pid", F.spark_partition_id())
     .write.mode("overwrite").parquet(stage_path))
    ranged = df.sparkSession.read.parquet(stage_path)
    piece = Window.partitionBy(bill_key, "_pid").orderBy(*order_cols)
    local = ranged.withColumn("_lrn", F.row_number().over(piece).cast("bigint"))
    local = local.withColumn("_lsum", F.sum("_v").over(
        piece.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    totals = local.groupBy(bill_key, "_pid").agg(
        F.max("_lrn").alias("_pcnt"), F.max_by("_lsum", "_lrn").alias("_psum"))
    before = Window.partitionBy(bill_key).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (totals.withColumn("_ocnt", F.coalesce(F.sum("_pcnt").over(before), F.lit(0)))
               .withColumn("_osum", F.coalesce(F.sum("_psum").over(before), F.lit(0))))
    j = local.join(offsets.select(bill_key, "_pid", "_ocnt", "_osum"), [bill_key, "_pid"])
    return j.select(*df.columns, (F.col("_ocnt") + F.col("_lrn")).cast("bigint").alias("seq"),
                    (F.col("_osum") + F.col("_lsum")).alias("_run"))


def _fold_hot_prefix(valid: DataFrame, bill_key: str, order_cols: list[str],
                     pay_cols: list[str], n_partitions: int, stage_path: str) -> DataFrame:
    """Hot bills that are not overdue (rate 0): each new balance is max(start - running sum of
    amounts, 0), an exact distributed prefix sum (decimal, no rounding)."""
    cols = [bill_key] + order_cols + [c for c in pay_cols if c not in order_cols]
    pos = _bill_prefix(valid.select(*cols, "_start_balance"), bill_key, order_cols,
                       F.col("amount"), n_partitions, stage_path)
    return pos.select(*cols, "seq", F.lit(0).cast(BAL).alias("surcharge"),
                      _dec(F.greatest(_dec(F.col("_start_balance")) - F.col("_run"), F.lit(0)))
                      .alias("new_balance"), F.lit(False).alias(REFUSED))


# Soundness margin of the zero certificate (relative and absolute). Its terms are positive
# doubles, so the summation error is at most (number of terms) x 2^-53 relative: the margin
# covers bills of up to ~10^9 payments.
ZERO_CERT_REL = 1e-6
ZERO_CERT_ABS = 1e-6


def _split_hot_overdue(hot: DataFrame, bill_key: str, order_cols: list[str],
                       pay_cols: list[str], n_partitions: int,
                       stage_path: str) -> tuple[DataFrame, DataFrame]:
    """Hot overdue bills: (rows that need the sequential fold, rows settled in parallel).

    One step is b -> max(b + round(b*r, 2) - a, 0). It is monotone in b, and 0 stays 0 (the
    surcharge on 0 is 0 and every valid amount is positive; a refused payment leaves b below what
    the step would give, so the bound holds). With v_0 = start and
    v_m = (1+r) v_(m-1) + 0.005 - a_m, induction gives b_m <= max(v_m, 0); so b_t = 0 from
    the first t where v_t <= 0, i.e. where sum_(m<=t) (1+r)^-m (a_m - 0.005) >= start. That
    discounted running sum grows with every payment, so the sums of whole range pieces tell the
    piece of the first certified t, and only the rows of that piece need running sums. Payments
    after t have surcharge 0 and balance 0; only payments up to t are folded. A bill whose payments
    never certify zero (they only cover the surcharge) is folded whole, in pieces.
    Rows are staged in order with their place in their partition, and meet what is known of their
    piece (one row a piece: at most one for each ``max_fold`` payments and one a partition) by a
    broadcast, so they are moved once. Both branches read the same staged rows and cuts."""
    cols = [bill_key] + order_cols + [c for c in pay_cols if c not in order_cols]
    spark, piece = hot.sparkSession, [bill_key, "_pid"]
    (hot.select(*cols, "_start_balance", "_rate").repartitionByRange(n_partitions, bill_key, *order_cols)
     .sortWithinPartitions(bill_key, *order_cols).withColumn("_mid", F.monotonically_increasing_id())
     .withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_at", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
     .drop("_mid").write.mode("overwrite").parquet(f"{stage_path}/ranged"))
    ranged = spark.read.parquet(f"{stage_path}/ranged")

    def staged(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{stage_path}/{name}")
        return spark.read.parquet(f"{stage_path}/{name}")

    # Discounted by the place in the piece; the pieces before it discount the whole piece once more.
    term = (F.col("amount") - F.lit(Decimal("0.005"))).cast("double") * F.pow(F.col("_base"), F.col("_first") - F.col("_at") - 1)
    begins = staged(ranged.groupBy(*piece).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"), F.max("_start_balance").cast("double").alias("_start"),
        (F.lit(1) + F.max("_rate")).cast("double").alias("_base")), "begins")
    sums = ranged.select(*piece, "_at", "amount").join(F.broadcast(begins), piece).groupBy(*piece).agg(F.sum(term).alias("_psum"))
    before = Window.partitionBy(bill_key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.pow(F.col("_base"), -F.col("_ocnt"))
    enough = F.col("_start") * (1 + ZERO_CERT_REL) + ZERO_CERT_ABS
    pieces = staged(
        begins.join(sums, piece).withColumn("_ocnt", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .withColumn("_osum", F.coalesce(F.sum(F.col("_psum") * shift).over(before), F.lit(0.0)))
        .withColumn("_certified", F.col("_osum") + F.col("_psum") * shift >= enough)
        .withColumn("_cut_pid", F.min(F.when(F.col("_certified"), F.col("_pid"))).over(Window.partitionBy(bill_key))), "pieces")
    cut_pieces = pieces.where(F.col("_pid") == F.col("_cut_pid"))
    running = F.sum(term).over(Window.partitionBy(*piece).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seq = (F.col("_ocnt") + F.col("_at") - F.col("_first") + 1).cast("bigint")
    first = (ranged.select(*piece, "_at", "amount").join(F.broadcast(cut_pieces), piece)
             .withColumn("_run", F.col("_osum") + running * shift).where(F.col("_run") >= enough)
             .groupBy(bill_key).agg(F.min(seq).alias("_cut")))
    # A piece that is certified by its sum is so at its last payment at the latest.
    cuts = staged(cut_pieces.select(bill_key, (F.col("_ocnt") + F.col("_rows")).alias("_end")).join(first, bill_key, "left")
                  .select(bill_key, F.coalesce("_cut", "_end").alias("_cut")), "cuts")
    known = pieces.join(cuts, bill_key, "left").select(*piece, "_first", "_ocnt", "_cut")
    split = ranged.join(F.broadcast(known), piece).withColumn("seq", seq).drop("_pid", "_at", "_first", "_ocnt")
    sequential = split.where(F.col("_cut").isNull() | (F.col("seq") <= F.col("_cut")))
    settled = split.where(F.col("seq") > F.col("_cut")).select(
        *cols, "seq", F.lit(0).cast(BAL).alias("surcharge"), F.lit(0).cast(BAL).alias("new_balance"),
        F.lit(False).alias(REFUSED))
    return sequential.drop("seq", "_cut"), settled


def fold_payments(valid: DataFrame, *, bill_key: str, order_cols: list[str],
                  pay_cols: list[str], max_fold: int = DEFAULT_MAX_FOLD,
                  hot_partitions: int | None = None, has_hot: bool = True,
                  stage_path: str | None = None, largest: int = LARGEST) -> DataFrame:
    """One row per valid payment with seq, surcharge, new_balance and whether it is refused, as the
    new balance would be above ``largest`` cents (all paths exact).
    ``has_hot=False`` (no bill above ``max_fold`` payments) leaves the hot paths out of the
    plan. Hot bills that are not overdue use the distributed prefix sum. Hot overdue bills
    (the surcharge compounds on the rounded running balance, a sequential recurrence) are
    split at the first payment after which the balance is certified zero: the rest is settled
    in parallel, the head is folded in range pieces (``balance_pieces``)."""
    if not has_hot:
        return _fold_small(valid, bill_key, order_cols, pay_cols, largest)
    spark = valid.sparkSession
    if HOT not in valid.columns:
        valid = valid.join(hot_bills(valid, bill_key, max_fold), bill_key, "left")
    n = hot_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    stage = stage_path or work_path(spark, "hot-bills")
    # The validated rows are staged once: every branch reads them without re-running the
    # validation join, and no grouping by bill stands directly on that join.
    valid.write.mode("overwrite").parquet(f"{stage}/rows")
    staged = spark.read.parquet(f"{stage}/rows")
    small = _fold_small(staged.where(F.col(HOT).isNull()), bill_key, order_cols, pay_cols, largest)
    hot = staged.where(F.col(HOT)).drop(HOT)
    # Which hot branches have rows (one small aggregate over the staged rows): an empty
    # branch would still run its own staging jobs.
    kinds = hot.agg(F.count_if(F.col("_rate") == 0).alias("zero"),
                    F.count_if(F.col("_rate") > 0).alias("overdue")).first()
    out = small
    if kinds["zero"]:
        out = out.unionByName(_fold_hot_prefix(hot.where(F.col("_rate") == 0), bill_key,
                                               order_cols, pay_cols, n, f"{stage}/not-overdue"))
    if kinds["overdue"]:
        head, settled = _split_hot_overdue(hot.where(F.col("_rate") > 0), bill_key, order_cols,
                                           pay_cols, n, f"{stage}/overdue")
        out = (out.unionByName(_fold_hot(head, bill_key, order_cols, pay_cols, n, f"{stage}/head", largest))
               .unionByName(settled))
    return out


HOT = "_hot"


def hot_bills(payments: DataFrame, bill_key: str, max_fold: int) -> DataFrame:
    """The bills with more than ``max_fold`` payments, tagged: at most one row per ``max_fold``
    payments, counted map-side first, so AQE can broadcast the list."""
    return (payments.groupBy(bill_key).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > max_fold).select(bill_key, F.lit(True).alias(HOT)))


def _log_text(amount: Column, method: Column, surcharge: Column, days: Column,
              new_balance: Column) -> Column:
    return F.format_string(LOG_TEMPLATE, amount.cast("string"),
                           F.coalesce(method, F.lit("")), surcharge.cast("string"),
                           days.cast("string"), new_balance.cast("string"))


def assign_ids(spark: SparkSession, rows: DataFrame, order_cols: list[str], base: Column | int,
               id_col: str = "id", n_partitions: int | None = None,
               stage_path: str | None = None) -> DataFrame:
    """Gapless ids base+1.. following the global order of ``order_cols``, without a
    single-partition sort. The staged copy fixes partition contents between the two passes."""
    n = n_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = stage_path or work_path(spark, "ids")
    ranged = (rows.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_mid", F.monotonically_increasing_id()))
    staged_w = ranged.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_local", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    staged_w.drop("_mid").write.mode("overwrite").parquet(path)
    staged = spark.read.parquet(path)
    counts = staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # One row per partition: the running total over them is tiny and bounded by n.
    offsets = counts.select("_pid", (F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt"))
                            .alias("_off"))
    base_col = base if isinstance(base, Column) else F.lit(base)
    return (staged.join(F.broadcast(offsets), "_pid")
            .withColumn(id_col, (base_col + F.col("_off") + F.col("_local") + 1).cast("bigint"))
            .drop("_pid", "_local", "_off"))


class PaymentRun:
    """Result of ``apply_payments``. The applied payments are staged once (Parquet in the work
    folder), so the bills, the log and any retry read the same rows; ``log`` is built on first
    use (it needs one extra pass to number the rows)."""

    def __init__(self, spark, bills, payments, edit_log, rejects, applied, bill_key, order_cols,
                 as_of_col, edited, set_paid_date, stage_path):
        self._spark, self._bills, self._edit_log = spark, bills, edit_log
        self.rejects = rejects
        self.applied = applied
        self._bill_key, self._order = bill_key, order_cols
        self._as_of, self._edited, self._set_paid = as_of_col, edited, set_paid_date
        self._stage = stage_path
        self._log = None

    @property
    def bills(self) -> DataFrame:
        k, bills = self._bill_key, self._bills
        final = self.applied.groupBy(k).agg(
            F.max_by(F.struct(F.col("new_balance").alias("_nb"),
                              F.col("payment_method").alias("_pm")), F.col("seq")).alias("_last"))
        b = bills.join(final.withColumnRenamed(k, "id"), "id", "left")
        touched = F.col("_last").isNotNull()
        paid_now = F.col("_last._nb") == 0
        updates = {
            "balance": F.when(touched, F.col("_last._nb").cast(bills.schema["balance"].dataType))
                        .otherwise(F.col("balance")),
            "status": F.when(touched & paid_now, F.lit(PAID_STATUS)).otherwise(F.col("status")),
            "payment_method": F.when(touched, F.col("_last._pm")).otherwise(F.col("payment_method")),
        }
        if self._set_paid and "paid_date" in bills.columns:
            updates["paid_date"] = F.when(touched & paid_now & F.col("paid_date").isNull(),
                                          self._as_of).otherwise(F.col("paid_date"))
        return b.select(*[updates.get(c, F.col(c)).alias(c) for c in bills.columns])

    @property
    def log_with_keys(self) -> DataFrame:
        if self._log is None:
            k = self._bill_key
            # Typed columns are moved and staged, which are small; the texts are made after that.
            rows = self.applied.select(k, "seq", "policy_id", "amount", "payment_method", "surcharge",
                                       "days_late", "new_balance", "edited_by")
            base = self._edit_log.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"]
            numbered = assign_ids(self._spark, rows, [k, "seq"], int(base),
                                  stage_path=f"{self._stage}/log")
            self._log = numbered.select(
                F.col(k), F.col("seq"), F.col("policy_id"),
                F.lit(LOG_TABLE_NAME).alias("edited_table_name"), self._edited.alias("edited_date"),
                _log_text(F.col("amount"), F.col("payment_method"), F.col("surcharge"),
                          F.col("days_late"), F.col("new_balance")).alias("additional_info"),
                F.col("edited_by"), F.col("id"))
        return self._log

    @property
    def log(self) -> DataFrame:
        return self.log_with_keys.select(*self._edit_log.columns)

    @property
    def edit_log(self) -> DataFrame:
        return self._edit_log.unionByName(self.log)

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def publish(self, bills_table: str, log_table: str, root: str, *, base=None,
                batch: str | None = None) -> dict:
        """Publish the rebuilt bills and the extended edit log in one commit: both new versions are
        written first, then one manifest makes both live. The inputs may be these same tables: the
        new versions go to new folders, so the job reads the current version while it writes the
        next one.

        ``base``: the ``plans.manifest`` snapshot the inputs were read from (default: the state when
        this call begins); the commit is refused if either table has changed since. ``batch`` names
        the batch of payments: if the live tables were made by that batch already (a rerun after a
        driver that was lost past its commit), nothing is charged again and no version returned."""
        from tessera.plans.manifest import snapshot
        from tessera.plans.publish import database_of, publish_all, recover

        head = snapshot(self._spark, root, database_of([bills_table, log_table]))
        made_by = [head.entry(t).batch if head.entry(t) else None for t in (bills_table, log_table)]
        if batch is not None and made_by == [batch, batch]:
            recover(self._spark, root, head.database)
            return {}
        return publish_all(self._spark, {bills_table: self.bills, log_table: self.edit_log}, root,
                           base=base or head, batch=batch)


def apply_payments(spark: SparkSession, bills: DataFrame, payments: DataFrame,
                   edit_log: DataFrame, *, as_of: _dt.date | str | None = None,
                   edited_at: _dt.datetime | str | None = None,
                   order_cols: tuple[str, ...] = ("payment_id",), bill_key: str = "bill_id",
                   set_paid_date: bool = False, max_fold: int = DEFAULT_MAX_FOLD,
                   hot_partitions: int | None = None,
                   stage_path: str | None = None) -> PaymentRun:
    """Apply a batch of payments. Returns a ``PaymentRun`` with ``bills`` (rebuilt bills),
    ``log`` (new edit-log rows), ``edit_log`` (old + new), ``rejects`` and ``applied``. ``as_of``:
    the day to which lateness is counted, today by default."""
    stage = stage_path or work_path(spark, "payments")
    as_of_col = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    edited = (F.lit(str(edited_at)).cast("timestamp_ntz") if edited_at is not None
              else F.current_timestamp().cast("timestamp_ntz"))
    # Hot bills are counted on the payments themselves and tagged before the validation join.
    hot_bills(payments, bill_key, max_fold).write.mode("overwrite").parquet(f"{stage}/hot-bills")
    hot_list = spark.read.parquet(f"{stage}/hot-bills")
    hot = not hot_list.isEmpty()
    tagged = payments.join(hot_list, bill_key, "left") if hot else payments
    checked = validate(tagged, bills, bill_key=bill_key, as_of=as_of_col,
                       order_cols=tuple(order_cols))
    rejects = checked.where(F.col("reject_reason").isNotNull()).select(
        *payments.columns, "reject_reason")
    valid = (checked.where(F.col("reject_reason").isNull())
             .withColumn("amount", _dec(F.col("amount")))
             .withColumn("_start_balance", _dec(F.round("_start_balance", 2)))
             .withColumn("_rate", late_fee_rate(F.col("days_late"), F.col("_start_balance"))))
    order = list(order_cols)
    # Bill context travels with each payment, so no second join is needed after the fold.
    pay_cols = [c for c in payments.columns if c != bill_key] + ["policy_id", "days_late"]
    applied = fold_payments(valid, bill_key=bill_key, order_cols=order, pay_cols=pay_cols,
                            max_fold=max_fold, hot_partitions=hot_partitions, has_hot=hot,
                            stage_path=f"{stage}/hot", largest=largest_balance(bills.schema["balance"].dataType))
    applied.write.mode("overwrite").parquet(f"{stage}/applied")
    folded = spark.read.parquet(f"{stage}/applied")
    applied = folded.where(~F.col(REFUSED)).drop(REFUSED)
    rejects = rejects.unionByName(folded.where(REFUSED).select(
        *[F.col(c).cast(payments.schema[c].dataType).alias(c) for c in payments.columns],
        F.lit("new balance does not fit the balance column").alias("reject_reason")))
    return PaymentRun(spark, bills, payments, edit_log, rejects, applied, bill_key, order,
                      as_of_col, edited, set_paid_date, stage)
