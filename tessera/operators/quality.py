"""Declarative data-quality rules. A rule selects the rows that must NOT exist; zero rows = pass.

All row, key and orphan rules are counted in one pass over the tables (``operators.integrity``);
``run_rules`` adds an ordered sample of the offenders of each failed rule, one lookup each, and
``integrity.detail`` the same for all rules at once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.contracts import TableContract

Tables = Callable[[str], DataFrame]

REPORT_SCHEMA = "name string, ok boolean, n_offenders bigint"
SAMPLE_ROWS = 3


@dataclass(frozen=True)
class Rule:
    name: str
    description: str
    table: str
    # Offending rows, built lazily from the table source.
    offenders: Callable[[Tables], DataFrame]
    # Fusable form: a predicate over the table's rows (offender when true).
    predicate: Callable[[], Column] | None = None
    # Table-level fusable form: offender count from the table's row count (emptiness).
    on_row_count: Callable[[Column], Column] | None = None
    # Cheap count form returning one row with column n_offenders (defaults to counting offenders).
    count: Callable[[Tables], DataFrame] | None = None
    order_by: tuple[str, ...] = field(default=())
    # Columns that a sample of offenders shows.
    columns: tuple[str, ...] = field(default=())
    # Forms that ``integrity`` counts together: unique key columns; (foreign key, parent, its key).
    keys: tuple[str, ...] = field(default=())
    reference: tuple[tuple[str, ...], str, tuple[str, ...]] | None = None


def _any_null(cols) -> Column:
    cond = None
    for c in cols:
        e = F.col(c).isNull()
        cond = e if cond is None else (cond | e)
    return cond


def row_rule(name: str, table: str, predicate: Callable[[], Column], description: str = "",
             columns: tuple[str, ...] | None = None, order_by: tuple[str, ...] = ()) -> Rule:
    def offenders(t: Tables) -> DataFrame:
        df = t(table).where(predicate())
        return df.select(*columns) if columns else df
    return Rule(name, description, table, offenders, predicate=predicate, order_by=order_by, columns=columns or ())


def not_null(table: str, cols: tuple[str, ...], name: str | None = None,
             order_by: tuple[str, ...] = ()) -> Rule:
    return row_rule(name or f"not_null[{table}.{','.join(cols)}]", table,
                    lambda: _any_null(cols), f"{table}.{','.join(cols)} must not be NULL",
                    order_by=order_by)


def pk_not_null(table: str, keys: tuple[str, ...]) -> Rule:
    return row_rule(f"pk_not_null[{table}]", table, lambda: _any_null(keys),
                    f"{table} key must not be NULL", order_by=keys)


def max_length(table: str, col: str, n: int) -> Rule:
    return row_rule(f"max_length[{table}.{col}]", table, lambda: F.length(col) > n,
                    f"{table}.{col} must be at most {n} characters", order_by=(col,))


def column_order(table: str, low: str, high: str, name: str | None = None,
                 columns: tuple[str, ...] | None = None) -> Rule:
    """``high < low`` is an offence; NULL on either side is not (unknown is not wrong)."""
    return row_rule(name or f"date_order[{table}]", table, lambda: F.col(high) < F.col(low),
                    f"{table}.{high} must not be before {low}", columns, order_by=columns or ())


def not_empty(table: str) -> Rule:
    def offenders(t: Tables) -> DataFrame:
        return (t(table).agg(F.count(F.lit(1)).alias("n")).where("n = 0")
                .select(F.lit("empty table").alias("problem")))
    return Rule(f"not_empty[{table}]", f"{table} must have at least one row", table, offenders,
                on_row_count=lambda n: F.when(n == 0, F.lit(1)).otherwise(F.lit(0)))


def unique(table: str, keys: tuple[str, ...], name: str | None = None) -> Rule:
    """Keys that occur more than once, with their multiplicity. NULL keys form one group."""
    def offenders(t: Tables) -> DataFrame:
        return (t(table).groupBy(*keys).agg(F.count(F.lit(1)).alias("times"))
                .where(F.col("times") > 1))
    return Rule(name or f"pk_unique[{table}]", f"{table}.{','.join(keys)} must be unique", table,
                offenders, order_by=keys, keys=keys)


def no_orphans(child: str, fk: tuple[str, ...], parent: str, pk: tuple[str, ...],
               name: str | None = None, child_columns: tuple[str, ...] | None = None) -> Rule:
    """Child rows whose non-NULL foreign key has no parent row (NULL FK = no relation)."""
    def parent_keys(t: Tables) -> DataFrame:
        return t(parent).select(*[F.col(p).alias(f) for p, f in zip(pk, fk)]).distinct()

    def offenders(t: Tables) -> DataFrame:
        rows = t(child).where(~_any_null(fk))
        if child_columns:
            rows = rows.select(*child_columns)
        return rows.join(parent_keys(t), list(fk), "left_anti")

    def count(t: Tables) -> DataFrame:
        per_key = (t(child).where(~_any_null(fk)).groupBy(*fk)
                   .agg(F.count(F.lit(1)).alias("n")))
        return (per_key.join(parent_keys(t), list(fk), "left_anti")
                .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_offenders")))

    label = name or f"no_orphans[{child}.{','.join(fk)}]"
    return Rule(label, f"{child}.{','.join(fk)} must exist in {parent}.{','.join(pk)}", child,
                offenders, count=count, order_by=fk, reference=(fk, parent, pk))


def source_target_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row (source_rows, target_rows): both sides tagged, unioned, counted in one pass."""
    tagged = (source.select(F.lit(1).alias("_s"), F.lit(0).alias("_t"))
              .unionByName(target.select(F.lit(0).alias("_s"), F.lit(1).alias("_t"))))
    return tagged.agg(F.coalesce(F.sum("_s"), F.lit(0)).cast("bigint").alias("source_rows"),
                      F.coalesce(F.sum("_t"), F.lit(0)).cast("bigint").alias("target_rows"))


def counts_match(table: str, source: Callable[[], DataFrame], target: Callable[[], DataFrame],
                 name: str | None = None) -> Rule:
    """Source vs target row count; one offender row when they differ."""
    def both(t: Tables) -> DataFrame:
        return source_target_counts(source(), target())

    def offenders(t: Tables) -> DataFrame:
        return both(t).where(F.col("source_rows") != F.col("target_rows"))

    return Rule(name or f"count_source_target[{table}]", f"{table} source and target counts equal",
                table, offenders)


def custom(name: str, table: str, offenders: Callable[[Tables], DataFrame], description: str = "",
           order_by: tuple[str, ...] = ()) -> Rule:
    return Rule(name, description, table, offenders, order_by=order_by)


# ----------------------------------------------------------------------------------------------
# Standard rule sets
# ----------------------------------------------------------------------------------------------

def contract_rules(contracts: dict[str, TableContract], *, not_null_columns: bool = False,
                   lengths: bool = True) -> list[Rule]:
    """Key NOT NULL, key unique, no orphans (per FK), not empty; optionally NOT NULL of every
    declared column, secondary uniqueness and declared maximum lengths."""
    rules: list[Rule] = []
    for name, c in contracts.items():
        rules.append(pk_not_null(name, c.primary_key))
    for name, c in contracts.items():
        rules.append(unique(name, c.primary_key))
    for name, c in contracts.items():
        for fk in c.foreign_keys:
            rules.append(no_orphans(name, (fk.column,), fk.parent, (fk.parent_column,)))
    for name in contracts:
        rules.append(not_empty(name))
    for name, c in contracts.items():
        for u in c.unique:
            rules.append(unique(name, u, name=f"unique[{name}.{','.join(u)}]"))
        if not_null_columns:
            for col in c.columns:
                if col.not_null and col.name not in c.primary_key:
                    rules.append(not_null(name, (col.name,)))
        if lengths:
            for col in c.columns:
                if col.max_length:
                    rules.append(max_length(name, col.name, col.max_length))
    return rules


def insurance_rules(contracts: dict[str, TableContract]) -> list[Rule]:
    """The 29 rules of the relational load check plus the business rules of the model."""
    rules = contract_rules(contracts, lengths=False)
    rules.append(column_order("policy", "policy_effective_date", "policy_expire_date",
                              name="date_order[policy]",
                              columns=("id", "policy_number", "policy_effective_date",
                                       "policy_expire_date")))
    rules.append(row_rule("paid_zero_balance[bill]", "bill",
                          lambda: (F.upper("status") == "PAID")
                          & (F.coalesce(F.col("balance"), F.lit(0)) != 0),
                          "a Paid bill must have zero balance",
                          ("id", "policy_id", "status", "balance"), order_by=("id",)))
    return rules


# ----------------------------------------------------------------------------------------------
# Runner
# ----------------------------------------------------------------------------------------------

def rule_counts(tables: Tables, rules: list[Rule]) -> DataFrame:
    """Lazy report (name, ok, n_offenders) for all rules: one scan per table and one shuffle for row,
    key and orphan rules together (``integrity``)."""
    from tessera.operators import integrity

    return integrity.counts(tables, rules)


def _sample_text(df: DataFrame, order_by: tuple[str, ...]) -> str:
    if order_by:
        df = df.orderBy(*order_by)
    rows = df.limit(SAMPLE_ROWS).collect()  # bounded: at most SAMPLE_ROWS rows
    return ", ".join(str(tuple(r)) for r in rows)


def run_rules(spark: SparkSession, tables: Tables, rules: list[Rule],
              with_sample: bool = True) -> DataFrame:
    """Evaluate all rules; returns (name, ok, n_offenders, detail) with one row per rule.
    The report itself has one row per rule, so bringing it to the driver is bounded."""
    by_name = {r.name: r for r in rules}
    counts = {row["name"]: row["n_offenders"] for row in rule_counts(tables, rules).collect()}
    out = []
    for r in rules:
        n = counts[r.name]
        detail = "no problems"
        if n and with_sample:
            detail = f"{n} row(s), e.g.: {_sample_text(by_name[r.name].offenders(tables), r.order_by)}"
        elif n:
            detail = f"{n} row(s)"
        out.append((r.name, n == 0, n, detail))
    return spark.createDataFrame(out, REPORT_SCHEMA + ", detail string")


def summary(report: DataFrame) -> DataFrame:
    """Passed / failed / total counts of a report."""
    return report.agg(F.count_if("ok").alias("passed"), F.count_if(~F.col("ok")).alias("failed"),
                      F.count(F.lit(1)).alias("total"))


class ValidationFailed(RuntimeError):
    pass


def raise_if_failed(report: DataFrame) -> None:
    failed = [r["name"] for r in report.where(~F.col("ok")).select("name").collect()]
    if failed:
        raise ValidationFailed(f"{len(failed)} rule(s) failed: {', '.join(failed)}")
