"""Schema drift: compare incoming column names with the target before anything is written.

Works on schema metadata only (column names), so it costs one header read per source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class SchemaDriftError(RuntimeError):
    """The source brings columns the target does not have (or lacks declared ones)."""

    def __init__(self, message: str, report: "DriftReport"):
        super().__init__(message)
        self.report = report


@dataclass(frozen=True)
class DriftReport:
    table: str
    schema: str
    new: tuple[str, ...]
    missing: tuple[str, ...]

    @property
    def has_drift(self) -> bool:
        return bool(self.new or self.missing)

    def ddl(self) -> list[str]:
        """Suggested statements: one per new column, sorted; STRING since a header has no
        types (the person applying it may refine the type)."""
        return [f"ALTER TABLE {self.schema}.{self.table} ADD COLUMNS (`{c}` STRING);"
                for c in self.new]

    def message(self) -> str:
        parts = [f"Schema drift in {self.schema}.{self.table}:"]
        if self.new:
            parts.append(f" the source brings column(s) the target does not have: {list(self.new)}.")
        if self.missing:
            parts.append(f" the source lacks column(s) of the target: {list(self.missing)}.")
        parts.append(" Nothing was loaded for this table (other tables go on).")
        if self.new:
            parts.append(" To resolve, apply and run again:\n\n" + "\n".join(self.ddl()))
        return "".join(parts)


#: Columns that loads add to a table by themselves; sources do not bring them.
LINEAGE_COLUMNS = frozenset({"_SOURCE_FILE"})


def _norm(names) -> dict[str, str]:
    return {n.strip().upper(): n.strip() for n in names}


def compare_columns(table: str, incoming: list[str], target: list[str] | None,
                    schema: str = "raw") -> DriftReport:
    """Case-insensitive, whitespace-stripped comparison. ``target=None`` (table does not exist
    yet): no drift, the table is created from its contract. The target's own lineage columns are
    not part of the comparison; every incoming column is, whatever its name."""
    if target is None:
        return DriftReport(table, schema, (), ())
    inc = _norm(incoming)
    tgt = {k: v for k, v in _norm(target).items() if k in inc or k not in LINEAGE_COLUMNS}
    new = tuple(sorted(inc[k].upper() for k in inc.keys() - (tgt.keys() - LINEAGE_COLUMNS)))
    missing = tuple(sorted(tgt[k].upper() for k in tgt.keys() - inc.keys()))
    return DriftReport(table, schema, new, missing)


def check_drift(table: str, incoming: list[str], target: list[str] | None, schema: str = "raw",
                allow_missing: bool = False) -> DriftReport:
    """Raise ``SchemaDriftError`` on new columns, and on missing ones unless allowed."""
    r = compare_columns(table, incoming, target, schema)
    if r.new or (r.missing and not allow_missing):
        raise SchemaDriftError(r.message(), r)
    return r


def table_columns(spark: SparkSession, name: str) -> list[str] | None:
    """Target columns from the catalog, or None when the table does not exist."""
    if not spark.catalog.tableExists(name):
        return None
    return [f.name for f in spark.table(name).schema.fields]


def drift_frame(spark: SparkSession, reports: list[DriftReport]) -> DataFrame:
    """Drift reports as rows: table, column, kind (new/missing), suggested DDL."""
    rows = []
    for r in reports:
        ddl = dict(zip(r.new, r.ddl()))
        rows += [(r.table, c, "new", ddl[c]) for c in r.new]
        rows += [(r.table, c, "missing", None) for c in r.missing]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, kind string, suggested_ddl string")


def variant_schema_report(landing: DataFrame, column: str = "raw") -> DataFrame:
    """Observed union schema of schema-on-read documents (merged per task, then globally)."""
    return landing.agg(F.schema_of_variant_agg(F.col(column)).alias("observed_schema"))
