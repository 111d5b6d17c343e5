"""Table contracts: declared columns, types, keys and the text conversion of each column.

A contract is metadata only (a few dozen names); it drives by-name typed projections that run on
executors. ``kind`` picks the text conversion used for seed files and CSV extracts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import types as T

from tessera.functions import scalars as S

# kind -> Spark type (DDL string)
KIND_TYPES = {
    "id": "bigint",
    "int": "int",
    "money": "decimal(10,2)",
    "text": "string",
    "varchar20": "string",
    "bool": "boolean",
    "date": "date",
    "timestamp": "timestamp_ntz",
    "double": "double",
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    kind: str
    not_null: bool = False
    type_: str | None = None  # overrides KIND_TYPES

    @property
    def spark_type(self) -> str:
        return self.type_ or KIND_TYPES[self.kind]

    @property
    def max_length(self) -> int | None:
        return 20 if self.kind == "varchar20" else None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[str, ...] = ("id",)
    foreign_keys: tuple[ForeignKey, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    parents_first_rank: int = 0
    options: dict = field(default_factory=dict)

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name.lower() == name.lower():
                return c
        raise KeyError(name)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{c.name}` {c.spark_type}" for c in self.columns))

    @property
    def string_struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, T.StringType(), True) for c in self.columns])


def seed_conversion(spec: ColumnSpec, c: Column) -> Column:
    """Conversion of a seed-file text field (every value in a seed file is a string)."""
    k = spec.kind
    if k in ("id", "int"):
        return S.parse_int(c, spec.spark_type)
    if k in ("money", "double"):
        return S.parse_decimal(c, spec.spark_type)
    if k in ("text", "varchar20"):
        return S.parse_text(c)
    if k == "bool":
        return S.parse_bool(c)
    if k == "date":
        return S.parse_date(c)
    if k == "timestamp":
        return S.parse_timestamp(c)
    raise ValueError(f"unknown kind {k}")


def strict_cast(spec: ColumnSpec, c: Column) -> Column:
    """CSV field -> declared type. ANSI cast: text that does not parse raises."""
    if spec.kind in ("text", "varchar20"):
        return c
    return c.cast(spec.spark_type)


def lenient_cast(spec: ColumnSpec, c: Column) -> Column:
    """CSV field -> declared type, NULL when the text does not parse (for on_error=continue)."""
    if spec.kind in ("text", "varchar20"):
        return c
    return c.try_cast(spec.spark_type)


def _c(name, kind, nn=False, type_=None):
    return ColumnSpec(name, kind, nn, type_)


# The seven relational tables of the insurance model (final schema after migrations).
RELATIONAL = {
    "coverage": TableContract("coverage", (
        _c("id", "id", True), _c("coverage_name", "text", True), _c("coverage_group", "text"),
        _c("code", "text"), _c("is_policy_coverage", "bool", True),
        _c("is_vehicle_coverage", "bool", True), _c("description", "text"))),
    "policy": TableContract("policy", (
        _c("id", "id", True), _c("policy_number", "text", True),
        _c("policy_effective_date", "date", True), _c("policy_expire_date", "date", True),
        _c("payment_option", "text"), _c("total_amount", "money"), _c("active", "bool", True),
        _c("additional_info", "text"), _c("created_date", "timestamp", True)),
        unique=(("policy_number",),)),
    "vehicle": TableContract("vehicle", (
        _c("id", "id", True), _c("vin", "text", True), _c("make", "text"), _c("model", "text"),
        _c("model_year", "int"), _c("plate", "text"), _c("created_date", "timestamp", True)),
        unique=(("vin",),)),
    "policy_edit_log": TableContract("policy_edit_log", (
        _c("id", "id", True), _c("policy_id", "id", True), _c("edited_table_name", "text", True),
        _c("edited_date", "timestamp", True), _c("additional_info", "text"),
        _c("edited_by", "text", True)),
        foreign_keys=(ForeignKey("policy_id", "policy", "id"),), parents_first_rank=1),
    "bill": TableContract("bill", (
        _c("id", "id", True), _c("policy_id", "id", True), _c("due_date", "date", True),
        _c("minimum_payment", "money"), _c("created_date", "timestamp", True),
        _c("balance", "money"), _c("status", "text"), _c("payment_method", "varchar20"),
        _c("paid_date", "date")),
        foreign_keys=(ForeignKey("policy_id", "policy", "id"),), parents_first_rank=1),
    "policy_coverage": TableContract("policy_coverage", (
        _c("id", "id", True), _c("policy_id", "id", True), _c("coverage_id", "id", True),
        _c("active", "bool", True), _c("created_date", "timestamp", True)),
        foreign_keys=(ForeignKey("policy_id", "policy", "id"),
                      ForeignKey("coverage_id", "coverage", "id")), parents_first_rank=1),
    "vehicle_coverage": TableContract("vehicle_coverage", (
        _c("id", "id", True), _c("vehicle_id", "id", True), _c("coverage_id", "id", True),
        _c("active", "bool", True), _c("created_date", "timestamp", True)),
        foreign_keys=(ForeignKey("vehicle_id", "vehicle", "id"),
                      ForeignKey("coverage_id", "coverage", "id")), parents_first_rank=1),
}

# Load order: parents before children.
RELATIONAL_ORDER = sorted(RELATIONAL, key=lambda t: (RELATIONAL[t].parents_first_rank,
                                                     list(RELATIONAL).index(t)))


def contract_from_schema(name: str, schema: T.StructType, primary_key=("id",), foreign_keys=(),
                         unique=()) -> TableContract:
    """Contract for an existing table: kinds follow the Spark types."""
    by_type = {"bigint": "id", "int": "int", "string": "text", "boolean": "bool", "date": "date",
               "timestamp_ntz": "timestamp", "double": "double"}
    cols = []
    for f in schema.fields:
        t = f.dataType.simpleString()
        kind = by_type.get(t, "money" if t.startswith("decimal") else "text")
        cols.append(ColumnSpec(f.name, kind, f.name in primary_key, t))
    return TableContract(name, tuple(cols), tuple(primary_key), tuple(foreign_keys),
                         tuple(unique))
