"""Flatten nested documents held as VARIANT: one output row per array item.

``flatten`` is a projection plus a generator (``explode``/``explode_outer``) inside one stage: no
shuffle, and only the referenced variant paths are read. The outer form keeps one row of NULL
item fields for an empty, absent or JSON-null array, so landing and staging reconcile.

All fields are taken directly from the document's column, below the generator: document fields once
a document, and the items as one typed array, which a Parquet landing reads from its columns. Only
where the typed item has a NULL is the path looked up in the item's VARIANT, which tells an absent
value from one of the wrong type and takes items that are no objects.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    name: str   # output column
    path: str   # JSON path inside the document / item, e.g. "$.claim_id"
    type: str   # Spark type of the strict cast


@dataclass(frozen=True)
class DocumentSpec:
    doc_fields: tuple[Field, ...]
    array_path: str
    item_fields: tuple[Field, ...]


# Claim documents: claim fields + one row per involved party.
CLAIM_SPEC = DocumentSpec(
    doc_fields=(
        Field("claim_id", "$.claim_id", "string"),
        Field("policy_number", "$.policy_number", "string"),
        Field("vin", "$.vin", "string"),
        Field("reported_at", "$.reported_at", "timestamp_ntz"),
        Field("incident_type", "$.incident_type", "string"),
        Field("estimated_damage_usd", "$.estimated_damage_usd", "double"),
        Field("assigned_workshop", "$.assigned_workshop", "string"),
    ),
    array_path="$.involved_parties",
    item_fields=(
        Field("party_name", "$.name", "string"),
        Field("party_role", "$.role", "string"),
        Field("party_phone", "$.phone", "string"),
        Field("party_address", "$.personal_address", "string"),
        Field("party_email", "$.email", "string"),
    ),
)

# Repair-claim documents: adjuster struct with an optional key, repair lines.
REPAIR_SPEC = DocumentSpec(
    doc_fields=(
        Field("claim_id", "$.claim_id", "string"),
        Field("policy_number", "$.policy_number", "string"),
        Field("reported_at", "$.reported_at", "timestamp_ntz"),
        Field("claim_type", "$.claim_type", "string"),
        Field("status", "$.status", "string"),
        Field("adjuster_email", "$.adjuster.email", "string"),
        Field("adjuster_agency", "$.adjuster.agency", "string"),
        Field("estimated_total_cost", "$.estimated_total_cost", "decimal(12,2)"),
    ),
    array_path="$.repair_line_items",
    item_fields=(
        Field("part", "$.part", "string"),
        Field("damage_severity", "$.damage_severity", "string"),
        Field("labor_hours", "$.labor_hours", "double"),
        Field("estimated_cost", "$.estimated_cost", "decimal(12,2)"),
    ),
)


def _get(v: Column, f: Field, strict: bool) -> Column:
    fn = F.variant_get if strict else F.try_variant_get
    return fn(v, f.path, f.type).alias(f.name)


def _key(f: Field) -> str | None:
    """The item's own key that the path names, if it is no deeper path."""
    simple = re.fullmatch(r"\$\.([A-Za-z_]\w*)", f.path)
    return simple[1] if simple else None


def _typed_fields(fields: tuple[Field, ...]) -> list[Field]:
    """Fields that one typed reading of an item can give: scalars under a key of its own, one for each key."""
    first: dict[str, Field] = {}
    for f in fields:
        if _key(f) and "<" not in f.type and f.type != "variant":
            first.setdefault(_key(f).lower(), f)
    return list(first.values())


def project_document(landing: DataFrame, spec: DocumentSpec, column: str = "raw",
                     strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Document-level typed columns (one row per document). Absent paths give NULL; a value of
    the wrong type raises when ``strict`` (bad data stops the job, as a strict cast should)."""
    v = F.col(column)
    return landing.select(*[_get(v, f, strict) for f in spec.doc_fields], *keep)


def flatten(landing: DataFrame, spec: DocumentSpec, *, column: str = "raw", outer: bool = True,
            strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (document, array item). ``outer`` keeps documents with no items."""
    v = F.col(column)
    explode = F.explode_outer if outer else F.explode
    docs = [_get(v, f, strict) for f in spec.doc_fields]
    names = [f.name for f in spec.doc_fields]
    # An inner flatten looks only at the fields of documents that have items.
    below, carried, above = (docs, names, names) if outer else ([v], [column], docs)
    typed = _typed_fields(spec.item_fields)
    item_type = ", ".join(f"`{_key(f)}`: {f.type}" for f in typed) or "_none: boolean"
    items = F.variant_get(v, spec.array_path, "array<variant>").alias("_raw")
    values = F.try_variant_get(v, spec.array_path, f"array<struct<{item_type}>>").alias("_typed")
    # The zip pads the shorter array: there is a row for each item, whatever its typed reading gave.
    pairs = F.arrays_zip("_raw", F.coalesce("_typed", F.array().cast(f"array<struct<{item_type}>>")).alias("_typed"))
    exploded = (landing.select(*below, *keep, items, values)
                .select(*carried, *keep, explode(pairs).alias("_item")))
    raw, value = F.col("_item")["_raw"], F.col("_item")["_typed"]

    def field(f: Field) -> Column:
        looked_up = _get(raw, f, strict)
        return F.coalesce(value[_key(f)], looked_up).alias(f.name) if f in typed else looked_up

    return exploded.select(*above, *keep, *[field(f) for f in spec.item_fields])


def with_flattened_at(staged: DataFrame) -> DataFrame:
    """Staging rows carry the time they were flattened (a default-valued column)."""
    return staged.withColumn("_flattened_at", F.current_timestamp().cast("timestamp_ntz"))


def expected_flatten_rows(landing: DataFrame, spec: DocumentSpec, column: str = "raw") -> Column:
    """Per-document number of rows the outer flatten must produce: max(1, array size)."""
    n = F.size(F.variant_get(F.col(column), spec.array_path, "array<variant>"))
    return F.greatest(F.coalesce(F.when(n >= 0, n), F.lit(0)), F.lit(1))


def reconcile(landing: DataFrame, staged: DataFrame, spec: DocumentSpec, key: str,
              column: str = "raw") -> DataFrame:
    """One row: distinct keys landed, documents, rows staged, rows expected (sum of
    max(1, array size)) and landed keys missing from staging.

    Both sides are tagged and unioned, counted per key (partial aggregation before the one
    shuffle, so a hot key costs one row per task), then summed to a single row."""
    key_field = next(f for f in spec.doc_fields if f.name == key)
    land = landing.select(
        F.variant_get(F.col(column), key_field.path, key_field.type).alias(key),
        F.lit(1).alias("_doc"), expected_flatten_rows(landing, spec, column).alias("_exp"),
        F.lit(0).alias("_stg"))
    stg = staged.select(F.col(key), F.lit(0).alias("_doc"), F.lit(0).alias("_exp"),
                        F.lit(1).alias("_stg"))
    per_key = land.unionByName(stg).groupBy(key).agg(
        F.sum("_doc").alias("docs"), F.sum("_exp").alias("exp"), F.sum("_stg").alias("stg"))
    return per_key.agg(
        F.count_if(F.col("docs") > 0).alias("claims"),
        F.sum("docs").alias("documents"),
        F.sum("stg").alias("staged_rows"),
        F.sum("exp").alias("expected_rows"),
        F.count_if((F.col("docs") > 0) & (F.col("stg") == 0)).alias("missing_keys"),
    ).withColumn("ok", (F.col("staged_rows") == F.col("expected_rows"))
                 & (F.col("missing_keys") == 0))


def one_row_per_key(staged: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Undo the fan-out of a flatten: one row per document key. A key that was exported more than
    once keeps its newest version (by load time, then source path, then the values), whole: all
    columns come from one row. Map-side partial aggregation collapses the fan-out."""
    version = [c for c in ("_loaded_at", "_source_path") if c in staged.columns]
    newest = F.max(F.struct(*version, *columns)).alias("_newest")
    return staged.groupBy(key).agg(newest).select(key, *[F.col("_newest")[c].alias(c) for c in columns])


def line_total_offenders(docs: DataFrame, lines: DataFrame, key: str, total: str, cost: str,
                         tolerance: str = "0.005") -> DataFrame:
    """Documents whose declared total differs from the sum of their item costs (by more than
    the tolerance). Items are summed per key first (partial aggregation), then joined 1:1."""
    sums = lines.groupBy(key).agg(F.sum(F.col(cost).cast("decimal(18,2)")).alias("line_sum"))
    j = docs.select(key, F.col(total).cast("decimal(18,2)").alias("total")).join(sums, key, "left")
    j = j.withColumn("line_sum", F.coalesce("line_sum", F.lit(0).cast("decimal(28,2)")))
    return j.where(F.abs(F.col("total") - F.col("line_sum")) > F.lit(tolerance).cast("decimal(4,3)"))
