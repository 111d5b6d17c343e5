"""Derive missing dimension rows from a fact table's foreign keys.

Distinct keys of the fact (partial aggregation, so a hot key costs one row per task) anti-joined
with the existing dimension keys; each missing key gets a visible placeholder value. Re-runnable:
a second run finds nothing missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: placeholder prefix for vehicles created from orphan keys.
VIN_PLACEHOLDER_PREFIX = "VIN-PENDIENTE-"


def missing_dimension_rows(fact: DataFrame, fk: str, dim: DataFrame, pk: str, *,
                           placeholder_column: str = "vin",
                           placeholder_prefix: str = VIN_PLACEHOLDER_PREFIX,
                           created: Column | None = None) -> DataFrame:
    keys = fact.where(F.col(fk).isNotNull()).select(F.col(fk).alias(pk)).distinct()
    missing = keys.join(dim.select(pk), pk, "left_anti")
    cols = [F.col(pk), F.concat(F.lit(placeholder_prefix), F.col(pk).cast("string"))
            .alias(placeholder_column)]
    if created is not None:
        cols.append(created.alias("created_date"))
    return missing.select(*cols)
