"""Role-dependent column masking and the role/table access matrix.

A policy registry maps (table, column) to a mask expression of (value, role). ``masked`` applies
them as one projection (pure column expressions: filters on other columns still reach the scan).
``register_views_for`` registers only the views a role may read. Masking on files is a data
product, not a security boundary: anyone with file access can read the unmasked data.
"""

from __future__ import annotations

from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalars import (
    ROLE_ANALYST, ROLE_MANAGER, mask_address, mask_address_sql, mask_phone, mask_phone_sql,
)
from tessera.sources.contracts import RELATIONAL

STAGING = "stg_claims_flattened"
LANDING = "raw_claims"

# (table, column) -> mask(value, role)
POLICIES: dict[tuple[str, str], Callable[[Column, Column], Column]] = {
    (STAGING, "party_phone"): mask_phone,
    (STAGING, "party_address"): mask_address,
}

# Same policies as SQL text, for views that re-read the session role on every query.
SQL_POLICIES: dict[tuple[str, str], Callable[[str, str], str]] = {
    (STAGING, "party_phone"): mask_phone_sql,
    (STAGING, "party_address"): mask_address_sql,
}

# Role -> tables it may read. Unknown roles read nothing, and nobody reads the raw
# documents, which would bypass the masks of the flattened table.
ACCESS: dict[str, frozenset[str]] = {
    ROLE_ANALYST: frozenset({STAGING}),
    ROLE_MANAGER: frozenset({STAGING, *RELATIONAL}),
}


class AccessDenied(PermissionError):
    pass


def role_column(role: str | Column | None) -> Column:
    """A literal role, or the session variable ``active_role`` when None."""
    if role is None:
        return F.expr("active_role")
    return role if isinstance(role, Column) else F.lit(role)


def masked(df: DataFrame, table: str, role: str | Column | None = None,
           policies=None) -> DataFrame:
    policies = POLICIES if policies is None else policies
    r = role_column(role)
    cols = []
    for name in df.columns:
        mask = policies.get((table, name))
        cols.append(mask(F.col(name), r).alias(name) if mask else F.col(name))
    return df.select(*cols)


def declare_role(spark: SparkSession, role: str) -> None:
    """Set the session role read by masked views (declared on first use)."""
    try:
        spark.sql("SET VAR active_role = :role", args={"role": role})
    except AnalysisException as e:
        if e.getCondition() != "UNRESOLVED_VARIABLE":
            raise
        spark.sql("DECLARE VARIABLE active_role STRING DEFAULT NULL")
        spark.sql("SET VAR active_role = :role", args={"role": role})


def create_masked_view(spark: SparkSession, source_view: str, view: str, table: str,
                       columns: list[str]) -> None:
    """A SQL temp view over ``source_view`` whose masks read ``active_role`` at query time,
    so the same view shows different values after ``SET VAR active_role``."""
    exprs = []
    for c in columns:
        mask = SQL_POLICIES.get((table, c))
        exprs.append(f"{mask(f'`{c}`', 'active_role')} AS `{c}`" if mask else f"`{c}`")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT {', '.join(exprs)} "
              f"FROM {source_view}")


def register_views_for(spark: SparkSession, role: str, tables: dict[str, DataFrame]) -> list[str]:
    """Register masked temp views for the tables the role may read; returns their names."""
    allowed = ACCESS.get(role, frozenset())
    names = []
    for name, df in tables.items():
        if name not in allowed:
            continue
        masked(df, name, role).createOrReplaceTempView(name)
        names.append(name)
    return names


def read_as(role: str, table: str, tables: dict[str, DataFrame]) -> DataFrame:
    if table not in ACCESS.get(role, frozenset()):
        raise AccessDenied(f"role {role} may not read {table}")
    return masked(tables[table], table, role)


def access_matrix(spark: SparkSession) -> DataFrame:
    """Every role x table with whether the role may read it."""
    roles, names = [ROLE_ANALYST, ROLE_MANAGER, "ACCOUNTADMIN"], [*RELATIONAL, LANDING, STAGING]
    return spark.createDataFrame([(r, n, n in ACCESS.get(r, frozenset())) for r in roles for n in names],
                                 "role string, table_name string, allowed boolean")
