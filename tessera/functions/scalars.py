"""Scalar column expressions (all JVM-side built-ins, no Python per row).

Conversions of text fields used by seed and CSV loads, the late-fee rate and the role masks.
Each function returns a ``Column`` so it can be combined freely in ``select``/``where`` and is
folded, code-generated and pushed like any other built-in expression.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Spellings that count as TRUE when converting text to boolean (after trim + lower case);
# any other non-empty text is FALSE.
TRUE_SPELLINGS = ("true", "1", "t", "yes")
# Late-fee bands: (upper bound of days late, inclusive) -> rate; beyond the last bound 0.100.
LATE_FEE_BANDS = ((0, "0.000"), (15, "0.020"), (30, "0.050"))
LATE_FEE_MAX_RATE = "0.100"
# Role names and mask texts of the column-masking policies.
ROLE_ANALYST = "ROLE_ANALISTA_SINIESTROS"
ROLE_MANAGER = "ROLE_GERENTE_COMERCIAL"
PHONE_PREFIX_CHARS = 7
PHONE_MANAGER_SUFFIX = "-***-****"
PHONE_HIDDEN = "+**-***-***-****"
ADDRESS_HIDDEN = "*** direccion protegida ***"
# ---------------------------------------------------------------------------------------------

RATE_TYPE = "decimal(4,3)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_text(c) -> Column:
    """'' -> NULL, anything else unchanged."""
    return F.nullif(_col(c), F.lit(""))


def parse_int(c, type_: str = "bigint") -> Column:
    """NULL/'' -> NULL, else a strict integer cast (bad text raises under ANSI)."""
    return parse_text(c).cast(type_)


def parse_decimal(c, type_: str = "decimal(10,2)") -> Column:
    """NULL/'' -> NULL, else a strict decimal cast (rounds half away from zero)."""
    return parse_text(c).cast(type_)


def parse_bool(c) -> Column:
    """NULL/'' -> NULL; trimmed lower-case text in TRUE_SPELLINGS -> TRUE; anything else FALSE."""
    text = parse_text(c)
    return F.when(text.isNull(), F.lit(None).cast("boolean")).otherwise(
        F.lower(F.trim(text)).isin(*TRUE_SPELLINGS))


def parse_timestamp(c) -> Column:
    """First 26 characters as an ISO timestamp without zone. NULL input is an error."""
    s = _col(c)
    return F.when(s.isNull(), F.raise_error(F.lit("timestamp value is NULL"))).otherwise(
        F.substring(s, 1, 26).cast("timestamp_ntz"))


def parse_date(c) -> Column:
    """First 10 characters as an ISO date. NULL input is an error."""
    s = _col(c)
    return F.when(s.isNull(), F.raise_error(F.lit("date value is NULL"))).otherwise(
        F.to_date(F.substring(s, 1, 10), "yyyy-MM-dd"))


def late_fee_rate(days, balance) -> Column:
    """Late-fee rate for a bill: NULL days or balance -> NULL (checked first); a negative
    balance raises; otherwise the rate of the band the days fall in."""
    d, b = _col(days), _col(balance)
    banded = F.when(d <= LATE_FEE_BANDS[0][0], F.lit(LATE_FEE_BANDS[0][1]).cast(RATE_TYPE))
    for bound, rate in LATE_FEE_BANDS[1:]:
        banded = banded.when(d <= bound, F.lit(rate).cast(RATE_TYPE))
    banded = banded.otherwise(F.lit(LATE_FEE_MAX_RATE).cast(RATE_TYPE))
    return (F.when(d.isNull() | b.isNull(), F.lit(None).cast(RATE_TYPE))
            .when(b < 0, F.raise_error(F.format_string(
                "bill balance cannot be negative (got %s)", b.cast("string"))).cast(RATE_TYPE))
            .otherwise(banded))


def mask_phone(c, role) -> Column:
    """Analyst: full value; manager: first 7 characters + fixed suffix (NULL stays NULL);
    every other role: a constant, even for NULL (closed default)."""
    v, r = _col(c), _col(role)
    return (F.when(r == ROLE_ANALYST, v)
            .when(r == ROLE_MANAGER,
                  F.concat(F.substring(v, 1, PHONE_PREFIX_CHARS), F.lit(PHONE_MANAGER_SUFFIX)))
            .otherwise(F.lit(PHONE_HIDDEN)))


def mask_address(c, role) -> Column:
    """Analyst: full value; every other role: a constant."""
    v, r = _col(c), _col(role)
    return F.when(r == ROLE_ANALYST, v).otherwise(F.lit(ADDRESS_HIDDEN))


def mask_phone_sql(c: str, role: str) -> str:
    """SQL text of ``mask_phone`` (for views that must re-read a session variable)."""
    return (f"CASE WHEN {role} = '{ROLE_ANALYST}' THEN {c} "
            f"WHEN {role} = '{ROLE_MANAGER}' THEN concat(substring({c}, 1, {PHONE_PREFIX_CHARS}), "
            f"'{PHONE_MANAGER_SUFFIX}') ELSE '{PHONE_HIDDEN}' END")


def mask_address_sql(c: str, role: str) -> str:
    return f"CASE WHEN {role} = '{ROLE_ANALYST}' THEN {c} ELSE '{ADDRESS_HIDDEN}' END"


def late_fee_sql_body() -> str:
    bands = " ".join(f"WHEN days <= {bound} THEN CAST({rate} AS {RATE_TYPE})"
                     for bound, rate in LATE_FEE_BANDS)
    return (f"CASE WHEN days IS NULL OR balance IS NULL THEN CAST(NULL AS {RATE_TYPE}) "
            f"WHEN balance < 0 THEN CAST(raise_error(concat('bill balance cannot be negative "
            f"(got ', CAST(balance AS STRING), ')')) AS {RATE_TYPE}) "
            f"{bands} ELSE CAST({LATE_FEE_MAX_RATE} AS {RATE_TYPE}) END")


def register_sql_functions(spark: SparkSession) -> None:
    """Register the late-fee rate as a SQL function (inlined by the analyzer, no Python)."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION fn_calculate_late_fee(days INT, balance DECIMAL(12,2)) "
        f"RETURNS {RATE_TYPE.upper()} RETURN {late_fee_sql_body()}")
