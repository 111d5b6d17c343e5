from tessera.functions.scalars import (
    late_fee_rate,
    mask_address,
    mask_phone,
    parse_bool,
    parse_date,
    parse_decimal,
    parse_int,
    parse_text,
    parse_timestamp,
    register_sql_functions,
)

__all__ = [
    "late_fee_rate", "mask_address", "mask_phone", "parse_bool", "parse_date", "parse_decimal",
    "parse_int", "parse_text", "parse_timestamp", "register_sql_functions",
]
