import pytest
from pyspark.sql import functions as F

from tessera.functions import scalars as S


def one(spark, expr, schema="s string", value=("x",)):
    return spark.createDataFrame([value], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("true", True), ("1", True), ("t", True), ("yes", True), ("  TRUE ", True), (" Yes", True),
    ("false", False), ("no", False), ("verdadero", False), ("", None), (None, None)])
def test_parse_bool(spark, text, expected):
    assert one(spark, S.parse_bool("s"), value=(text,)) == expected


def test_text_int_decimal(spark):
    df = spark.createDataFrame([("", "", ""), ("7", "2.345", "a")], "i string, d string, t string")
    rows = df.select(S.parse_int("i").alias("i"), S.parse_decimal("d").alias("d"),
                     S.parse_text("t").alias("t")).collect()
    assert rows[0] == (None, None, None)
    assert rows[1]["i"] == 7 and str(rows[1]["d"]) == "2.35" and rows[1]["t"] == "a"


def test_timestamp_and_date_prefix(spark):
    df = spark.createDataFrame([("2026-08-08T10:11:12.123456789Z", "2026-08-08T00:00:00")],
                               "ts string, d string")
    r = df.select(S.parse_timestamp("ts").alias("ts"), S.parse_date("d").alias("d")).first()
    assert str(r["ts"]) == "2026-08-08 10:11:12.123456" and str(r["d"]) == "2026-08-08"


def test_timestamp_null_fails(spark):
    df = spark.createDataFrame([(None,)], "ts string")
    with pytest.raises(Exception):
        df.select(S.parse_timestamp("ts")).collect()


@pytest.mark.parametrize("days,rate", [(-3, "0.000"), (0, "0.000"), (15, "0.020"), (16, "0.050"),
                                       (30, "0.050"), (31, "0.100"), (283, "0.100")])
def test_late_fee_bands(spark, days, rate):
    df = spark.createDataFrame([(days, 100)], "d int, b int")
    assert str(df.select(S.late_fee_rate("d", F.col("b").cast("decimal(10,2)"))).first()[0]) == rate


def test_late_fee_null_checked_before_negative(spark):
    df = spark.createDataFrame([(None, -5), (3, None)], "d int, b int")
    rows = df.select(S.late_fee_rate("d", F.col("b").cast("decimal(10,2)"))).collect()
    assert [r[0] for r in rows] == [None, None]


def test_late_fee_negative_balance_raises(spark):
    df = spark.createDataFrame([(3, -5)], "d int, b int")
    with pytest.raises(Exception, match="negative"):
        df.select(S.late_fee_rate("d", F.col("b").cast("decimal(10,2)"))).collect()


def test_late_fee_sql_function_matches(spark):
    S.register_sql_functions(spark)
    got = [str(r[0]) for r in spark.sql(
        "SELECT fn_calculate_late_fee(d, 10.00) FROM VALUES (0),(15),(16),(31),(283) AS t(d)").collect()]
    assert got == ["0.000", "0.020", "0.050", "0.100", "0.100"]
    assert spark.sql("SELECT fn_calculate_late_fee(NULL, -1.00)").first()[0] is None


def test_masks_golden(spark):
    phone = "+57-399-555-0142"
    df = spark.createDataFrame([(phone, "Calle 1"), (None, None)], "p string, a string")

    def masked(role):
        return [(r[0], r[1]) for r in df.select(S.mask_phone("p", F.lit(role)),
                                                S.mask_address("a", F.lit(role))).collect()]
    assert masked(S.ROLE_ANALYST) == [(phone, "Calle 1"), (None, None)]
    assert masked(S.ROLE_MANAGER) == [("+57-399-***-****", S.ADDRESS_HIDDEN),
                                      (None, S.ADDRESS_HIDDEN)]
    assert masked("ACCOUNTADMIN") == [("+**-***-***-****", S.ADDRESS_HIDDEN),
                                      ("+**-***-***-****", S.ADDRESS_HIDDEN)]
