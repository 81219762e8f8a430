"""Column functions: hand tables of (input, expected) from FIXTURES.md."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import (boolish_to_int, clean_amount, country_iso2, country_name, event_ts_fallback,
                                  ipv4_to_long, is_international, merchant_struct, parse_event_ts, risk_bucket)
from ledgerlens.functions.hashing import stable_bucket


def _one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


def test_parse_event_ts(spark):
    cases = {
        "1700000000": dt.datetime(2023, 11, 14, 22, 13, 20),
        "1700000000123": dt.datetime(2023, 11, 14, 22, 13, 20, 123000),
        "25/02/2026 10:00:01": dt.datetime(2026, 2, 25, 10, 0, 1),
        "2026-02-25T10:00:00Z": dt.datetime(2026, 2, 25, 10, 0, 0),
        "nope": None, "": None, None: None, "9" * 20: None, "99999999999999999": None,
    }
    df = _one_col(spark, list(cases))
    got = {r.x: r.t for r in df.select("x", parse_event_ts(F.col("x")).cast("timestamp_ntz").alias("t")).collect()}
    assert got == cases


def test_event_ts_fallback_and_absent_columns(spark):
    df = spark.createDataFrame([("nope", "2024-01-02 03:04:05"), (None, None)], "event_ts string, event_time string")
    got = [r.t for r in df.select(event_ts_fallback(df).cast("timestamp_ntz").alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), None]
    empty = spark.createDataFrame([(1,)], "a int")
    try:
        event_ts_fallback(empty)
        raise AssertionError("expected an error without time columns")
    except ValueError:
        pass


def test_clean_amount(spark):
    cases = [("R$ 1.234,56", 1234.56, 1234.56), ("12,5", 12.5, 12.5), ("1.234", 1.234, 1.234),
             ("-5", -5.0, -5.0), ("abc", None, None), ("", None, None), ("1.2.3", None, None),
             ("1,234.56", 1234.56, 1.23456), (None, None, None)]
    df = _one_col(spark, [c[0] for c in cases])
    rows = df.select("x", clean_amount(F.col("x")).alias("a"), clean_amount(F.col("x"), strict=True).alias("s")).collect()
    got = {r.x: (r.a, r.s) for r in rows}
    for raw, loose, strict in cases:
        assert got[raw] == (loose, strict), raw


def test_country_iso2(spark):
    df = spark.createDataFrame([(" br ", None), ("N/A", None), ("UNK", None), ("UNKNOWN", None), ("NULL", None),
                                ("", "US"), ("BRAZIL", None), (None, "ar")], "country string, country_code string")
    rows = df.select(country_iso2(df).alias("a"), country_iso2(df, strict=True).alias("s")).collect()
    assert [r.a for r in rows] == ["BR", None, None, None, None, "US", None, "AR"]
    assert [r.s for r in rows] == ["BR", None, None, None, None, None, None, "AR"]
    assert country_iso2(spark.createDataFrame([(1,)], "z int")) is not None


def test_boolish_and_international(spark):
    truthy, falsy, other = ["true", "1", "yes", "Y", "t"], ["false", "0", "no", "N", "f"], ["1.0", "maybe", None]
    df = _one_col(spark, truthy + falsy + other)
    rows = df.select(boolish_to_int(F.col("x")).alias("b"), is_international(F.col("x")).alias("i")).collect()
    assert [r.b for r in rows] == [1] * 5 + [0] * 5 + [None] * 3
    assert [r.i for r in rows] == [1] * 5 + [0] * 8


def test_country_name(spark):
    df = _one_col(spark, ["BR", "US", "GB", "AR", "XX", None])
    got = [r.n for r in df.select(country_name(F.col("x")).alias("n")).collect()]
    assert got == ["Brazil", "United States", "United Kingdom", "Argentina", None, None]


def test_merchant_struct_text_and_struct(spark):
    df = _one_col(spark, ['{"city":"SP","country":"BR","mcc":"5411","merchant_id":"m1"}', "m1", None])
    rows = df.withColumnRenamed("x", "merchant").select(merchant_struct(
        df.withColumnRenamed("x", "merchant")).alias("m")).collect()
    assert rows[0].m.asDict() == {"city": "SP", "country": "BR", "mcc": "5411", "merchant_id": "m1"}
    assert rows[1].m is None and rows[2].m is None
    sdf = spark.createDataFrame([(("Rio", "m9"),)], "merchant struct<city:string, merchant_id:string>")
    m = sdf.select(merchant_struct(sdf).alias("m")).first().m
    assert m.city == "Rio" and m.merchant_id == "m9" and m.mcc is None
    assert spark.createDataFrame([(1,)], "a int").select(merchant_struct(
        spark.createDataFrame([(1,)], "a int")).alias("m")).first().m is None


def test_ipv4_to_long(spark):
    cases = {"1.0.0.0": 16777216, "39.255.255.255": 671088639, "40.0.0.0": 671088640, "0.0.0.1": 1,
             "140.0.0.0": 2348810240, "256.1.1.1": None, "abc": None, "": None, None: None, "::1": None,
             "1.2.3": None}
    df = _one_col(spark, list(cases))
    got = {r.x: r.n for r in df.select("x", ipv4_to_long(F.col("x")).alias("n")).collect()}
    assert got == cases


def test_risk_bucket(spark):
    df = _one_col(spark, [0.0, 0.39, 0.40, 0.75, 0.76, None], "double")
    assert [r.b for r in df.select(risk_bucket(F.col("x")).alias("b")).collect()] == \
        ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", None]


def test_stable_bucket_matches_md5_prefix(spark):
    import hashlib
    keys = [f"evt_{i}" for i in range(50)]
    df = _one_col(spark, keys)
    got = {r.x: r.b for r in df.select("x", stable_bucket(F.col("x"), 3).alias("b")).collect()}
    for k in keys:
        assert got[k] == int(hashlib.md5(k.encode()).hexdigest()[:8], 16) % 3
