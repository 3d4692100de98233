from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyfold.functions import cleaning as c
from tallyfold.operators.clean import (mask_customers, normalise_names, standardise_customers,
                                       standardise_transactions)


def one(spark, column, schema="v string", value=None):
    return spark.createDataFrame([(value,)], schema).select(column.alias("r")).first().r


def test_text(spark):
    assert one(spark, c.squeezed_lower(F.col("v")), value="  Ab@C ") == "ab@c"
    assert one(spark, c.squeezed_lower(F.col("v")), value="\tA ") == "\ta"
    assert one(spark, c.ascii_digits(F.col("v")), value="+212 (0)6-٣") == "21206"
    assert one(spark, c.squeezed_upper(F.col("v")), value=" ma ") == "MA"
    assert one(spark, c.joined_name(F.lit(None), F.lit("B"))) == "B"
    assert one(spark, c.joined_name(F.lit(None), F.lit(None))) == ""


@pytest.mark.parametrize("value, want", [("active", 1), ("Active", 0), (None, 0)])
def test_flag(spark, value, want):
    assert one(spark, c.flag(F.col("v") == "active"), value=value) == want


@pytest.mark.parametrize("value, want", [("2025-10-14", date(2025, 10, 14)), ("2025-13-01", None),
                                         ("2025-10-14 10:00:00", None), ("x", None), (None, None)])
def test_lenient_day(spark, value, want):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(c.lenient_day(F.col("v"), df.schema["v"].dataType)).first()[0] == want


def test_lenient_day_of_timestamp(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 2, 3),)], "v timestamp")
    assert df.select(c.lenient_day(F.col("v"), df.schema["v"].dataType)).first()[0] == date(2025, 1, 2)


@pytest.mark.parametrize("value, dtype, default, want", [("1.5", "int", -1, -1), ("7", "int", -1, 7), (None, "int", 3, 3),
                                                         ("x", "double", 0.5, 0.5), ("2", "double", 0.5, 2.0)])
def test_cast_or(spark, value, dtype, default, want):
    assert one(spark, c.cast_or(F.col("v"), dtype, default), value=value) == want


def test_dates(spark):
    df = spark.sql("select date'2025-03-01' d, timestamp'2025-07-01 12:00:05' t")
    row = df.select(c.days_before(F.col("d")).alias("y"), c.days_before(F.col("d"), 30).alias("m"),
                    c.iso_text(F.col("t")).alias("u"), c.iso_text(F.col("t"), "Asia/Tokyo").alias("z")).first()
    assert (row.y, row.m) == (date(2025, 2, 28), date(2025, 1, 30))
    assert (row.u, row.z) == ("2025-07-01T12:00:05", "2025-07-01T21:00:05")


def test_transactions(spark):
    rows = [("t1", "2025-10-14", "12.5", " usd "), ("t2", "bad", "abc", None), ("t3", None, "-1", "eur"), ("t4", None, "0", "x")]
    df = standardise_transactions(spark.createDataFrame(rows, "transaction_id string, transaction_date string, amount string, currency string"))
    got = {r.transaction_id: (r.amount, r.currency, r.is_valid) for r in df.collect()}
    assert got == {"t1": (12.5, "USD", True), "t2": (None, None, False), "t3": (-1.0, "EUR", False), "t4": (0.0, "X", False)}


def test_customers_and_masks(spark):
    rows = [("1", " A@B.c ", "+1 2", " fr", "active", "A", None)]
    df = standardise_customers(spark.createDataFrame(rows, "customer_id string, email string, phone string, country string, "
                                                           "status string, first_name string, last_name string"))
    row = df.first()
    assert (row.email, row.phone, row.country, row.is_active, row.full_name) == ("a@b.c", "12", "FR", 1, "A")
    masked = mask_customers(df).first()
    assert masked.phone == "nn" and len(masked.email) == 64


def test_names(spark):
    assert normalise_names(spark.createDataFrame([(1, 2)], "`A b-C` int, d int")).columns == ["a_b_c", "d"]
    with pytest.raises(ValueError):
        normalise_names(spark.createDataFrame([(1, 2)], "`A b` int, a_b int"))
