import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions import bands, dates, numbers, text
from millrace.functions.weights import BANDS, weight_rows


def one(spark, col, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(col).first()[0]


@pytest.mark.parametrize("value", ["20250718", "2025-07-18", dt.date(2025, 7, 18), dt.datetime(2025, 7, 18, 3)])
def test_as_date(value):
    assert dates.as_date(value) == dt.date(2025, 7, 18)


def test_window_start_crosses_year():
    assert dates.window_start("2024-01-03", 7) == dt.date(2023, 12, 28)


def test_epoch_helpers(spark):
    assert one(spark, dates.millis_to_text(F.col("x"), "GMT+8"), x=1752710400000) == "2025-07-17 08:00:00"
    assert one(spark, dates.epoch_day_to_date(F.col("x")), x=31) == dt.date(1970, 2, 1)
    assert one(spark, dates.repair_iso_text(F.col("x")), x="2025-07-18T09:30:00Z") == "2025-07-18 09:30:00"


def test_age_is_completed_years(spark):
    b = F.to_date(F.col("x"))
    assert one(spark, dates.age_years(b, "2024-05-10"), x="2000-05-10") == 24
    assert one(spark, dates.age_years(b, "2024-05-09"), x="2000-05-10") == 23


@pytest.mark.parametrize("a,b,want", [("2025-08-11 10:00:00", "2025-08-12 10:00:00", 0), ("2025-08-09 10:00:00", "2025-08-09 10:00:00", 1),
                                      ("2025-08-11 00:00:00", "2025-08-18 00:00:00", 1)])
def test_spans_weekend(spark, a, b, want):
    assert one(spark, dates.spans_weekend(F.to_timestamp("a"), F.to_timestamp("b")), a=a, b=b) == want


def test_ratio_rounds_half_up_once(spark):
    assert one(spark, numbers.ratio(F.col("a"), F.col("b"), 2), a=29, b=200) == Decimal("0.15")
    assert one(spark, numbers.ratio(F.col("a"), F.col("b"), 4), a=1234499, b=10000000) == Decimal("0.1234")
    assert one(spark, numbers.ratio(F.col("a"), F.col("b"), 2), a=1, b=0) is None
    assert one(spark, numbers.money_ratio(F.col("a"), F.col("b"), 2), a=-0.25, b=10.0) == Decimal("-0.03")


def test_masking(spark):
    assert one(spark, text.masked_phone(F.col("x")), x="12312345678") is None
    assert len(one(spark, text.masked_phone(F.col("x")), x="13812345678")) == 32
    assert one(spark, text.masked_email(F.col("x")), x="no mail") is None
    assert one(spark, text.masked_name(F.col("x")), x="王小明") == "王*"


def test_hash_bucket_pins_hot_keys(spark):
    col = text.hash_bucket(F.col("x"), pinned={"hot": 2})
    assert one(spark, col, x="hot") == "9003"
    assert one(spark, col, x="a").isdigit() and int(one(spark, col, x="a")) < 128


def test_bands(spark):
    df = spark.createDataFrame([(24,), (25,), (54,), (55,), (None,)], "age int")
    got = [tuple(r) for r in df.select(bands.age_group(F.col("age")), bands.age_group(F.col("age"), False)).collect()]
    assert got == [("18-24",) * 2, ("25-34",) * 2, ("45-54",) * 2, ("55+",) * 2, ("55+", None)]
    spend = spark.createDataFrame([(Decimal("999.99"),), (Decimal("1000"),), (Decimal("4000"),), (Decimal("4000.01"),)], "a decimal(10,2)")
    assert [r[0] for r in spend.select(bands.spending_power(F.col("a"))).collect()] == ["low", "mid", "mid", "high"]
    z = spark.createDataFrame([("2000-01-19",), ("2000-01-20",), ("2000-12-22",), ("2000-12-21",)], "d string")
    assert [r[0] for r in z.select(bands.zodiac(F.to_date("d"))).collect()] == ["摩羯座", "水瓶座", "摩羯座", "射手座"]
    h = spark.createDataFrame([("2000-01-01 05:59:59",), ("2000-01-01 06:00:00",), ("2000-01-01 22:00:00",)], "t string")
    assert [r[0] for r in h.select(bands.day_slot(F.to_timestamp("t"))).collect()] == ["凌晨", "早晨", "夜间"]


def test_weight_rows_are_complete():
    per_key = {}
    for model, key, band, *_ in weight_rows():
        per_key.setdefault((model, key), []).append(band)
    assert all(b == BANDS for b in per_key.values())
    assert len(per_key) == 2 + 7 + 7 + 3 + 7 + 14
