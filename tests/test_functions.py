from __future__ import annotations

import datetime
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tiffin.functions.dates import as_of_date, month_start, whole_days
from tiffin.functions.numeric import avg2, mean_of, pct, pct_amount
from tiffin.functions.text import initcap_words


def _exact(numerator: int, denominator: int) -> Decimal:
    """Half away from zero to two decimals, in whole numbers."""
    hundredths = Fraction(numerator * 100, denominator)
    return Decimal(int(hundredths + Fraction(1, 2))) / 100


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("new-delhi o'brien  st.louis 3rd", "New-Delhi O'Brien  St.Louis 3rd"),
        ("MIXED cAsE", "Mixed Case"),
        ("élan vital", "Élan Vital"),
        ("a1b2 c_d", "A1b2 C_D"),
        ("straße ßx", "Straße ßx"),
        ("  --  ", "  --  "),
        ("", ""),
        (None, None),
    ],
)
def test_initcap_words(spark, text, expected):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(initcap_words(F.col("x"))).first()[0] == expected


def test_pct_is_exact(spark):
    pairs = [(201, 20000), (1, 3), (2, 3), (1, 8), (0, 7), (7, 7), (999_999_999_999, 10**12 + 7)]
    df = spark.createDataFrame(pairs, "k bigint, n bigint")
    got = [r[0] for r in df.select(pct(F.col("k"), F.col("n"))).collect()]
    assert got == [_exact(100 * k, n) for k, n in pairs]


def test_share_of_nothing_is_null(spark):
    df = spark.createDataFrame([(0, 0)], "k bigint, n bigint")
    k, n = F.col("k"), F.col("n")
    assert df.select(pct(k, n), pct_amount(k, n), mean_of(k, n)).first()[:] == (None, None, None)


def test_avg2_rounds_once(spark):
    """The mean is 4.1249998: rounding to 4 more digits first would lift it to 4.13."""
    low, high = Decimal("4.12"), Decimal("4.13")
    df = spark.range(2_500_001).select(
        F.when(F.col("id") < 1_250_001, F.lit(low)).otherwise(F.lit(high)).alias("x")
    )
    assert df.agg(avg2(F.col("x"))).first()[0] == low
    assert df.agg(F.round(F.avg("x"), 2)).first()[0] == high


def test_avg2_skips_nulls_and_is_null_on_nothing(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x bigint")
    assert df.agg(avg2(F.col("x"))).first()[0] == Decimal("1.50")
    assert df.filter("false").agg(avg2(F.col("x"))).first()[0] is None


@pytest.mark.parametrize(
    ("later", "earlier", "days"),
    [
        ("2024-03-02 00:00:00", "2024-03-01 23:00:00", 0),  # another day, yet one hour
        ("2024-03-02 23:00:00", "2024-03-01 23:00:00", 1),
        ("2024-03-01 00:00:00", "2024-03-01 01:00:00", 0),
        ("2024-03-01 00:00:00", "2024-03-03 01:00:00", -2),
        ("2024-04-01 00:00:00", "2024-03-30 00:00:00", 2),
    ],
)
def test_whole_days(spark, later, earlier, days):
    df = spark.createDataFrame([(later, earlier)], "a string, b string")
    a, b = F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")
    assert df.select(whole_days(a, b)).first()[0] == days


def test_dates_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # Clocks go forward on the 10th: a day of 23 hours there, of 24 without a zone.
        df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 00:00:00' AS a, DATE '2024-03-31' AS d")
        row = df.select(
            whole_days(as_of_date("2024-03-11"), F.col("a")), month_start(F.col("d"))
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row[:] == (1, datetime.datetime(2024, 3, 1))
