"""Rounding, dates and value maps on hand-made values."""

import datetime as dt
from decimal import Decimal


from ledgerline.functions.cleaning import canonicalize_values, mapped
from ledgerline.functions.dates import add_months_clamped, day_diff
from ledgerline.functions.ratios import avg_half_up, money_avg_half_up, pct_half_up, ratio_half_up


def test_pct_half_up_ties_and_zero(spark):
    df = spark.createDataFrame([(1, 16), (3, 16), (0, 0), (None, 5), (5, None), (2, 3)], "n long, d long")
    got = [r[0] for r in df.select(pct_half_up("n", "d", 1)).collect()]
    # 1/16 = 6.25 -> 6.3, 3/16 = 18.75 -> 18.8, 2/3 = 66.666.. -> 66.7
    assert got == [6.3, 18.8, None, None, None, 66.7]


def test_ratio_negative_rounds_away_from_zero(spark):
    df = spark.createDataFrame([(-5, 2), (5, -2), (-1, 4)], "n long, d long")
    got = [r[0] for r in df.select(ratio_half_up("n", "d", 0)).collect()]
    assert got == [-3.0, -3.0, -0.0]
    got = [r[0] for r in df.select(avg_half_up("n", "d", 1)).collect()]
    assert got == [-2.5, -2.5, -0.3]


def test_money_average_cents(spark):
    df = spark.createDataFrame([(1001, 2), (1, 3), (0, 0)], "c long, n long")
    got = [r[0] for r in df.select(money_avg_half_up("c", "n")).collect()]
    assert got == [Decimal("5.01"), Decimal("0.00"), None]


def test_add_months_clamps_day(spark):
    days = [dt.date(2024, 2, 29), dt.date(2024, 1, 31), dt.date(2023, 12, 30), dt.date(2023, 5, 15)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(add_months_clamped("d", 12)).collect()]
    assert got == [dt.date(2025, 2, 28), dt.date(2025, 1, 28), dt.date(2024, 12, 28), dt.date(2024, 5, 15)]
    got = [r[0] for r in df.select(add_months_clamped("d", -2)).collect()]
    assert got == [dt.date(2023, 12, 28), dt.date(2023, 11, 28), dt.date(2023, 10, 28), dt.date(2023, 3, 15)]


def test_day_diff_is_int(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 1), dt.date(2024, 2, 1))], "a date, b date")
    out = df.select(day_diff("a", "b").alias("x"))
    assert out.schema["x"].dataType.simpleString() == "int"
    assert out.first()[0] == 29


def test_value_maps(spark):
    df = spark.createDataFrame([("GTXPro",), ("GTX Pro",), (None,), ("gtxpro",)], "p string")
    fixed = canonicalize_values(df, {"p": {"GTXPro": "GTX Pro"}})
    assert [r[0] for r in fixed.collect()] == ["GTX Pro", "GTX Pro", None, "gtxpro"]
    strict = df.select(mapped("p", {"GTXPro": "X"}, keep_unmapped=False))
    assert [r[0] for r in strict.collect()] == ["X", None, None, None]
