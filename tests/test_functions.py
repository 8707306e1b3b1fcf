"""Column helpers (traps T4, T5, T8, T13)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from cartwheel.functions import day_diff, money, round_half_up, safe_div, week_diff


def test_half_up_rounding_is_engine_independent(spark):
    df = spark.createDataFrame([(0.125,), (1.005,), (2.5,), (0.33333,)], "x double")
    got = [r.r for r in df.select(round_half_up("x", 2).alias("r")).collect()]
    # floor(x * 100 + 0.5) / 100 on the binary double: 1.005 is 1.00499999... -> 1.0
    assert got == [0.13, 1.0, 2.5, 0.33]


def test_safe_div_gives_null_not_error_or_infinity(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (3, 4)], "a int, b int")
    assert [r.q for r in df.select(safe_div("a", "b").alias("q")).collect()] == [None, None, 0.75]


def test_money_does_not_depend_on_row_order(spark):
    vals = [0.1, 0.2, 0.3, 1e-2, 12.31, 490.02] * 50
    a = spark.createDataFrame([(v,) for v in vals], "v double").repartition(7)
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "v double").coalesce(1)
    sa = a.agg(F.sum(money("v")).cast("double").alias("s")).first().s
    sb = b.agg(F.sum(money("v")).cast("double").alias("s")).first().s
    assert sa == sb == 25147.0


def test_week_and_day_differences(spark):
    df = spark.createDataFrame([(date(2024, 1, 7), date(2024, 1, 8)), (date(2024, 1, 7), date(2024, 1, 14))], "a date, b date")
    out = df.select(
        week_diff("a", "b").alias("w"), week_diff("a", "b", calendar_weeks=True).alias("cw"), day_diff("a", "b").alias("d")
    ).collect()
    # Sunday -> Monday: 0 whole weeks, 1 calendar week; +7 days: 1 and 1
    assert [(r.w, r.cw, r.d) for r in out] == [(0, 1, 1), (1, 1, 7)]
    assert dict(df.select(week_diff("a", "b")).dtypes).popitem()[1] == "bigint"
