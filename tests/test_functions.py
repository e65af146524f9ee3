import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import money, temporal, text


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_sum_money_is_exact_and_order_free(spark):
    rng = random.Random(5)
    cents = [rng.randrange(-10**12, 10**12) for _ in range(5000)]
    expected = sum(cents) / 100
    for seed in (1, 2):
        random.Random(seed).shuffle(cents)
        df = column(spark, [c / 100 for c in cents]).repartition(7)
        assert df.agg(money.sum_money("x")).first()[0] == expected


def test_sum_money_beyond_long_cents(spark):
    # 2e7 rows of the greatest amount would overflow a plain sum of cents at 9.2e18.
    df = spark.range(20_000_000).select(F.lit(9999999999.99).alias("x"))
    assert df.agg(money.sum_money("x")).first()[0] == pytest.approx(9999999999.99 * 2e7, rel=1e-15)


def test_sum_money_keeps_what_is_no_amount(spark):
    assert math.isnan(column(spark, [1.0, float("nan")]).agg(money.sum_money("x")).first()[0])
    assert column(spark, [1.0, 1e300]).agg(money.sum_money("x")).first()[0] == 1e300
    assert column(spark, [None, None]).agg(money.sum_money("x")).first()[0] is None
    assert column(spark, [1.25, None]).agg(money.sum_money("x")).first()[0] == 1.25


def test_avg_money_of_nothing_is_null(spark):
    assert column(spark, [None]).agg(money.avg_money("x")).first()[0] is None
    assert column(spark, [1.0, 2.0, 2.0, None]).agg(money.avg_money("x")).first()[0] == 1.67


def test_round2_halves_go_away_from_zero(spark):
    values = [2.5, -2.5, 0.125, -0.125, 66.666666, 0.0, 1e15]
    rows = column(spark, values).select(money.round2("x")).collect()
    assert [r[0] for r in rows] == [2.5, -2.5, 0.13, -0.13, 66.67, 0.0, 1e15]


def test_percent_of_nothing_is_null(spark):
    row = spark.range(1).select(money.percent("1", "0"), money.percent2("1", "8"))
    assert tuple(row.first()) == (None, 12.5)


@pytest.mark.parametrize(
    "value",
    [
        -150.0, 0.0, 5.0, 123456.78, 1e7, 12345678.9, -99999999.99, 9.999e15, 1e16, 1.5e20,
        0.001, 0.0001, 0.00001, 1.25e-7, float("nan"), float("inf"), float("-inf"),
    ],
)
def test_show_float_reads_like_python(spark, value):
    assert column(spark, [value]).select(text.show_float(F.col("x"))).first()[0] == repr(value)


def test_show_float_of_null(spark):
    assert column(spark, [None]).select(text.show_float(F.col("x"))).first()[0] == "None"


@pytest.mark.parametrize("value", ["", " ", "\t\n", "  ", "\x1f\x85", " a ", "a b", "　x\n"])
def test_strip_matches_python(spark, value):
    row = column(spark, [value], "string").select(
        text.strip(F.col("x")), text.is_blank(F.col("x"))
    ).first()
    assert tuple(row) == (value.strip(), not value.strip())


def test_numbers(spark):
    df = column(spark, ["1", "-1", "abc", None, "NaN", " 2.5 "], "string")
    rows = df.select(text.is_non_negative(F.col("x"))).collect()
    assert [r[0] for r in rows] == [True, False, False, False, False, True]


def test_days_keep_the_written_date(spark):
    values = ["2026-10-01", "2026-10-01T23:30:00-08:00", "2026-10-01 10:00:00", "garbage", None]
    rows = column(spark, values, "string").select(temporal.to_day("x").cast("string")).collect()
    assert [r[0] for r in rows] == ["2026-10-01"] * 3 + [None, None]
