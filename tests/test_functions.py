"""Column expressions: NULL propagation, zero denominators, labels, rounding."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import (
    any_not_null,
    avg_micros_as_days,
    avg_money,
    first_by_order,
    guarded_ratio,
    hour_diff,
    late_flag,
    mean_coordinate,
    month_part,
    round_money,
    year_month_label,
    year_part,
)


def test_late_flag_is_three_valued(spark):
    df = spark.createDataFrame([
        (dt.datetime(2022, 1, 2), dt.datetime(2022, 1, 1)),
        (dt.datetime(2022, 1, 1), dt.datetime(2022, 1, 1)),   # equal is on time
        (None, dt.datetime(2022, 1, 1)),
        (dt.datetime(2022, 1, 1), None),
    ], "d timestamp_ntz, e timestamp_ntz")
    assert [r.f for r in df.select(late_flag("d", "e").alias("f")).collect()] == [
        True, False, None, None]


def test_guarded_ratio(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (2, 2), (None, 4), (1, None)], "n long, d long")
    out = [r.r for r in df.select(guarded_ratio("n", "d").alias("r")).collect()]
    assert out[0] == pytest.approx(2 / 3)
    assert out[1] is None and out[2] == 0.0 and out[3] is None and out[4] is None


def test_hours_and_month_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 3, 5, 10, 45), dt.datetime(2022, 3, 5, 10, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(hour_diff("a", "b").alias("h"), year_part("a").alias("y"),
                  month_part("a").alias("m"), year_month_label("a").alias("l")).first()
    assert (r.h, r.y, r.m, r.l) == (0.75, 2022, 3, "2022-03")


def test_round_money_half_up(spark):
    df = spark.createDataFrame([(2.345,), (2.665,), (-1.005,), (10.0,)], "v double")
    out = [r.v for r in df.select(round_money("v").alias("v")).collect()]
    assert out == [Decimal("2.35"), Decimal("2.67"), Decimal("-1.01"), Decimal("10.00")]


def test_money_and_duration_averages(spark):
    df = spark.createDataFrame([(1, Decimal("10.00"), 86_400_000_000), (1, Decimal("20.01"), None),
                                (1, None, 43_200_000_000)],
                               "k int, v decimal(14,2), us long")
    r = df.groupBy("k").agg(avg_money("v").alias("a"), avg_micros_as_days("us").alias("d")).first()
    assert r.a == pytest.approx(15.005)
    assert r.d == pytest.approx(0.75)


def test_average_duration_of_a_sum_beyond_64_bits(spark):
    micros = 9 * 10 ** 18  # two of them are more than a long holds
    df = spark.createDataFrame([(1, micros), (1, micros), (1, None), (2, -micros), (2, -micros)], "k int, us long")
    out = {r.k: r.d for r in df.groupBy("k").agg(avg_micros_as_days("us").alias("d")).collect()}
    assert out == {1: micros / 86_400_000_000, 2: -micros / 86_400_000_000}


def test_mean_coordinate_uses_full_precision(spark):
    df = spark.createDataFrame([(1, -23.50000004), (1, -23.50000004), (1, None)], "k int, v double")
    r = df.groupBy("k").agg(mean_coordinate("v").alias("m")).first()
    assert r.m == Decimal("-23.5000000")


def test_first_by_order_skips_nulls(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "b"), (1, 3, "a"), (2, 1, None)],
                               "k int, s int, t string")
    out = {r.k: r.t for r in df.groupBy("k").agg(first_by_order("t", "s").alias("t")).collect()}
    assert out == {1: "b", 2: None}


def test_any_not_null(spark):
    df = spark.createDataFrame([("x", None), (None, None), (None, "y")], "a string, b string")
    assert [r.f for r in df.select(any_not_null("a", "b").alias("f")).collect()] == [
        True, False, True]
    assert df.select(F.bool_or(any_not_null("a", "b"))).first()[0] is True
