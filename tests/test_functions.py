from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermill.functions import days_between, exact_sum, fiscal_year_end, money_sum, round_to

cents = st.integers(-10**9, 10**9).map(lambda n: n / 100)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(cents, st.integers(0, 1000)), min_size=1, max_size=40))
def test_sums_are_exact(spark, amounts):
    df = spark.createDataFrame(amounts, "amount double, n long")
    row = df.agg(exact_sum(F.col("amount")).alias("s"),
                 exact_sum(F.col("amount"), F.col("n")).alias("w")).first()
    assert row.s == sum(Decimal(str(a)) for a, _ in amounts)
    assert row.w == sum(Decimal(str(a)) * n for a, n in amounts)


def test_sums_beyond_a_long_of_micros(spark):
    df = spark.range(4).select(F.lit(9e12).alias("amount"))
    assert df.agg(money_sum(F.col("amount")).alias("s")).first().s == 3.6e13


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_of_large_amounts_in_any_session(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for value in (1e13, -1e13, 1234567890123.25):
            df = spark.range(3).select(F.lit(value).alias("amount"))
            assert df.agg(money_sum(F.col("amount")).alias("s")).first().s == 3 * value
        beyond = spark.range(1).select(F.lit(1e19).alias("amount"))
        with pytest.raises(Exception, match="not a number within|CAST_OVERFLOW"):
            beyond.agg(money_sum(F.col("amount"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_sum_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "amount double")
    assert df.agg(money_sum(F.col("amount")).alias("s")).first().s is None


def test_rounding_follows_the_scaled_double(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.125,), (-0.125,), (None,)], "v double")
    found = [r[0] for r in df.select(round_to(F.col("v"), 2)).collect()]
    assert found == [1.0, 2.68, 0.13, -0.13, None]


def test_calendar(spark):
    df = spark.sql("select timestamp '2024-01-01 23:00:00' a, timestamp '2024-01-02 01:00:00' b")
    row = df.select(
        days_between(F.col("a"), F.col("b")),
        fiscal_year_end(F.lit(2023), "2024-06-30"),
        fiscal_year_end(F.lit(2024), "2024-06-30"),
    ).first()
    assert tuple(row) == (1, date(2023, 12, 31), date(2024, 6, 30))


def test_sums_beyond_their_range_are_errors_without_ansi(spark):
    rows = spark.sql("select explode(array(5e18, 5e18)) as x, 3L as w")
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not within"):
            rows.agg(exact_sum(F.col("x"))).collect()
        with pytest.raises(Exception, match="not within"):
            rows.agg(exact_sum(F.col("x"), F.col("w"))).collect()
        assert rows.filter("x < 0").agg(exact_sum(F.col("x"))).first()[0] is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
