"""Parameters (scopes, month arithmetic) and exact integer helpers."""

import datetime as dt
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortline.functions import metric_columns, round_half_up_div, whole_percent
from cohortline.params import Scope, add_months


def test_add_months_clamps_to_month_end():
    assert add_months(dt.date(2022, 5, 31), -3) == dt.date(2022, 2, 28)
    assert add_months(dt.date(2024, 5, 31), -3) == dt.date(2024, 2, 29)
    assert add_months(dt.date(2022, 3, 1), -3) == dt.date(2021, 12, 1)
    assert add_months(dt.date(2021, 12, 15), 1) == dt.date(2022, 1, 15)


def test_scopes():
    assert Scope.months_before("2022-03-01", 3) == Scope(dt.date(2021, 12, 1), dt.date(2022, 3, 1))
    assert Scope.days_before(dt.date(2024, 1, 31), 30) == Scope(dt.date(2024, 1, 1), None)
    assert Scope.since("2024-01-01") == Scope(dt.date(2024, 1, 1), None)


def test_metric_allow_list(spark):
    daily, cum = metric_columns("withdrawal_count")
    assert "withdrawal_count" in str(daily) and "cumulative_withdrawal_count" in str(cum)


def _half_up(num, den):
    q = Fraction(num, den)
    return int(q + Fraction(1, 2)) if q >= 0 else None


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=st.lists(st.tuples(st.integers(0, 10**12), st.integers(1, 10**6)), min_size=1, max_size=30))
def test_integer_rounding_is_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select(round_half_up_div(F.col("n"), F.col("d")).alias("r"),
                    whole_percent(F.col("n") % F.col("d"), F.col("d")).alias("p")).collect()
    for (n, d), row in zip(pairs, got):
        assert row.r == _half_up(n, d)
        assert row.p == _half_up(100 * (n % d), d)


def test_integer_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(5, 0)], "n long, d long")
    assert df.select(round_half_up_div(F.col("n"), F.col("d"))).first()[0] is None
