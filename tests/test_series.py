"""Daily summary: merge, running totals, snapshot, conversion."""

from helpers import day, make_sources, money, trade, ts

from cohortline.operators import series
from cohortline.operators.rollup import convert_prev_day, fx_deals_part, summary_parts
from cohortline.params import Scope, SummarySpec
from cohortline.plans.summary import daily_summary


def _spec(**kw):
    return SummarySpec(scope=Scope(day(1), day(31)), **kw)


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_running_totals_not_carried_forward(spark):
    # H1: on a day without activity in a source its cumulative is NULL (or 0 with fill)
    src = make_sources(spark, trades=[trade(1, 1, 10), trade(1, 3, 5)],
                       payments=[(1, ts(2), "Client Deposit", money(7))])
    out = daily_summary(src, _spec())
    got = _rows(out, ["date", "bo_turnover_usd", "cumulative_bo_turnover_usd", "cumulative_deposit_usd"])
    assert got == [(day(1), 10.0, 10.0, None), (day(2), None, None, 7.0), (day(3), 5.0, 15.0, None)]
    filled = daily_summary(src, _spec(fill=0))
    got = _rows(filled, ["date", "cumulative_bo_turnover_usd", "cumulative_deposit_usd"])
    assert got == [(day(1), 10.0, 0.0), (day(2), 0.0, 7.0), (day(3), 15.0, 0.0)]


def test_null_actor_rows_are_dropped(spark):
    # Rows without an actor never merge with others
    src = make_sources(spark, trades=[trade(None, 1, 10), trade(2, 1, 4)])
    out = daily_summary(src, _spec())
    assert _rows(out, ["actor_id", "bo_turnover_usd"]) == [(2, 4.0)]


def test_snapshot_equals_window_then_filter(spark):
    src = make_sources(
        spark,
        trades=[trade(1, 1, 10), trade(1, 2, 3, -3), trade(2, 2, 8), trade(3, 1, 1)],
        payments=[(1, ts(2), "Client Withdrawal", money(-4)), (3, ts(1), "Client Deposit", money(9))])
    spec = _spec(cross_source=True)
    full = daily_summary(src, spec).filter("date = DATE'2024-01-02'")
    snap = daily_summary(src, spec, snapshot_day=day(2))
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, snap.collect()))
    assert snap.count() == 2


def test_ratio_and_cross_source(spark):
    src = make_sources(spark, trades=[trade(1, 1, 10, -4), trade(1, 2, 10, 6)])
    out = daily_summary(src, _spec(cross_source=True))
    got = _rows(out, ["date", "bo_pnl_usd", "bo_profit_percentage", "cumulative_bo_profit_percentage",
                      "pnl_usd", "cumulative_pnl_usd"])
    assert got == [(day(1), 4.0, 40.0, 40.0, 4.0, 4.0), (day(2), -6.0, -60.0, -10.0, -6.0, -2.0)]


def test_zero_turnover_ratio_is_null(spark):
    src = make_sources(spark, trades=[trade(1, 1, 0, 0)])
    out = daily_summary(src, _spec())
    assert out.first()["bo_profit_percentage"] is None


def _fx_sources(spark, rates):
    return make_sources(
        spark,
        deals=[("L1", ts(2), "out", money(10), money(-1), 1, 1),
               ("L1", ts(2), "in", money(5), money(0), 1, 1),
               ("L2", ts(2), "out", money(20), money(0), 1, 1),
               ("L1", ts(3), "out", money(2), money(0), 1, 1)],
        accounts=[("L1", "G", "s1", 1), ("L2", "G", "s1", 2)],
        account_groups=[("G", "s1", "EURX")],
        fx_rates=rates)


def test_previous_day_rate_conversion(spark):
    rates = [(day(1), "EURX", "USD", 1.5), (day(1), "EURX", "EUR", 9.0),
             (day(2), "EURX", "USD", 2.0)]
    src = _fx_sources(spark, rates)
    part = fx_deals_part(src, _spec())
    got = _rows(series.build_series([part]), ["actor_id", "date", "mt5_pnl_usd", "mt5_contract_count"])
    # user 1, day 2: (10 - 1) * 1.5 (+ 0 for the opening deal); day 3: 2 * 2.0
    assert got == [(1, day(2), 13.5, 2), (1, day(3), 4.0, 1), (2, day(2), 30.0, 1)]


def test_missing_rate_null_only_when_all_rows_closing(spark):
    # No rate -> closing rows give NULL; a day that also has other deals sums to 0
    src = _fx_sources(spark, [])
    conv = convert_prev_day(src, Scope(day(1), day(31)))
    part = fx_deals_part(src, _spec())
    got = _rows(series.build_series([part]), ["actor_id", "date", "mt5_pnl_usd"])
    assert got == [(1, day(2), 0.0), (1, day(3), None), (2, day(2), None)]
    assert conv.count() == 3


def test_scope_is_half_open(spark):
    src = make_sources(spark, trades=[trade(1, 1, 1), trade(1, 5, 2), trade(1, 9, 4)])
    out = daily_summary(src, SummarySpec(scope=Scope(day(5), day(9))))
    assert _rows(out, ["date"]) == [(day(5),)]


def test_parts_follow_spec(spark):
    src = make_sources(spark)
    names = [m.name for p in summary_parts(src, _spec(profit_loss=True, third_fact="closed"))
             for m in p.measures]
    assert "bo_profit_usd" in names and "mt5_loss_usd" in names


def test_amounts_are_not_rounded(spark):
    # 1,000 amounts of 0.004 sum to 4
    src = make_sources(spark, payments=[(1, ts(2), "Client Deposit", 0.004)] * 1000)
    assert _rows(daily_summary(src, _spec()), ["deposit_usd", "deposit_count"]) == [(4.0, 1000)]


def test_weak_currencies_keep_their_value(spark):
    for rate, total in ((0.000064, 64.0), (0.00004, 40.0), (0.0000123457, 12.3457)):
        src = make_sources(
            spark, deals=[("MT1", ts(3), "out", 600000.0, 0.0, 1, 1), ("MT1", ts(3), "out_by", 400000.0, 0.0, 1, 1)],
            accounts=[("MT1", "g", "s", 1)], account_groups=[("g", "s", "WEAK")],
            fx_rates=[(day(2), "WEAK", "USD", rate)])
        assert _rows(daily_summary(src, _spec()), ["mt5_pnl_usd"]) == [(total,)]


def test_exact_sums_and_overflow(spark):
    import pytest
    from pyspark.sql import functions as F

    from cohortline.functions import exact
    df = spark.createDataFrame([(0.1,)] * 10 + [(1e15,), (-1e15,)], "x double")
    assert df.select(F.sum(exact(F.col("x"))).cast("double")).first()[0] == 1.0
    with pytest.raises(Exception):
        spark.createDataFrame([(1e30,)], "x double").select(exact(F.col("x"))).collect()


def test_v1_reads_all_months_of_every_fact(spark):
    import datetime as dt

    from cohortline.plans.summary import spec_v1
    feb = (1, dt.datetime(2024, 2, 5, 12), 7.0, 7.0, 0.0, 0, 1)
    src = make_sources(spark, trades=[trade(1, 5, 10), feb],
                       payments=[(1, dt.datetime(2024, 2, 3, 9), "Client Deposit", 5.0)])
    for spec in (spec_v1("2024-01-01"), spec_v1()):
        got = _rows(daily_summary(src, spec), ["date", "bo_turnover_usd", "deposit_usd"])
        assert got == [(day(5), 10.0, None), (dt.date(2024, 2, 3), None, 5.0), (dt.date(2024, 2, 5), 7.0, None)]
    # one month of the first fact only where a caller asks for it
    got = _rows(daily_summary(src, spec_v1("2024-01-01", first_fact_month="2024-01-15")), ["date", "bo_turnover_usd"])
    assert got == [(day(5), 10.0), (dt.date(2024, 2, 3), None)]


def test_snapshot_equals_running_totals_of_the_day(spark):
    src = make_sources(spark, trades=[trade(1, 1, 10), trade(1, 3, 5), trade(2, 3, 4), trade(2, 4, 9)],
                       payments=[(1, ts(3), "Client Deposit", 0.1), (1, ts(2), "Client Deposit", 0.2)])
    whole = daily_summary(src, _spec()).filter("date = '2024-01-03'")
    assert sorted(map(tuple, daily_summary(src, _spec(), day(3)).collect())) == sorted(map(tuple, whole.collect()))


def test_declared_decimals_sum_units_and_refuse_finer_amounts(spark):
    import random
    import pytest
    from dataclasses import replace

    from cohortline.plans.summary import daily_summary, snapshot_summary, spec_v1, spec_v2, spec_v5
    from pyspark.sql import functions as F
    rng = random.Random(2)
    trades = [trade(rng.randint(1, 4), rng.randint(1, 20), rng.choice([0.1, 0.07, 1e9 + 0.01, 33.33]), rng.choice([0.29, -1.15, 0.0]))
              for _ in range(80)]
    payments = [(rng.randint(1, 4), ts(rng.randint(1, 20)), "Client Deposit", rng.choice([0.01, None, 8.07])) for _ in range(40)]
    closed = [(day(rng.randint(1, 20)), rng.randint(1, 4), "MT5", rng.choice([-0.35, 0.7]), 1) for _ in range(40)]
    src = make_sources(spark, trades=trades, payments=payments, closed_trades=closed)
    units = replace(src, amount_decimals=2)
    for spec in (spec_v1(day(1)), spec_v2(), spec_v5(day(21))):
        a, b = daily_summary(src, spec), daily_summary(units, spec)
        assert a.dtypes == b.dtypes
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert sorted(map(str, snapshot_summary(src, day(16)).collect())) == sorted(map(str, snapshot_summary(units, day(16)).collect()))
    for wrong in (0.015, float("nan"), float("inf"), 1e15):
        bad = replace(make_sources(spark, trades=[trade(1, 2, 5)]), amount_decimals=2)
        bad.trades = bad.trades.withColumn("turnover", F.lit(wrong))
        with pytest.raises(Exception, match="decimals|OVERFLOW|NaN|malformed|cannot be represented"):
            daily_summary(bad, spec_v1(day(1))).collect()
