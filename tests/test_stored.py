"""Bucketed series, incremental refresh, stored sketches and bitmaps."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from helpers import day, make_sources, trade, ts
from pyspark.sql import functions as F

from cohortline.operators import audience, quota, rules, sketches
from cohortline.operators.thresholds import estimate_thresholds
from cohortline.plans.stored import SummaryStore, save_series, stored_series
from cohortline.plans.summary import daily_summary, spec_v1, spec_v2, spec_v5
from cohortline.session import checkpoint, ensure_checkpoint_dir
from cohortline.sources import drop_database, new_database


def facts(spark, seed=3, actors=12, days=range(1, 21)):
    rng = random.Random(seed)

    def some(make, n):
        return [make(rng.randint(1, actors), rng.choice(days)) for _ in range(n)]
    trades = some(lambda a, d: trade(a, d, rng.uniform(1, 90), rng.uniform(-50, 50), rng.randint(1, 3)), 150)
    payments = some(lambda a, d: (a, ts(d), rng.choice(["Client Deposit", "Client Withdrawal", "Payment Agent Deposit", "other"]),
                                  rng.uniform(-70, 70)), 90)
    closed = some(lambda a, d: (day(d), a, rng.choice(["MT5", "CTRADER"]), rng.uniform(-9, 9) + 1e-7, 2), 70)
    profile = [(a, f"c{a % 3}", f"u{a}@x.com", "L") for a in range(1, actors)]
    return make_sources(spark, trades=trades + [(None, *trade(0, 3, 5)[1:])], payments=payments, closed_trades=closed,
                        profile=profile)


def rows(df):
    return sorted(map(str, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("spec", [spec_v1(day(1)), spec_v2()])
def test_stored_series_needs_no_exchange(spark, spec):
    src = facts(spark)
    database = new_database(spark, "test")
    save_series(src, spec, database, 3)
    series = stored_series(spark, src, spec, database)
    full = daily_summary(src, spec)
    assert series.columns == full.columns and rows(series) == rows(full)
    lagged = audience.attach_profile(rules.with_previous(series, ["cumulative_bo_turnover_usd"]), spark.table(f"{database}.profile"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(lagged) and "Window" in plan(lagged)
        want = audience.attach_profile(rules.with_previous(full, ["cumulative_bo_turnover_usd"]), src.profile)
        assert rows(lagged) == rows(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    drop_database(spark, database)


def store(spark, spec, name):
    return SummaryStore(spark, f"{ensure_checkpoint_dir(spark)}/tables/store-{name}-{random.random()}", spec)


@pytest.mark.parametrize("spec", [spec_v1(day(1)), spec_v2(), replace(spec_v5("2024-01-21"), scope=spec_v1(day(1)).scope)])
def test_days_added_one_by_one_equal_the_whole(spark, spec):
    src = facts(spark, seed=5)
    kept = store(spark, spec, "days")
    for first, end in ((1, 4), (4, 15), (15, 16), (16, 22)):
        kept.refresh(src, day(first), day(end))
    full = daily_summary(src, spec)
    assert rows(kept.read().select(full.columns)) == rows(full)
    assert kept.stored_states() == [day(3), day(14), day(15), day(21)]


def test_a_refresh_reads_the_new_facts_and_one_state(spark, tmp_path):
    src = facts(spark)
    paths = {}
    for name in ("trades", "payments", "closed_trades"):
        paths[name] = str(tmp_path / name)
        getattr(src, name).write.parquet(paths[name])
    stored = replace(src, **{n: spark.read.parquet(p) for n, p in paths.items()})
    kept = store(spark, spec_v1(day(1)), "scan")
    kept.refresh(stored, day(1), day(10))
    from cohortline.operators import series
    from cohortline.operators.rollup import summary_parts
    from cohortline.params import Scope
    parts = summary_parts(stored, replace(kept.spec, scope=Scope(day(10), day(11))))
    text = plan(series.merge_daily(parts))
    assert text.count("2024-01-10") >= 3 and "2024-01-01" not in text
    daily = series.merge_daily(parts)
    state = plan(kept.carried(daily, day(9)))
    assert "PartitionFilters: [isnotnull(as_of" in state


def test_late_facts_and_corrections(spark):
    src = facts(spark, seed=9)
    spec = spec_v1(day(1))
    late = replace(src, payments=src.payments.filter(F.col("ts") < F.lit(ts(8, 0))),
                   trades=src.trades.filter(F.col("actor_id") != 4))
    kept = store(spark, spec, "late")
    for first, end in ((1, 8), (8, 12), (12, 18)):
        kept.refresh(late, day(first), day(end))
    with pytest.raises(ValueError, match="already reaches"):
        kept.refresh(src, day(9), day(17))
    assert kept.refresh(src, day(8), day(19)) == day(8)        # the state of the 7th still holds for payments,
    assert kept.stored_states() == [day(7), day(18)]            # states after the first touched day are void
    assert kept.refresh(src, day(1), day(22)) == day(1)         # trades of one actor came late from the start on
    full = daily_summary(src, spec)
    assert rows(kept.read().select(full.columns)) == rows(full)
    # a correction takes all facts of a day away: its rows go as well
    gone = replace(src, trades=src.trades.filter(F.to_date("ts") != F.lit(day(20))),
                   payments=src.payments.filter(F.to_date("ts") != F.lit(day(20))),
                   closed_trades=src.closed_trades.filter(F.col("trade_date") != F.lit(day(20))))
    kept.refresh(gone, day(20), day(23))
    full = daily_summary(gone, spec)
    assert rows(kept.read().select(full.columns)) == rows(full)
    assert kept.read().filter(F.col("date") == F.lit(day(20))).count() == 0


def test_a_store_needs_an_open_end(spark):
    with pytest.raises(ValueError, match="no end"):
        store(spark, spec_v1(day(1), day(9)), "end")


def test_sketches_merge_within_their_error(spark):
    rng = random.Random(1)
    values = [(rng.randint(1, 30), rng.lognormvariate(3, 2)) for _ in range(30000)] + [(2, None), (40, None)]
    df = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(d), v) for d, v in values], "date date, v double")
    stored = sketches.daily_sketches(df, ["v"], k=400).cache()
    start, end = dt.date(2024, 1, 6), dt.date(2024, 1, 27)
    inside = sorted(v for d, v in values if v is not None and start <= dt.date(2024, 1, 1) + dt.timedelta(d) < end)
    for q in (10, 50, 80, 95):
        got = sketches.sketched_thresholds(stored, start, end, {"v": q}, k=400).first()[0]
        low, high = inside[int(len(inside) * (q / 100 - 0.02))], inside[int(len(inside) * (q / 100 + 0.02))]
        assert round(low) - 1 <= got <= round(high) + 1
    exact = sketches.daily_sketches(df, ["v"], k=65535)
    assert sketches.sketched_thresholds(exact, None, None, {"v": 80}, k=65535).first()[0] == \
        estimate_thresholds(df, {"v": 80}, 10 ** 6).first()[0]
    assert sketches.sketched_thresholds(stored, dt.date(2024, 2, 10), None, {"v": 80}, k=400).first()[0] is None
    assert sketches.sketched_thresholds(stored.limit(0), None, None, {"v": 80}).first()[0] is None


@pytest.mark.parametrize("name", [lambda a: f"actor-{a * 7919}", lambda a: a * 10 ** 12 - 5])
def test_bitmaps_count_distinct_actors_of_any_id(spark, name):
    rng = random.Random(6)
    picked = [(name(rng.randint(1, 300)), day(rng.randint(1, 9)), rng.choice(["a", "b", None])) for _ in range(2000)]
    kind = "string" if isinstance(name(1), str) else "long"
    df = spark.createDataFrame(picked + [(None, day(2), "a")], f"actor_id {kind}, date date, country string")
    early = df.filter(F.col("date") < F.lit(day(4)))
    numbers = sketches.number_actors(early)
    more = sketches.number_actors(df, numbers)
    assert numbers.join(more, ["actor_id", "number"]).count() == numbers.count()
    got = [r[0] for r in more.select("number").orderBy("number").collect()]
    assert got == list(range(1, len({a for a, _, _ in picked}) + 1))
    stored = checkpoint(sketches.daily_bitmaps(df, more))
    inside = df.filter((F.col("date") >= F.lit(day(3))) & (F.col("date") < F.lit(day(7))))
    found = sketches.distinct_actors(stored, start=day(3), end=day(7))
    assert rows(quota.share_of(found, ["country"], 30)) == rows(quota.group_share(inside, ["country"], 30))
    assert "actor_id" not in plan(found)
    with pytest.raises(Exception, match="no number for actor"):
        sketches.daily_bitmaps(df, numbers).collect()
