"""Sinks: temporary view (P2, P5) and the day-partitioned table."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cohortline.session import ensure_checkpoint_dir
from cohortline.sources import register_view, save_table


def _df(spark):
    rows = [(a, dt.date(2024, 1, d), float(a * d)) for a in range(1, 6) for d in range(1, 5)]
    return spark.createDataFrame(rows, "actor_id long, date date, v double")


def test_register_view_round_trip(spark):
    view = register_view(_df(spark), "cohortline_test_view")
    assert view.count() == 20
    assert spark.sql("SELECT SUM(v) AS s FROM cohortline_test_view").first().s == 150.0


def test_save_table_prunes_partitions(spark):
    path = f"{ensure_checkpoint_dir(spark)}/tables/test_{os.getpid()}"
    stored = save_table(_df(spark), path)
    pruned = stored.filter(F.col("date") >= F.lit(dt.date(2024, 1, 3)))
    assert pruned.count() == 10
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert sorted(map(tuple, stored.select("actor_id", "date", "v").collect())) == \
        sorted(map(tuple, _df(spark).collect()))


def test_month_partitioned_facts_are_pruned(spark):
    from dataclasses import replace

    from helpers import make_sources, trade, ts

    from cohortline.operators.rollup import closed_trades_part, payments_part, trades_part
    from cohortline.params import Scope, SummarySpec
    base = make_sources(spark, trades=[trade(1, 5, 10), trade(2, 20, 3)], payments=[(1, ts(20), "Client Deposit", 1.0)],
                        closed_trades=[(dt.date(2024, 1, 20), 1, "MT5", 2.0, 1)])
    stored = {}
    for name, when in (("trades", "ts"), ("payments", "ts"), ("closed_trades", "trade_date")):
        path = f"{ensure_checkpoint_dir(spark)}/tables/{name}_{os.getpid()}"
        stored[name] = save_table(getattr(base, name).withColumn("year_month", F.trunc(when, "MM")), path, ("year_month",))
    src = replace(base, **stored)
    spec = SummarySpec(scope=Scope(dt.date(2024, 1, 10), dt.date(2024, 2, 1)),
                       month_partitions=tuple((n, "year_month") for n in stored))
    for build in (trades_part, payments_part, closed_trades_part):
        part = build(src, spec)
        assert part.rows.count() == 1
        plan = part.rows._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(year_month" in plan
    # a fact without such a column beside one that has it
    mixed = replace(src, payments=base.payments)
    assert payments_part(mixed, replace(spec, month_partitions=(("trades", "year_month"),))).rows.count() == 1


def test_sorted_view_keeps_its_order(spark):
    view = register_view(_df(spark).repartition(7), "cohortline_sorted_view", order_by=("v", "actor_id"))
    got = [(r.v, r.actor_id) for r in view.collect()]
    assert got == sorted(got) and len(got) == 20
