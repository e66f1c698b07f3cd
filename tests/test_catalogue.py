"""Catalogue sources, persistent view and SQL table function."""

import datetime as dt

import pytest
from helpers import make_sources
from pyspark.sql import functions as F
from test_stored import facts, plan, rows

from cohortline.plans import invitations as inv
from cohortline.plans import sql_objects
from cohortline.plans.summary import daily_summary, spec_v1, spec_v2
from cohortline.sources import SchemaMismatch, catalogue_sources, drop_database, new_database, save_sources
from cohortline.sources.catalog import RELATIONS, relation

START = dt.date(2024, 1, 1)


@pytest.fixture()
def database(spark):
    name = new_database(spark, "test")
    save_sources(facts(spark), name, 3)
    yield name
    drop_database(spark, name)


def test_sources_from_a_database(spark, database):
    src = catalogue_sources(spark, database)
    assert rows(daily_summary(src, spec_v1(START))) == rows(daily_summary(facts(spark), spec_v1(START)))
    scan = plan(src.trades.filter(F.col("ts") >= F.lit(dt.datetime(2024, 1, 5))).select("actor_id", "turnover"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in scan and "winning_turnover" not in scan


def test_tables_named_one_by_one_with_columns_of_their_own(spark, database):
    spark.table(f"{database}.payments").select(
        F.col("actor_id").alias("client id"), "ts", "category", F.col("amount").cast("decimal(12,4)").alias("usd"),
        F.lit("x").alias("note")).write.saveAsTable(f"{database}.cash")
    names = {r: f"{database}.{r}" for r in RELATIONS} | {"payments": f"{database}.cash"}
    src = catalogue_sources(spark, names, {"payments": {"actor_id": "client id", "amount": "usd"}})
    assert src.payments.dtypes == [("actor_id", "bigint"), ("ts", "timestamp_ntz"), ("category", "string"), ("amount", "double")]
    assert daily_summary(src, spec_v1(START)).count() > 0


def test_every_fault_is_listed(spark, database):
    spark.sql(f"DROP TABLE {database}.clients")
    spark.sql(f"DROP TABLE {database}.deals")
    spark.createDataFrame([("a", 1, "x")], "login string, ts int, profit string").write.saveAsTable(f"{database}.deals")
    with pytest.raises(SchemaMismatch) as error:
        catalogue_sources(spark, database)
    text = str(error.value)
    for part in ("clients: no table", "deals.ts: 'ts' is int, expected time", "deals.profit: 'profit' is string, expected number",
                 "deals.entry: no column 'entry'"):
        assert part in text
    with pytest.raises(SchemaMismatch, match="no table is named"):
        catalogue_sources(spark, {"trades": f"{database}.trades"})


def test_declared_relations_are_those_of_the_operators(spark):
    src = make_sources(spark)
    for name, columns in RELATIONS.items():
        df, faults = relation(getattr(src, name), name)
        assert not faults and df.columns == list(columns) == getattr(src, name).columns


@pytest.mark.parametrize("profit_loss,spec", [(False, spec_v1), (True, spec_v2)])
def test_another_session_reads_the_view_and_later_facts(spark, database, profit_loss, spec):
    sql_objects.create_summary_view(spark, f"{database}.summary", database, START, profit_loss, order_by=("actor_id", "date"))
    other = spark.newSession()
    full = daily_summary(catalogue_sources(spark, database), spec(START))
    view = other.table(f"{database}.summary")
    assert view.dtypes == full.dtypes and rows(view) == rows(full)
    got = [(r.actor_id, r.date) for r in view.collect()]
    assert got == sorted(got)
    spark.table(f"{database}.trades").limit(5).write.insertInto(f"{database}.trades")
    full = daily_summary(catalogue_sources(spark, database), spec(START))
    other.sql(f"REFRESH TABLE {database}.trades")     # a session keeps the file lists it has read
    assert rows(other.table(f"{database}.summary")) == rows(full) == rows(spark.newSession().table(f"{database}.summary"))


@pytest.mark.parametrize("mode", ["lag", "delta"])
def test_table_function_equals_the_list(spark, database, mode):
    sql_objects.create_summary_view(spark, f"{database}.s", database, START, mode == "delta")
    sql_objects.create_invitation_function(spark, f"{database}.f", f"{database}.s", database, mode)
    values = (START, dt.date(2024, 1, 18), 2, 20, 40.0, 10.0, 20.0, 5.0)
    want = inv.multi_metric_invitations(facts(spark), *values, mode=mode, summary_start=START)
    got = sql_objects.call_function(spark.newSession(), f"{database}.f", *values)
    assert got.columns == want.columns and rows(got) == rows(want) and got.count() > 3
    other = spark.newSession()
    other.sql(f"USE {database}")
    text = "SELECT * FROM f(DATE'2024-01-01', DATE'2024-01-18', 2, 20, 40, 10, 20, 5) WHERE country = 'c1'"
    assert rows(other.sql(text)) == rows(want.filter("country = 'c1'"))


def test_names_are_checked(spark):
    with pytest.raises(ValueError, match="not a name"):
        sql_objects.summary_sql("a; DROP TABLE b")
