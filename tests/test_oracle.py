"""Every registered query equals its DuckDB oracle on the driver's data.

sf0.001 always; sf0.01 (the driver's check) when COHORTLINE_FULL=1.
"""

import os

import pytest

import __spark_entry__ as se
from compare import compare

SF = ["/root/testdata/sf0.001"]
if os.environ.get("COHORTLINE_FULL") == "1":
    SF.append("/root/testdata/sf0.01")


@pytest.mark.parametrize("sf_dir", SF)
def test_queries_match_oracle(spark, sf_dir):
    if not os.path.exists(sf_dir):
        pytest.skip("test data not present")
    results = compare(spark, sf_dir, list(se._QUERIES), verbose=False)
    bad = {k: v for k, v in results.items() if v != "ok"}
    assert not bad, bad


def test_every_query_has_an_oracle():
    assert set(se._QUERIES) <= set(se.oracle_sql()) <= set(se.queries())


def test_entry_smoke(spark):
    if not os.path.exists("/root/testdata/sf0.001"):
        pytest.skip("test data not present")
    df = se.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["actor_id", "metric", "metric_value", "first_name", "last_name", "email",
                          "country", "login_list"]
