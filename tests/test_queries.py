"""Every registered query against its SQL twin, all rows and types."""

import pytest

import __spark_entry__ as entry
from stopgrid.plans.registry import ORACLES, QUERIES
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    # the stops of the smallest tables have too few rows for a window per split
    sf_dir = SF_DIR.replace("0.001", "0.01") if name in ("demand_model_scores", "absolute_model_scores") else SF_DIR
    assert compare(spark, connect(sf_dir), QUERIES[name], ORACLES[name], sf_dir) is None


def test_every_query_of_the_package_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "date" and df.limit(1).count() == 1
