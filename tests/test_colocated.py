"""Tables in buckets: their joins move nothing."""

import re

from pyspark.sql import functions as F

from stopgrid.operators import colocated, demand
from stopgrid.plans.demand import WIDE_HOURS, wide_with_ids
from stopgrid.sources import tables

SF_DIR = "/root/testdata/sf0.001"


def test_no_exchange_below_the_joins(spark):
    days = demand.stop_days_from_wide(wide_with_ids(spark, SF_DIR), WIDE_HOURS)
    given = [days, tables.demand_daily_stop(spark, SF_DIR), tables.demand_monthly_hourly(spark, SF_DIR)]
    stop_days, daily, monthly = (colocated.bucketed(df, "bucketed", buckets=4) for df in given)
    joined = demand.spread_hours(demand.with_demand(stop_days, daily.hint("merge"), monthly.hint("merge")))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("SortMergeJoin", plan)) == 2 and "Exchange" not in plan
    # plain tables need one on each side
    apart = demand.with_demand(days, given[1].hint("merge"), given[2].hint("merge"))
    assert "Exchange" in apart._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == stop_days.count() * 24


def test_a_file_for_each_bucket(spark, tmp_path):
    rows = spark.range(200).select((F.col("id") % 7).cast("string").alias("route_no"), F.col("id").cast("string").alias("stop_id"))
    name = colocated.write_bucketed(rows, str(tmp_path / "t"), buckets=4)
    assert len(list((tmp_path / "t").glob("part-*.parquet"))) == 4 and spark.table(name).count() == 200
    colocated.drop_table(spark, name)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200
