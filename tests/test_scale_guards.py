"""T5 guards for the scale claims in the README (final adaptive plans)."""

from decimal import Decimal

import pytest

from conftest import SF_SMALL, ts
from tidemark import catalog
from tidemark.operators.spans import extrema_measures, first_last_measures, span_aggregate
from pyspark.sql import functions as F


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_span_measures_stay_hash_aggregates(spark):
    q = spark.createDataFrame([("A", ts("2024-01-01 10:00:00"), Decimal("1.5"), Decimal("1.0"), Decimal("1.2"))],
                              "ticker string, t timestamp_ntz, high_price decimal(16,6), low_price decimal(16,6), "
                              "open_price decimal(16,6)")
    s = spark.createDataFrame([(1, "A", ts("2024-01-01 00:00:00"), ts("2024-01-03 12:00:00"))],
                              "id int, ticker string, lo timestamp_ntz, hi timestamp_ntz")
    for measures in (extrema_measures(time_col="t"), first_last_measures(time_col="t")):
        for strategy in ("rollup", "binned", "dyadic"):
            out = span_aggregate(s, q, key="ticker", span_id="id", lo=F.col("lo"), hi=F.col("hi"),
                                 time_col="t", measures=measures, strategy=strategy)
            plan = final_plan(out)
            assert "HashAggregate" in plan and "SortAggregate" not in plan, strategy


def scans_of(spark, df, table):
    """Scans of one file in the final plan, whatever columns they read (reused exchanges read nothing)."""
    return sum(1 for line in final_plan(df).splitlines() if "FileScan parquet" in line and f"/{table}.parquet" in line)


def without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.mark.parametrize("broadcast", [True, False])
def test_district_mart_reads_facts_once(spark, broadcast):
    try:
        if not broadcast:
            without_broadcast(spark)
        assert scans_of(spark, catalog.QUERIES["district_mart"](spark, SF_SMALL), "lineitem") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_report_is_one_pass_over_its_input(spark):
    plan = final_plan(catalog.QUERIES["effectiveness_report"](spark, SF_SMALL))
    # the evaluated forecasts are read from the stored stage exactly once
    assert sum("FileScan parquet" in line and "price_max_date" in line for line in plan.splitlines()) == 1
    # periods meet one row (the span of dates) in a nested loop, the daily cells in an equi-join
    assert plan.count("BroadcastNestedLoopJoin") == 1 and "start_date" in plan


def test_closing_reads_the_quotes_twice(spark):
    """Once for the daily roll-up, once for the edge days."""
    plan = final_plan(catalog.QUERIES["closed_forecasts"](spark, SF_SMALL))
    assert sum("FileScan parquet" in line and "high_price" in line for line in plan.splitlines()) <= 2


def test_candles_open_close_are_hash_aggregated(spark):
    from tidemark.sources import driver
    plan = final_plan(driver.hourly_quotes(driver.ticks(driver.table(spark, SF_SMALL, "events"))))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
