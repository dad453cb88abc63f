"""DOM-4 / DOM-7 report shape, rendering, sinks and DQ operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import d, ts
from tidemark.operators import quality
from tidemark.operators.periods import assign_periods
from tidemark.plans import effectiveness
from tidemark.sinks.files import display, write_index_documents, write_parquet
from tidemark.sources.files import periods_frame

PERIODS = [(0, "all", None, None, True), (1, "jan", d("2024-01-01"), d("2024-01-31"), True),
           (2, "after jan 15", d("2024-01-15"), d("2024-12-31"), False), (3, "empty", d("2030-01-01"), None, True)]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(1, d("2024-01-10"), "RU", 1, 1.0, 1, 2.0, -1, -3.0),
            (1, d("2024-01-15"), "US", -1, -1.0, 2, 1.0, 2, 1.0),
            (2, d("2024-01-20"), "US", 2, 0.5, -1, -0.5, 1, 4.0),
            (2, d("2024-02-01"), None, -2, 0.1, 1, 0.2, -1, -0.2)]
    return spark.createDataFrame(rows, "forecast_direction int, start_date date, country_id string, "
                                       "res50 int, proc50 double, res90 int, proc90 double, res100 int, proc100 double")


def test_metrics_per_period_and_direction(spark, scored):
    m = {(r["period_id"], r["direction"]): r for r in
         effectiveness.forecast_metrics(scored, periods_frame(spark, PERIODS)).collect()}
    assert len(m) == 8
    assert (m[(0, 1)]["forecasts"], m[(0, 1)]["success50"], m[(0, 1)]["yield50"]) == (2, 1, 0.0)
    assert m[(2, 2)]["forecasts"] == 2 and m[(1, 2)]["forecasts"] == 1      # lower bound 15 Jan is exclusive
    assert m[(3, 1)]["forecasts"] == 0 and m[(3, 1)]["yield50"] is None    # empty period keeps its row (Q4)


def test_report_lines(spark, scored):
    r = effectiveness.effectiveness_report(scored, periods_frame(spark, PERIODS))
    rows = {(x["period"], x["metric"]): x for x in r.collect()}
    assert r.count() == 3 + 4 * 16
    assert rows[("total", "all_forecasts")]["value"] == 4
    assert rows[("total", "ru_forecasts")]["value"] == 1 and rows[("total", "other_forecasts")]["value"] == 2
    assert rows[("all", "min_date")]["value_date"] == d("2024-01-10")
    assert rows[("all", "max_date")]["value_date"] == d("2024-01-15")       # rise set only
    assert rows[("all", "rise_success_pct_50")]["value"] == 50.0
    assert rows[("all", "fall_success_pct_100")]["value"] == 50.0
    assert rows[("empty", "rise_success_pct_50")]["value"] is None          # no division error
    lines = [x["line"] for x in r.orderBy("line").collect()]
    assert lines[:3] == [1, 2, 3] and len(set(lines)) == len(lines)


def test_render_and_display(spark, scored):
    r = effectiveness.effectiveness_report(scored, periods_frame(spark, PERIODS))
    out = {x["parameter"]: x["value"] for x in effectiveness.render_report(r).collect()}
    assert out["total all_forecasts"] == "4"
    assert out["all rise_success_pct_50"] == "50.0"
    assert out["all min_date"] == "2024-01-10"
    assert out["empty rise_yield_50"] == ""
    shown = display(effectiveness.render_report(r), n=5).collect()
    assert [x["line"] for x in shown] == [1, 2, 3, 11, 12]


def test_any_number_of_periods_joins_by_day(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 5, 9)], "d date")
    many = [(i, "p", None if i % 2 else dt.date(2024, 1, 5), dt.date(2024, 1, 9) if i % 3 else None, i % 5 > 0) for i in range(10_005)]
    out = assign_periods(days, periods_frame(spark, many), "d")
    want = sum(1 for i, _, lo, hi, inc in many for d in (1, 5, 9)
               if (lo is None or dt.date(2024, 1, d) > lo or (inc and dt.date(2024, 1, d) == lo)) and (hi is None or dt.date(2024, 1, d) <= hi))
    assert out.count() == want
    assert assign_periods(days.limit(0), periods_frame(spark, many[:3]), "d").collect() == []


def test_sinks(spark, tmp_dir):
    df = spark.createDataFrame([(1, ts("2024-01-01 10:00:00")), (2, ts("2024-01-02 10:00:00"))],
                               "id int, event_time timestamp_ntz")
    write_parquet(df, f"{tmp_dir}/p", partition_by=["id"])
    assert spark.read.parquet(f"{tmp_dir}/p").count() == 2
    write_index_documents(df, f"{tmp_dir}/idx")
    back = spark.read.json(f"{tmp_dir}/idx")
    assert sorted(str(r["event_date"]) for r in back.collect()) == ["2024-01-01", "2024-01-02"]


def test_quality_reports(spark):
    df = spark.createDataFrame([(1, "a", 1, 5), (1, "b", None, 9), (2, "c", 3, 1)], "k int, t string, dirn int, res int")
    assert [tuple(r) for r in quality.key_violations(df, ["k"]).collect()] == [(1, 2)]
    nulls = {r["column_name"]: r["null_count"] for r in quality.null_violations(df, ["t", "dirn"]).collect()}
    assert nulls == {"t": 0, "dirn": 1}
    assert [r["k"] for r in quality.code_violations(df, {"dirn": [1, 2], "res": [0, 1, 2, 3]}).collect()] == [1, 1, 2]
    ref = spark.createDataFrame([("a",)], "t string")
    assert sorted(r["t"] for r in quality.orphans(df, ref, ["t"]).collect()) == ["b", "c"]
    # a missing reference is no orphan, whatever the other table holds
    other = spark.createDataFrame([(1,), (None,)], "d int")
    assert [r["t"] for r in quality.orphans(df, other, {"dirn": "d"}).collect()] == ["c"]
    wide = spark.createDataFrame([("12345.678", "x" * 30)], "v string, name string")
    over = quality.overflow_violations(wide, decimals={"v": "decimal(7,3)"}, lengths={"name": 20}).first()
    assert over["violations"] == ["v:decimal(7,3)", "name:len>20"]
    q = spark.createDataFrame([("A", ts("2024-01-01 10:00:00"), ts("2024-01-01 11:00:00")),
                               ("A", ts("2024-01-01 11:00:00"), ts("2024-01-01 11:10:00")),
                               ("B", ts("2024-01-01 10:00:00"), ts("2024-01-01 11:00:00"))],
                              "ticker string, datetime_start timestamp_ntz, datetime_end timestamp_ntz")
    mix = quality.mixed_candle_lengths(q).collect()
    assert [(r["ticker"], r["lengths"], r["min_seconds"], r["max_seconds"]) for r in mix] == [("A", 2, 600, 3600)]
