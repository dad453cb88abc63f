"""DOM-3 close and JON-4 span extrema, including both range-join strategies."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import d, ts
from tidemark.operators.spans import STRATEGIES
from tidemark.plans import forecasts

AS_OF = d("2024-03-01")
Q_SCHEMA = "ticker string, datetime_start timestamp_ntz, datetime_end timestamp_ntz, high_price decimal(16,6), low_price decimal(16,6), open_price decimal(16,6)"


def fc_frame(spark, rows):
    schema = ("analyst_company_id int, ticker string, start_date date, end_date date, forecast_direction int, "
              "price_start decimal(16,6), price_end decimal(16,10), forecast_result smallint, date_inserted timestamp_ntz")
    return spark.createDataFrame(rows, schema)


def q(t, end, hi, lo, op=None):
    start = end.replace(hour=end.hour - 1) if end.hour else end
    return (t, start, end, None if hi is None else Decimal(hi), None if lo is None else Decimal(lo),
            Decimal(op or hi or "1"))


@pytest.fixture(scope="module")
def quotes(spark):
    rows = [
        q("A", ts("2024-01-01 00:00:00"), "101", "99"),     # exactly at the lower bound: inside
        q("A", ts("2024-01-02 10:00:00"), "110", "98"),
        q("A", ts("2024-01-03 10:00:00"), "110", "97"),     # tied high: the earlier one wins
        q("A", ts("2024-01-05 12:00:00"), "100", "90"),     # end_date 12:00: inside
        q("A", ts("2024-01-05 13:00:00"), "200", "10"),     # one hour later: outside
        q("A", ts("2024-01-04 09:00:00"), None, "95"),      # null high is ignored
        q("B", ts("2024-01-02 10:00:00"), "100", "100"),
    ]
    return spark.createDataFrame(rows, Q_SCHEMA)


def test_extrema_bounds_ties_and_nulls(spark, quotes):
    f = fc_frame(spark, [(1, "A", d("2024-01-01"), d("2024-01-05"), 1, Decimal("100"), Decimal("100"), None, None)])
    for strategy in STRATEGIES:
        r = forecasts.span_extrema(f, quotes, strategy).first()
        assert r["price_max_real"] == Decimal("110") and r["price_max_date"] == ts("2024-01-02 10:00:00"), strategy
        assert r["price_min_real"] == Decimal("90") and r["price_min_date"] == ts("2024-01-05 12:00:00"), strategy


def test_close_codes_and_half_even_rounding(spark, quotes):
    rows = [
        (1, "B", d("2024-01-01"), d("2024-01-03"), 1, Decimal("100"), Decimal("102.0005"), None, None),   # 2.0005 -> 2.000
        (2, "B", d("2024-01-01"), d("2024-01-03"), 1, Decimal("100"), Decimal("102.0015"), None, None),   # 2.0015 -> 2.002
        (3, "B", d("2024-01-01"), d("2024-01-03"), 2, Decimal("100"), Decimal("100.0004"), None, None),   # rounds to 0 -> 3
        (4, "B", d("2024-01-01"), d("2024-01-03"), 2, Decimal("100"), Decimal("99"), None, None),         # fall came true
        (5, "B", d("2024-01-01"), d("2024-01-03"), 7, Decimal("100"), Decimal("99"), None, None),         # unknown direction
        (6, "B", d("2024-01-01"), d("2024-01-03"), 1, Decimal("100"), Decimal("0"), None, None),          # price_end 0: skipped
        (7, "B", d("2024-01-01"), d("2024-01-03"), 1, Decimal("100"), None, None, None),                  # no end price
        (8, "B", d("2024-01-01"), d("2024-03-05"), 1, Decimal("100"), Decimal("99"), None, None),         # not due
        (9, "C", d("2024-01-01"), d("2024-01-03"), 1, Decimal("100"), Decimal("99"), None, None),         # no quotes
        (10, "B", d("2024-01-01"), d("2024-01-03"), 1, Decimal("100"), Decimal("99"), 1, None),           # already closed
    ]
    out = {r["analyst_company_id"]: r for r in forecasts.close_forecasts(fc_frame(spark, rows), quotes, AS_OF).collect()}
    assert sorted(out) == [1, 2, 3, 4, 5]
    assert out[1]["end_real_price_delta"] == Decimal("2.000") and out[1]["forecast_result"] == 1
    assert out[2]["end_real_price_delta"] == Decimal("2.002")
    assert out[3]["end_real_price_delta"] == Decimal("0.000") and out[3]["forecast_result"] == 3
    assert out[4]["forecast_result"] == 1
    assert out[5]["forecast_result"] is None
    assert out[1]["price_max_delta"] == Decimal("0.000") and out[1]["price_min_delta"] == Decimal("0.000")


def test_zero_start_price_gives_null_delta(spark, quotes):
    f = fc_frame(spark, [(1, "B", d("2024-01-01"), d("2024-01-03"), 1, Decimal("0"), Decimal("5"), None, None)])
    r = forecasts.close_forecasts(f, quotes, AS_OF).first()
    assert r["end_real_price_delta"] is None and r["forecast_result"] is None


def test_strategies_agree_on_random_skewed_data(spark):
    rng = random.Random(7)
    tickers = ["HOT"] * 6 + ["a", "b", "c"]   # one ticker holds most rows
    qrows, seen = [], set()
    for _ in range(1500):
        t = rng.choice(tickers)
        start = ts("2024-01-01 00:00:00").replace(day=rng.randint(1, 28), hour=rng.randint(0, 23),
                                                     minute=rng.choice([0, 10, 20, 30, 40, 50]))
        if (t, start) in seen:
            continue
        seen.add((t, start))
        end = start + (ts("2024-01-01 01:00:00") - ts("2024-01-01 00:00:00"))
        hi = None if rng.random() < 0.05 else Decimal(rng.choice(["100", "101", "102", "103.5"]))
        lo = Decimal(rng.choice(["90", "91", "92"]))
        qrows.append((t, start, end, hi, lo, Decimal(rng.randint(90, 110))))
    quotes = spark.createDataFrame(qrows, Q_SCHEMA)
    frows = []
    for i in range(300):
        sd = d("2024-01-01").replace(day=rng.randint(1, 25))
        ed = sd.replace(day=min(28, sd.day + rng.randint(0, 6)))
        post = ts(f"{sd.isoformat()} {rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}:00")
        frows.append((i, rng.choice(tickers), sd, ed, 1, Decimal("100"), Decimal("101"), None, post))
    f = fc_frame(spark, frows)
    results = {}
    for strategy in STRATEGIES:
        ex = forecasts.span_extrema(f, quotes, strategy)
        fl = forecasts.price_forecasts(f.drop("price_start", "price_end", "forecast_result")
                                       .withColumn("price_delta_forecast", F.lit(5.0)),
                                       quotes, d("2024-02-01"), ts("2024-02-01 00:00:00"), strategy)
        results[strategy] = (sorted(map(tuple, ex.collect())),
                             sorted(map(tuple, fl.select("analyst_company_id", "price_start", "price_end").collect())))
    assert results["binned"] == results["rollup"]
    assert len(results["binned"][0]) > 200


def test_priced_forecast_prices(spark):
    quotes = spark.createDataFrame([
        q("A", ts("2024-01-01 10:00:00"), "1", "1", "50"),   # starts 09:00, before the post hour
        q("A", ts("2024-01-01 11:00:00"), "1", "1", "51"),   # starts 10:00, before the post at 10:25
        q("A", ts("2024-01-03 12:00:00"), "1", "1", "52"),   # starts 11:00 on end date: first after the post
        q("A", ts("2024-01-03 13:00:00"), "1", "1", "53"),   # starts 12:00 on end date: last
        q("A", ts("2024-01-03 14:00:00"), "1", "1", "54"),   # starts 13:00: after the span
    ], Q_SCHEMA)
    f = fc_frame(spark, [(1, "A", d("2024-01-01"), d("2024-01-03"), 1, None, None, None,
                          ts("2024-01-01 10:25:00"))]).drop("price_start", "price_end", "forecast_result") \
        .withColumn("price_delta_forecast", F.lit(10.0))
    r = forecasts.price_forecasts(f, quotes, d("2024-02-01"), ts("2024-02-01 00:00:00")).first()
    assert r["price_start"] == Decimal("52") and r["price_end"] == Decimal("53")
    assert r["price_forecast"] == Decimal("57.2") and r["price_max_real"] is None
    # while the forecast is open (as_of before end date) no end price, span runs to now
    r2 = forecasts.price_forecasts(f, quotes, d("2024-01-02"), ts("2024-01-02 00:00:00")).first()
    assert r2["price_start"] is None and r2["price_end"] is None


def test_results_do_not_depend_on_session_zone(spark):
    from tidemark.sources import driver
    from conftest import SF_SMALL
    tk = driver.ticks(driver.table(spark, SF_SMALL, "events"))
    f = fc_frame(spark, [(1, "T8", d("2024-01-01"), d("2024-01-20"), 1, Decimal("100"), Decimal("101"), None,
                          ts("2024-01-01 00:30:00"))])

    def snapshot():
        q10 = sorted(map(tuple, driver.ten_minute_quotes(tk).collect()))
        q = driver.hourly_quotes(tk)
        ex = sorted(map(tuple, forecasts.span_extrema(f, q).collect()))
        return q10, ex

    base = snapshot()
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kathmandu")   # +05:45
        other = snapshot()
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        third = snapshot()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert base == other == third and len(base[1]) == 1


def test_as_of_defaults_to_today(spark, quotes):
    # every span is long over today, so with the default the forecast is due and closes
    f = fc_frame(spark, [(1, "B", d("2024-01-01"), d("2024-01-03"), 1, Decimal("100"), Decimal("99"), None, None)])
    assert forecasts.close_forecasts(f, quotes).count() == 1
    assert forecasts.active_forecasts(f.withColumn("end_date", F.date_add(F.current_date(), 3))).count() == 1


def test_prices_start_at_the_exact_post_time(spark):
    """A post at 10:40 is priced by the candle of 11:00, not by the one that was open before it."""
    f = spark.createDataFrame([(1, "A", d("2024-01-02"), d("2024-01-04"), ts("2024-01-02 10:40:00"), "1.5"), (1, "B", d("2024-01-02"), d("2024-01-04"), ts("2024-01-02 10:40:00"), "1.5")],
                              "analyst_company_id int, ticker string, start_date date, end_date date, date_inserted timestamp_ntz, price_delta_forecast string")
    f = f.withColumn("price_delta_forecast", F.col("price_delta_forecast").cast("double"))
    q = spark.createDataFrame([("A", ts("2024-01-02 10:00:00"), "1"), ("A", ts("2024-01-02 11:00:00"), "2"), ("A", ts("2024-01-04 12:00:00"), "3"),
                               ("B", ts("2024-01-02 10:00:00"), "9")], "ticker string, datetime_start timestamp_ntz, open_price string")
    q = q.withColumn("open_price", F.col("open_price").cast("decimal(16,6)"))
    for strategy in ("rollup", "binned"):
        rows = {r["ticker"]: r for r in forecasts.price_forecasts(f, q, d("2024-02-01"), ts("2024-02-01 00:00:00"), strategy).collect()}
        assert (rows["A"]["price_start"], rows["A"]["price_end"]) == (2, 3), strategy
        assert rows["B"]["price_start"] is None and rows["B"]["price_end"] is None
