"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 3), BENCH_QUERIES (comma list, default headline set).

Each query is executed in full with the ``noop`` sink (every row is
produced, nothing is collected to the driver); the reported time is the
median of the repeats after one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import catalog  # noqa: E402
from tidemark.plans import forecasts  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "district_mart",
    "span_extrema",
    "span_extrema_binned",
    "rise_outcomes",
    "fall_outcomes",
    "effectiveness_report",
    "page_views",
    "upsert_quotes",
    "parsed_forecasts",
    "priced_forecasts",
    "dense_span_rollup",
    "dense_span_binned",
]


def _span_variant(strategy):
    def run(spark, sf_dir):
        c = catalog.Chain(spark, sf_dir)
        due = forecasts.due_forecasts(c.priced(strategy=strategy), catalog.AS_OF)
        return forecasts.span_extrema(due, c.quotes, strategy)
    return run


def _dense_spans(strategy):
    """Range join on dense candles: the same events folded onto ten tickers,
    so every ticker has a candle in almost every hour (about 24 per day),
    and one forecast span per purchase event (1 to 10 days)."""
    def run(spark, sf_dir):
        from pyspark.sql import functions as F
        from tidemark.sources import driver
        ev = driver.table(spark, sf_dir, "events")
        tk = driver.ticks(ev.withColumn("user_id", F.col("user_id") % 10))
        q = driver.hourly_quotes(tk)
        start = F.to_date("ts")
        f = ev.filter(F.col("event_type") == "purchase").select(
            F.col("event_id").cast("int").alias("analyst_company_id"),
            F.concat(F.lit("T"), (F.col("user_id") % 10).cast("string")).alias("ticker"),
            start.alias("start_date"),
            F.date_add(start, (F.lit(1) + F.col("event_id") % 10).cast("int")).alias("end_date"))
        return forecasts.span_extrema(f, q, strategy)
    return run


EXTRA = {
    "span_extrema_binned": _span_variant("binned"),
    "dense_span_rollup": _dense_spans("rollup"),
    "dense_span_binned": _dense_spans("binned"),
    "dense_span_dyadic": _dense_spans("dyadic"),
    "span_extrema_dyadic": _span_variant("dyadic"),
}


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", app_name="tidemark-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    results = {}
    for name in names:
        fn = EXTRA.get(name) or catalog.QUERIES[name]
        run_once(spark, fn, sf_dir)  # warm-up: JIT, file listing, metadata caches
        times = [run_once(spark, fn, sf_dir) for _ in range(repeats)]
        results[name] = round(statistics.median(times), 3)
    spark.stop()
    sf = sf_dir.rsplit("sf", 1)[-1]
    try:
        sf_val = float(sf)
    except ValueError:
        sf_val = sf
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": sf_val,
        "cpus": cpus,
        "repeats": repeats,
    }))


if __name__ == "__main__":
    main()
