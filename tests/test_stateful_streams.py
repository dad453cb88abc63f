"""Streams with state: events stored once, moving high-water marks, runs opened and closed, counts by batch."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, ts
from tidemark import schemas
from tidemark.operators import highwater, observed
from tidemark.plans import quotes as quotes_plan
from tidemark.sinks.tables import ChangeTable
from tidemark.sources import driver, feeds
from tidemark.streaming import once, streams

NOW = ts("2024-02-01 00:00:00")
DELAY = dt.timedelta(hours=1)


def write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def forget_commit(checkpoint, batch):
    """As if the batch had died before it was recorded as done."""
    for name in (f"{batch}", f".{batch}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")


def line(time, page="a", ip="10.0.0.1"):
    return f"{ip},[{time},GET /{page}.php HTTP/1.1,200 "


def run_weblog(spark, tmp_dir):
    places = once.Places(spark, f"{tmp_dir}/w")
    once.start_split(spark, f"{tmp_dir}/in", places, f"{tmp_dir}/ck1", DELAY, NOW).awaitTermination()
    once.start_once(spark, places, f"{tmp_dir}/out", f"{tmp_dir}/ck2", DELAY).awaitTermination()
    cols = ["Time", "page_visited"]
    got = {p: sorted(map(tuple, places.read(p).select(*cols).collect())) for p in ("late", "untimed")}
    return got | {"stored": sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/out").select(*cols).collect()))}


def test_replayed_late_and_untimed_events_have_their_places(spark, tmp_dir):
    first = [line("01/Jan/2024:10:00:00"), line("01/Jan/2024:10:00:00"), line("01/Jan/2024:11:30:00", "b"), line("no time", "n"),
             line("01/Jan/2024:10:00:00", ip="10.0.0.2")]
    write_lines(f"{tmp_dir}/in", "a.csv", first)
    got = run_weblog(spark, tmp_dir)
    stored = [("01/Jan/2024:10:00:00", "/a.php")] * 2 + [("01/Jan/2024:11:30:00", "/b.php")]
    assert got == {"stored": stored, "late": [], "untimed": [("no time", "/n.php")]}
    # 10:30 is the mark now: the same file again, one older and one just in time
    write_lines(f"{tmp_dir}/in", "b.csv", first + [line("01/Jan/2024:10:29:59", "old"), line("01/Jan/2024:10:30:00", "late enough")])
    got = run_weblog(spark, tmp_dir)
    stored += [("01/Jan/2024:10:30:00", "/late")]
    assert got["stored"] == sorted(stored)
    assert got["late"] == [("01/Jan/2024:10:00:00", "/a.php")] * 3 + [("01/Jan/2024:10:29:59", "/old.php")]
    assert got["untimed"] == [("no time", "/n.php")] * 2
    # untimed events carry the ingest time and must not have moved the mark
    write_lines(f"{tmp_dir}/in", "c.csv", [line("01/Jan/2024:10:45:00", "c"), line("01/Jan/2024:13:00:00", "d")])
    got = run_weblog(spark, tmp_dir)
    stored += [("01/Jan/2024:10:45:00", "/c.php"), ("01/Jan/2024:13:00:00", "/d.php")]
    assert got["stored"] == sorted(stored)
    # nothing new has landed
    assert run_weblog(spark, tmp_dir) == got


def test_replayed_split_batch_keeps_its_places(spark, tmp_dir):
    for n, time in enumerate(("10:00:00", "12:00:00", "10:30:00")):
        write_lines(f"{tmp_dir}/in", f"{n}.csv", [line(f"01/Jan/2024:{time}", f"p{n}")])
        before = run_weblog(spark, tmp_dir)
    assert before["late"] == [("01/Jan/2024:10:30:00", "/p2.php")]
    forget_commit(f"{tmp_dir}/ck1", 2)
    assert run_weblog(spark, tmp_dir) == before


def quote_tables(spark, tmp_dir):
    return (ChangeTable(spark, f"{tmp_dir}/q", schemas.QUOTES, quotes_plan.QUOTE_KEY),
            ChangeTable(spark, f"{tmp_dir}/m", schemas.QUOTE_MARKS, ["ticker"], order=["high_water"]),
            ChangeTable(spark, f"{tmp_dir}/u", schemas.BATCH_STARTS, ["ticker"]))


def test_second_batch_starts_where_the_first_ended(spark, tmp_dir):
    q = driver.hourly_quotes(driver.ticks(driver.table(spark, SF_SMALL, "events")))
    table, marks, used = quote_tables(spark, tmp_dir)

    def run(starts=None):
        streams.start_quotes(spark, f"{tmp_dir}/in", table, f"{tmp_dir}/ck", NOW, starts=starts, marks=marks, used=used).awaitTermination()
        streams.start_quote_marks(spark, table, marks, f"{tmp_dir}/ckm", NOW).awaitTermination()

    cut = F.lit(ts("2024-01-10 00:00:00"))
    streams.land(driver.candle_responses(q.filter(F.col("datetime_start") < cut)), f"{tmp_dir}/in/a=1")
    run()
    first = {r.ticker: r.high_water for r in marks.read().collect()}
    assert first == {r[0]: r[1] for r in q.filter(F.col("datetime_start") < cut).groupBy("ticker").agg(F.max("datetime_end")).collect()}
    changed = q.withColumn("volume", F.col("volume") + 1000)
    streams.land(driver.candle_responses(changed), f"{tmp_dir}/in/a=2")
    run()
    rows = table.read().select("ticker", "datetime_start", "volume").collect()
    assert len(rows) == q.count()
    for r in rows:
        assert (r.volume > 1000) == (r.ticker not in first or r.datetime_start >= first[r.ticker])
    # the second batch is done again although the marks have passed its candles: nothing is lost
    before = sorted(map(tuple, rows))
    forget_commit(f"{tmp_dir}/ck", 1)
    run()
    assert sorted(map(tuple, table.read().select("ticker", "datetime_start", "volume").collect())) == before
    with pytest.raises(ValueError):
        streams.start_quotes(spark, f"{tmp_dir}/in", table, f"{tmp_dir}/ck9", NOW, marks=marks)


def test_starts_move_up_to_the_marks(spark):
    starts = spark.createDataFrame([("A", ts("2024-01-05 00:00:00")), ("B", ts("2024-01-05 00:00:00"))], "ticker string, fetch_from timestamp_ntz")
    marks = spark.createDataFrame([("A", ts("2024-01-07 00:00:00")), ("C", ts("2024-01-07 00:00:00"))], "ticker string, high_water timestamp_ntz")
    got = {r.ticker: r.fetch_from.day for r in quotes_plan.moved_starts(marks, starts).collect()}
    assert got == {"A": 7, "B": 5}
    assert {r.ticker for r in quotes_plan.moved_starts(marks).collect()} == {"A", "C"}


def test_a_run_that_dies_stays_open_and_is_redone(spark, tmp_dir):
    streams.land(driver.post_pages(driver.table(spark, SF_SMALL, "events"), faults=True), f"{tmp_dir}/in")
    key = ["analyst_company_id", "ticker", "start_date"]
    fc = ChangeTable(spark, f"{tmp_dir}/f", schemas.FORECASTS, key, order=["date_inserted", "external_id"])
    ind = ChangeTable(spark, f"{tmp_dir}/i", schemas.INDICATORS, ["indicator_name"])
    log = ChangeTable(spark, f"{tmp_dir}/l", schemas.PARSER_LOG, ["run_id", "analyst_company_id"])
    counts = ChangeTable(spark, f"{tmp_dir}/c", schemas.OBSERVED, ["stage", "metric"])

    def run():
        streams.start_posts(spark, f"{tmp_dir}/in", fc, ind, f"{tmp_dir}/r", f"{tmp_dir}/ck", NOW, parser_log=log, counts=counts).awaitTermination()

    real, fc.append = fc.append, None     # the write of the forecasts fails
    with pytest.raises(Exception):
        run()
    died = highwater.open_runs(log.read()).collect()
    assert [(r.run_id, r.analyst_company_id, r.end_time) for r in died] == [(0, None, None)]
    assert highwater.last_run(log.read()).count() == 0 and fc.read().count() == 0
    fc.append = real
    run()
    assert highwater.open_runs(log.read()).count() == 0 and fc.read().count() > 0
    assert log.read().count() == 3 and log.read().select("run_id").distinct().count() == 1
    got = {(r.stage, r.metric): r.rows for r in observed.total_counts(counts).collect()}
    n = {k: driver.table(spark, SF_SMALL, "events").filter(f"event_id % 20 = {k}").count() for k in (3, 8, 13, 18)}
    assert got["posts", "no_payload"] == n[3] and got["posts", "no_items"] == n[8]
    assert got["posts", "empty"] == n[13] and got["posts", "unreadable"] == n[18]


def test_counts_need_no_second_scan(spark, tmp_dir):
    ev = driver.table(spark, SF_SMALL, "events")
    items, seen = feeds.observed_post_items(driver.post_pages(ev, faults=True))
    plan = items._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") == 1
    items.write.parquet(f"{tmp_dir}/items")
    assert seen.get["documents"] == ev.count()
    plain = feeds.post_items(driver.post_pages(ev, faults=True))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/items").collect()))


def test_candles_without_arrays_are_counted(spark):
    rows = ['{"ticker":"A","interval":"x","candles":[]}', '{"ticker":"A"}', "junk", '{"ticker":"B","candles":[{"time":"2024-01-01T00:00:00Z"}]}', None]
    df, seen = feeds.observed_quotes(spark.createDataFrame([(r,) for r in rows], "value string"))
    assert df.count() == 1
    assert seen.get == {"documents": 5, "unreadable": 2, "no_candles": 1, "empty": 1}
