"""T4: streaming twins equal their batch form; restarts add nothing."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, ts
from tidemark import schemas
from tidemark.functions.dates import lit_ts
from tidemark.plans import posts, quotes as quotes_plan, weblog
from tidemark.sinks.tables import ChangeTable
from tidemark.sources import driver, feeds
from tidemark.streaming import streams

NOW = ts("2024-02-01 00:00:00")


def _land_text(df, folder, parts):
    """Write a text column as ``parts`` separate files (landing order)."""
    rows = [r[0] for r in df.collect()]
    os.makedirs(folder, exist_ok=True)
    step = (len(rows) + parts - 1) // parts
    for i in range(parts):
        with open(os.path.join(folder, f"part-{i:03d}.txt"), "w") as fh:
            fh.write("\n".join(rows[i * step:(i + 1) * step]) + "\n")


def test_weblog_stream_equals_batch(spark, tmp_dir):
    lines = driver.weblog_lines(driver.table(spark, SF_SMALL, "events"))
    src = f"{tmp_dir}/weblog"
    csv_rows = lines.select(F.concat_ws(",", "IP", "Time", "URL", "Status")).collect()
    os.makedirs(src)
    for i in range(3):
        with open(f"{src}/log-{i}.csv", "w") as fh:
            fh.write("\n".join(r[0] for r in csv_rows[i::3]) + "\n")
    out, ck = f"{tmp_dir}/out", f"{tmp_dir}/ck"
    streams.start_weblog(spark, src, out, ck, max_files_per_trigger=1).awaitTermination()
    cols = ["IP", "Time", "URL", "page_visited", "page_params", "Status", "event_time", "tags"]
    streamed = spark.read.parquet(out).select(*cols)
    batch = weblog.page_views(spark.read.schema(schemas.WEBLOG).csv(src), lit_ts(NOW)).select(*cols)
    # event_time falls back to the ingest time only for unparsable times
    keep = F.array_contains("tags", "_dateparsefailure")
    s_rows = sorted(map(repr, streamed.filter(~keep).collect()))
    b_rows = sorted(map(repr, batch.filter(~keep).collect()))
    assert s_rows == b_rows and len(s_rows) > 0
    assert streamed.count() == batch.count() == len(csv_rows)
    # restart from the checkpoint: nothing new is read
    streams.start_weblog(spark, src, out, ck).awaitTermination()
    assert spark.read.parquet(out).count() == len(csv_rows)


def test_quotes_stream_replays_and_starts_over(spark, tmp_dir):
    tk = driver.ticks(driver.table(spark, SF_SMALL, "events"))
    q = driver.hourly_quotes(tk)
    src = f"{tmp_dir}/candles"
    _land_text(driver.candle_responses(q), src, 4)
    table = ChangeTable(spark, f"{tmp_dir}/quotes", schemas.QUOTES, quotes_plan.QUOTE_KEY)
    streams.start_quotes(spark, src, table, f"{tmp_dir}/ck", NOW, max_files_per_trigger=1).awaitTermination()
    assert table.changes().select("batch_id").distinct().count() == 4
    cols = ["ticker", "datetime_start", "datetime_end", "open_price", "close_price", "high_price", "low_price", "volume"]
    want = sorted(map(tuple, q.select(*cols).collect()))
    assert sorted(map(tuple, table.read().select(*cols).collect())) == want
    # a second stream whose batch numbers start at 0 again: changed prices arrive, new rows stay
    more = q.withColumn("close_price", (F.col("close_price") + 1).cast("decimal(16,6)")).withColumn("ticker", F.concat("ticker", F.when(F.col("volume") > 1, "x").otherwise("")))
    _land_text(driver.candle_responses(more), f"{tmp_dir}/again", 2)
    later = NOW + dt.timedelta(hours=1)
    streams.start_quotes(spark, f"{tmp_dir}/again", table, f"{tmp_dir}/ck2", later, stream_id="again").awaitTermination()
    after = {(r[0], r[1]): tuple(r) for r in q.select(*cols).collect()}
    after.update({(r[0], r[1]): tuple(r) for r in more.select(*cols).collect()})
    assert sorted(map(tuple, table.read().select(*cols).collect())) == sorted(after.values()) and len(after) > len(want)


def test_posts_stream_equals_batch(spark, tmp_dir):
    ev = driver.table(spark, SF_SMALL, "events")
    src = f"{tmp_dir}/posts"
    _land_text(driver.post_pages(ev), src, 3)
    fc = ChangeTable(spark, f"{tmp_dir}/forecasts", schemas.FORECASTS, ["analyst_company_id", "ticker", "start_date"],
                     order=["date_inserted", "external_id"])
    ind = ChangeTable(spark, f"{tmp_dir}/indicators", schemas.INDICATORS, ["indicator_name"])
    log = ChangeTable(spark, f"{tmp_dir}/parser_log", schemas.PARSER_LOG, ["run_id", "analyst_company_id"])
    streams.start_posts(spark, src, fc, ind, f"{tmp_dir}/rejected", f"{tmp_dir}/ck", NOW,
                          max_files_per_trigger=1, parser_log=log).awaitTermination()
    from tidemark.sources.files import read_json_lines
    items = feeds.post_items(read_json_lines(spark, src))
    batch = posts.latest_forecasts(posts.parse_forecasts(items))
    key = ["analyst_company_id", "ticker", "start_date"]
    got = sorted(map(tuple, fc.read().select(*key, "end_date", "external_id").collect()))
    want = sorted(map(tuple, batch.select(*key, "end_date", "external_id").collect()))
    assert got == want and len(got) > 0
    assert sorted(r[0] for r in ind.read().select("indicator_name").collect()) == \
        sorted(r[0] for r in posts.new_indicators(batch).select("indicator_name").collect())
    assert spark.read.parquet(f"{tmp_dir}/rejected").count() == posts.rejected_blocks(items).count()
    # the last run per company carries the newest post time: the next run's high-water mark
    from tidemark.operators.highwater import last_run
    hw = {r["analyst_company_id"]: r["hwm"] for r in last_run(log.read()).collect()}
    newest = {r[0]: r[1] for r in items.selectExpr("analyst_company_id", "substring_index(inserted, '.', 1) AS t")
              .groupBy("analyst_company_id").agg(F.max("t")).collect()}
    assert sorted(hw) == sorted(newest) and log.changes().select("batch_id").distinct().count() == 3
    assert all(hw[k] == dt.datetime.fromisoformat(v) for k, v in newest.items())
    # the same checkpoint's batches again (a replay after a crash) change nothing, rejected rows included
    before = sorted(map(repr, fc.read().collect())), sorted(map(repr, spark.read.parquet(f"{tmp_dir}/rejected").collect()))
    streams.start_posts(spark, src, fc, ind, f"{tmp_dir}/rejected", f"{tmp_dir}/ck-copy", NOW,
                        max_files_per_trigger=1, parser_log=log).awaitTermination()
    assert (sorted(map(repr, fc.read().collect())), sorted(map(repr, spark.read.parquet(f"{tmp_dir}/rejected").collect()))) == before


def test_console_sink_runs(spark, tmp_dir):
    src = f"{tmp_dir}/w"
    os.makedirs(src)
    with open(f"{src}/a.csv", "w") as fh:
        fh.write("10.0.0.1,[01/Jan/2024:00:00:01,GET /x.php HTTP/1.1,200\n")
    q = streams.start_console(streams.weblog_events(spark, src), rows=5)
    q.awaitTermination()
    assert q.lastProgress["numInputRows"] == 1


@pytest.mark.parametrize("make", ["_posts_stream", "_faulty_posts_stream"])
def test_posts_land_from_all_tasks(spark, monkeypatch, make):
    """The events of one file are dealt out before their pages are written."""
    from tidemark import catalog

    class Seen(Exception):
        pass

    def land(df, folder, **more):
        raise Seen(df.rdd.getNumPartitions())

    monkeypatch.setattr(streams, "land", land)
    with pytest.raises(Seen) as seen:
        getattr(catalog, make)(spark, SF_SMALL)
    assert seen.value.args[0] == int(spark.conf.get("spark.sql.shuffle.partitions"))
