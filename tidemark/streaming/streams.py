"""Structured Streaming twins of the incremental steps (STM-1..7).

Each stream reads landed files with a declared schema; the file source's
checkpoint is the high-water mark (processed files are never read again).
Triggers are ``availableNow`` by default: one invocation drains what has
landed and stops, which is how a scheduler (STM-7) runs it every few
minutes; pass ``processing_time="10 minutes"`` for a long-running query.
Keyed outputs go through ``foreachBatch`` into change tables, where the
partition (stream id, batch id) of a replayed batch is replaced by itself
(STM-6). ``stream_id`` names one checkpoint: a stream that starts over with a
new checkpoint takes a new id.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from tidemark import schemas
from tidemark.operators import highwater, observed
from tidemark.plans import posts as posts_plan
from tidemark.plans import quotes as quotes_plan
from tidemark.plans import weblog as weblog_plan
from tidemark.sinks.tables import ChangeTable
from tidemark.sources import feeds


def _trigger(writer, processing_time: str | None):
    return writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)


# --- weblog (STM-1, STM-2, STM-3, SNK-8) -------------------------------------------

def weblog_events(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None,
                  ingest_time=None) -> DataFrame:
    """SRC-4: tail the weblog folder from the beginning, headerless CSV.

    ``ingest_time`` defaults to the micro-batch's processing time (STM-2).
    """
    r = spark.readStream.schema(schemas.WEBLOG).option("header", False)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = r.csv(source_dir)
    if ingest_time is None:
        ingest_time = F.current_timestamp().cast("timestamp_ntz")
    return weblog_plan.page_views(lines, ingest_time)


def start_weblog(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str,
                 processing_time: str | None = None, max_files_per_trigger: int | None = None,
                 ingest_time=None) -> StreamingQuery:
    """STM-1: parse, type, timestamp and append page views as parquet
    documents partitioned by event date (with exact-match copies, SNK-8)."""
    docs = weblog_plan.index_documents(weblog_events(spark, source_dir, max_files_per_trigger, ingest_time))
    w = (docs.withColumn("event_date", F.to_date("event_time"))
         .writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", out_dir)
         .partitionBy("event_date"))
    return _trigger(w, processing_time).start()


# --- posts (STM-4, SNK-3, SNK-5, SNK-7) ----------------------------------------------

def _landed(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None) -> DataFrame:
    r = spark.readStream.schema("value string")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(source_dir)


def start_posts(spark: SparkSession, source_dir: str, forecasts: ChangeTable, indicators: ChangeTable,
                rejected_dir: str, checkpoint: str, now: _dt.datetime, stream_id: str = "posts",
                processing_time: str | None = None, max_files_per_trigger: int | None = None,
                parser_log: ChangeTable | None = None, counts: ChangeTable | None = None) -> StreamingQuery:
    """STM-4: parse newly landed post pages, upsert forecasts and new
    indicators per micro-batch, append rejected blocks to a quarantine.

    ``forecasts`` is ordered by the post time, so a stored forecast is changed
    by a newer post only (Q11); this table holds what was parsed, evaluation
    results are kept apart and never touched (Q20). Only unknown indicator
    names are inserted (Q26); a replayed batch replaces its own indicators,
    so names it brought itself do not count as known.

    With ``parser_log`` each micro-batch also records a run (SNK-7), keyed by
    the batch id: opened before the first write, and after the last replaced by
    the closed record, per company the newest post time and its id, which
    ``operators.highwater.last_run`` reads back. A batch that dies in between
    leaves an open run (``operators.highwater.open_runs``); the stream redoes it
    when it starts again. ``counts`` keeps how many pages gave no posts and
    why (FLT-15), and how many blocks were rejected.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        if parser_log is not None:
            parser_log.append(highwater.open_run(spark, batch_id, now), stream_id, batch_id, now, check_unique=False)
        items, pages = feeds.observed_post_items(df)
        parsed, found = observed.observe(posts_plan.blocks(items), "blocks", {
            "blocks": F.lit(True), "rejected": F.col("reason").isNotNull()})
        # One micro-batch feeds several writes: parse it once and keep the
        # (bounded) result for the batch; it is recomputable if an executor is lost.
        blocks = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _post_batch(blocks, batch_id)
            if counts is not None:
                observed.store_counts(counts, {"posts": pages, "blocks": found}, stream_id, batch_id, now)
            if parser_log is not None:
                rec = highwater.run_record(blocks.select("analyst_company_id", "external_id", "date_inserted"),
                                           batch_id, now, now)
                parser_log.append(rec, stream_id, batch_id, now, check_unique=False)
        finally:
            blocks.unpersist()

    def _post_batch(blocks: DataFrame, batch_id: int) -> None:
        blocks.filter(F.col("reason").isNotNull()).write.mode("overwrite").parquet(
            f"{rejected_dir}/stream={stream_id}/batch={batch_id}")
        good = blocks.filter(F.col("reason").isNull()).drop("reason")
        start = F.to_date("date_inserted")
        parsed = good.withColumn("start_date", start).withColumn("end_date", F.date_add(start, F.col("term")))
        latest = posts_plan.latest_forecasts(parsed)
        own = (F.col("stream_id") == stream_id) & (F.col("batch_id") == batch_id)
        new_ind = posts_plan.new_indicators(latest, indicators.changes().filter(~own))
        indicators.append(new_ind, stream_id, batch_id, now)
        forecasts.append(latest, stream_id, batch_id, now)

    w = _landed(spark, source_dir, max_files_per_trigger).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _trigger(w, processing_time).start()


# --- quotes (STM-5, STM-6, SNK-6) ------------------------------------------------------

def start_quotes(spark: SparkSession, source_dir: str, quotes: ChangeTable,
                 checkpoint: str, now: _dt.datetime, stream_id: str = "quotes",
                 starts: DataFrame | None = None, processing_time: str | None = None,
                 max_files_per_trigger: int | None = None, marks: ChangeTable | None = None,
                 used: ChangeTable | None = None) -> StreamingQuery:
    """STM-5/6: landed candle responses to typed quotes, de-duplicated and
    stored by (ticker, datetime_start) once per micro-batch.

    ``starts`` (ticker, fetch_from) limits each ticker to candles from its own
    start on, as ``plans.quotes.fetch_starts`` gives it. With ``marks``, the
    high-water marks that ``start_quote_marks`` keeps, each micro-batch begins
    where the stored candles end. The starts that it used are kept in ``used``: a
    batch that is done again after a crash takes the same ones, although the
    marks may have moved over its own candles since."""
    candles = feeds.quotes_from_candles(_landed(spark, source_dir, max_files_per_trigger))
    if (marks is None) != (used is None):
        raise ValueError("marks and used belong together")

    def starts_of(batch_id: int) -> DataFrame:
        rows = used.changes().filter((F.col("stream_id") == stream_id) & (F.col("batch_id") == batch_id))
        return rows.select("ticker", "fetch_from")

    def batch(df: DataFrame, batch_id: int) -> None:
        if marks is not None:
            if starts_of(batch_id).isEmpty():
                used.append(quotes_plan.moved_starts(marks.read(), starts), stream_id, batch_id, now)
            df = quotes_plan.incremental_quotes(df, starts_of(batch_id), others=starts is None)
        elif starts is not None:
            df = quotes_plan.incremental_quotes(df, starts)
        b = quotes_plan.dedup_quote_batch(df).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            quotes.append(b, stream_id, batch_id, now)
        finally:
            b.unpersist()

    w = candles.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _trigger(w, processing_time).start()


def start_quote_marks(spark: SparkSession, quotes: ChangeTable, marks: ChangeTable, checkpoint: str, now: _dt.datetime,
                      stream_id: str = "marks", processing_time: str | None = None) -> StreamingQuery:
    """STM-5 with AGG-7: the newest stored candle end per ticker, kept beside the quotes.

    Streams what is written to ``quotes`` into one running maximum per ticker
    (state of one row per ticker, combined in every task before it moves) and
    stores the tickers that a batch changed. A maximum takes a replayed
    batch's rows twice without harm."""
    rows = spark.readStream.schema(quotes.stored).parquet(quotes.root)
    newest = highwater.latest_per_key(rows, "ticker", "datetime_end", "high_water")

    def batch(df: DataFrame, batch_id: int) -> None:
        marks.append(df, stream_id, batch_id, now, check_unique=False)

    w = newest.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _trigger(w, processing_time).start()


def land(df: DataFrame, folder: str, files: int | None = None, fmt: str = "text") -> str:
    """Write ``df`` as a feed drop, for replays and tests; ``files`` fixes the number of files."""
    (df.repartition(files) if files else df).write.mode("errorifexists").format(fmt).save(folder)
    return folder


def start_console(stream: DataFrame, rows: int = 20, processing_time: str | None = None) -> StreamingQuery:
    """SNK-2 (streaming): print each micro-batch for debugging."""
    w = stream.writeStream.format("console").option("numRows", rows).option("truncate", False)
    return _trigger(w, processing_time).start()
