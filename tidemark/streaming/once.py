"""Weblog events stored once (STM-1, STM-2): de-duplication bounded by an event-time watermark.

Two streams, run one after the other:

``start_split``
    parses landed lines and gives each event a place: ``untimed`` (no event
    time could be read; its ``event_time`` is the ingest time, which must not
    move any watermark), ``late`` (older than the newest event of the batches
    before by more than the delay) or ``timed``.
``start_once``
    streams the timed events through ``dropDuplicatesWithinWatermark`` and
    appends what is left to the stored events. State is kept for the delay only.

The mark that decides ``late`` is stored per batch, so a replayed batch is
split as before. It is never behind the watermark of the second stream, which
therefore drops repeated events only. A file that lands again adds nothing to the
stored events: what is recent is dropped there, all else is late.
"""

from __future__ import annotations

import datetime as _dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructType
from pyspark.storagelevel import StorageLevel

from tidemark import schemas
from tidemark.functions.dates import lit_ts
from tidemark.operators.spans import micros
from tidemark.plans import weblog as weblog_plan
from tidemark.sinks.tables import PARTITION, ChangeTable
from tidemark.streaming.streams import _trigger

#: What makes two events the same: everything a line says.
EVENT_KEY = ("IP", "Time", "URL", "page_visited", "page_params", "Status")


class Places:
    """The split events under ``root``, partitioned by place, stream and batch, and the marks of the batches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/places"
        self.schema = StructType(list(schemas.PAGE_VIEWS.fields)).add("place", StringType()).add(
            "stream_id", StringType()).add("batch_id", LongType())
        self.marks = ChangeTable(spark, f"{root.rstrip('/')}/marks", schemas.STREAM_MARKS, ["mark_id"])
        # an empty partitioned write makes the folder, so that reading needs no check
        spark.createDataFrame([], self.schema).write.mode("append").partitionBy("place", *PARTITION).parquet(self.root)

    def read(self, place: str) -> DataFrame:
        """All events of a place with their stream and batch."""
        return self.spark.read.schema(self.schema).parquet(self.root).filter(F.col("place") == place).drop("place")

    def mark_before(self, stream_id: str, batch_id: int) -> _dt.datetime | None:
        """Newest event time of this stream's earlier batches: one value."""
        earlier = (F.col("stream_id") == stream_id) & (F.col("batch_id") < batch_id)
        return self.marks.changes().filter(earlier).agg(F.max("newest")).first()[0]


def start_split(spark: SparkSession, source_dir: str, places: Places, checkpoint: str, delay: _dt.timedelta,
                now: _dt.datetime | None = None, stream_id: str = "weblog", processing_time: str | None = None,
                max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Parse landed lines and write each event to its place. ``now`` is the ingest time (default: the batch's own)."""
    r = spark.readStream.schema(schemas.WEBLOG).option("header", False)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    views = weblog_plan.page_views(r.csv(source_dir), lit_ts(now))

    def batch(df: DataFrame, batch_id: int) -> None:
        newest = places.mark_before(stream_id, batch_id)
        late = F.lit(False) if newest is None else F.col("event_time") < lit_ts(newest - delay)
        place = F.when(weblog_plan.untimed(), "untimed").when(late, "late").otherwise("timed")
        rows = df.select("*", place.alias("place"), F.lit(stream_id).alias("stream_id"),
                         F.lit(batch_id).cast("long").alias("batch_id")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("place", *PARTITION).parquet(places.root)
            mark = rows.filter(F.col("place") == "timed").agg(F.max("event_time").alias("newest"))
            places.marks.append(mark.select(F.lit(f"{stream_id}-{batch_id}").alias("mark_id"), "newest"), stream_id, batch_id,
                                now or _dt.datetime(1970, 1, 1), check_unique=False)
        finally:
            rows.unpersist()

    w = views.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _trigger(w, processing_time).start()


def start_once(spark: SparkSession, places: Places, out_dir: str, checkpoint: str, delay: _dt.timedelta,
               key: Sequence[str] = EVENT_KEY, processing_time: str | None = None) -> StreamingQuery:
    """Append the timed events to ``out_dir``, each ``key`` once within the delay.

    Events that say the same in every column of ``key`` count as one; give a
    request id there if the log has one.
    """
    rows = spark.readStream.schema(places.schema).parquet(places.root).filter(F.col("place") == "timed").drop("place", *PARTITION)
    # a watermark wants an instant: the zone-less time read as UTC, whatever the session's zone
    # one second more than the split's delay, as Spark also drops what lies on the watermark
    timed = rows.withColumn("_at", F.timestamp_micros(micros("event_time")))
    fresh = timed.withWatermark("_at", f"{math.ceil(delay.total_seconds()) + 1} seconds").dropDuplicatesWithinWatermark(list(key))
    w = (fresh.drop("_at").withColumn("event_date", F.to_date("event_time")).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", out_dir).partitionBy("event_date"))
    return _trigger(w, processing_time).start()
