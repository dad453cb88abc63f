"""Weblog line to page-view event (DOM-9) and its indexed form (SNK-8).

Failures never drop an event: each failed step adds a tag (STM-3) and
leaves its input field in place, as the line-oriented original does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import weblog_time
from tidemark.functions.text import keyword, strip_prefix, strip_whitespace, uri_params, uri_path

# Event type and failure tags.
EVENT_TYPE = "weblog"
TAG_PATTERN = "_grokparsefailure"
TAG_PREFIX = "_dissectfailure"
TAG_DATE = "_dateparsefailure"
TAG_CONVERT = "_convertfailure"
TIME_PREFIX = "["
KEYWORD_FIELDS = ("IP", "URL", "page_params", "page_visited", "tags", "type")


def page_views(lines: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """DOM-9: parse (IP, Time, URL, Status) text rows into typed page views.

    * Status: whitespace removed (SCL-3), integer (SCL-6, Q13).
    * URL: path and query string (SCL-4); removed only when matched (PRJ-6).
    * Time: leading ``[`` removed (SCL-5), parsed (SCL-7); ``event_time``
      falls back to the ingest time (STM-2).
    """
    ingest = ingest_time if ingest_time is not None else F.current_timestamp().cast("timestamp_ntz")
    status_txt = strip_whitespace("Status")
    status = status_txt.try_cast("int")
    page = uri_path("URL")
    params = uri_params("URL")
    time_txt = strip_prefix("Time", TIME_PREFIX)
    time_val = F.coalesce(time_txt, F.col("Time"))
    parsed = weblog_time(time_val)
    tags = F.array_compact(F.array(
        F.when(page.isNull(), F.lit(TAG_PATTERN)),
        F.when(time_txt.isNull(), F.lit(TAG_PREFIX)),
        F.when(status.isNull() & (status_txt != ""), F.lit(TAG_CONVERT)),
        F.when(parsed.isNull(), F.lit(TAG_DATE)),
    ))
    return lines.select(
        "IP",
        time_val.alias("Time"),
        F.when(page.isNull(), F.col("URL")).alias("URL"),
        page.alias("page_visited"),
        params.alias("page_params"),
        status.alias("Status"),
        F.coalesce(parsed, ingest).alias("event_time"),
        F.lit(EVENT_TYPE).alias("type"),
        tags.alias("tags"),
    )


def untimed() -> Column:
    """STM-2: the event's own time could not be read (``event_time`` is the ingest time)."""
    return F.array_contains("tags", TAG_DATE)


def clean_views(views: DataFrame) -> DataFrame:
    """Q14: the default view without tagged (failed) events."""
    return views.filter(F.size("tags") == 0)


def page_view_counts(views: DataFrame) -> DataFrame:
    """Views per (page, params, status) with first and last event time."""
    return views.groupBy("page_visited", "page_params", "Status").agg(
        F.count(F.lit(1)).alias("views"),
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
    )


def index_documents(views: DataFrame) -> DataFrame:
    """SNK-8 / SCL-12: search documents with exact-match copies of the text
    fields (of each tag), kept only up to 256 characters; Status and Time stay as they are."""
    def copy(c: str) -> Column:
        each = F.filter(F.col(c), lambda t: keyword(t).isNotNull()) if c == "tags" else keyword(c)
        return each.alias(c + "_keyword")

    return views.select("*", *[copy(c) for c in KEYWORD_FIELDS if c in views.columns])


def keyword_fields(docs: DataFrame, fields=("text", "lang", "source")) -> DataFrame:
    """SCL-12 on any text table: ``<field>_keyword`` copies up to 256 characters."""
    return docs.select("*", *[keyword(c).alias(c + "_keyword") for c in fields])
