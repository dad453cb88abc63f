"""Landed JSON feeds to typed rows: posts (SRC-5), candles (SRC-6),
instruments (SRC-7) and nested assets (SRC-8)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import dates, numbers, text
from tidemark.functions.arrays import explode_rows
from tidemark.operators.observed import observe
from tidemark.sources.files import parse_json

POST_PAGE = T.StructType(
    [T.StructField("analyst_company_id", T.IntegerType())] + list(schemas.POSTS_PAGE.fields))

# Fixed values of the instrument feed.
SECURITY_ASSET = "ASSET_TYPE_SECURITY"
SHARE_KIND = "INSTRUMENT_TYPE_SHARE"
DEFAULT_CURRENCY = "usd"
CANDLE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def array_counts(read: Column, path: Mapping[str, Column], array: Column) -> dict[str, Column]:
    """FLT-15: what to count of documents whose rows come from ``array``: all;
    those of which nothing could be read (``read`` NULL); for each step of
    ``path`` to the array those that have the steps before but not this one; and
    those whose array is empty."""
    counts, have = {"documents": F.lit(True), "unreadable": read.isNull()}, read.isNotNull()
    for name, c in path.items():
        counts[f"no_{name}"] = have & c.isNull()
        have = have & c.isNotNull()
    return counts | {"empty": F.size(array) == 0}


def post_items(pages: DataFrame) -> DataFrame:
    """SRC-5: one row per post item.

    Pages without ``payload`` or ``items`` and empty item lists yield no
    rows (FLT-15): ``explode`` drops NULL and empty arrays.
    """
    return _post_rows(parse_json(pages, POST_PAGE))


def observed_post_items(pages: DataFrame, stage: str = "posts") -> tuple[DataFrame, Observation]:
    """``post_items`` with FLT-15's counts of the pages that gave no rows."""
    doc, seen = observe(parse_json(pages, POST_PAGE), stage, array_counts(
        F.coalesce(F.col("analyst_company_id").cast("string"), F.col("payload").cast("string")),
        {"payload": F.col("payload"), "items": F.col("payload.items")}, F.col("payload.items")))
    return _post_rows(doc), seen


def _post_rows(doc: DataFrame) -> DataFrame:
    return explode_rows(doc, F.col("payload.items"), "item", "analyst_company_id").select(
        "analyst_company_id",
        F.col("item.id").alias("external_id"),
        F.col("item.inserted").alias("inserted"),
        F.col("item.content.text").alias("text"),
    )


def quotes_from_candles(responses: DataFrame) -> DataFrame:
    """SRC-6: candle responses to typed quote rows.

    Start time from the candle's ``time``; end = start + interval length
    (SCL-9); prices from ``{units, nano}`` (SCL-10).
    """
    return _candle_rows(parse_json(responses, schemas.CANDLES_RESPONSE))


def observed_quotes(responses: DataFrame, stage: str = "candles") -> tuple[DataFrame, Observation]:
    """``quotes_from_candles`` with FLT-15's counts of the responses that gave no rows."""
    doc, seen = observe(parse_json(responses, schemas.CANDLES_RESPONSE), stage, array_counts(
        F.coalesce("ticker", "interval", F.col("candles").cast("string")), {"candles": F.col("candles")}, F.col("candles")))
    return _candle_rows(doc), seen


def _candle_rows(doc: DataFrame) -> DataFrame:
    c = explode_rows(doc, F.col("candles"), "c", "ticker", "interval")
    start = F.try_to_timestamp(F.col("c.time"), F.lit(CANDLE_TIME_FORMAT)).cast("timestamp_ntz")
    return c.select(
        "ticker",
        start.alias("datetime_start"),
        dates.candle_end(start, F.col("interval")).alias("datetime_end"),
        numbers.units_nano("c.open").alias("open_price"),
        numbers.units_nano("c.close").alias("close_price"),
        numbers.units_nano("c.high").alias("high_price"),
        numbers.units_nano("c.low").alias("low_price"),
        F.col("c.volume").try_cast("long").alias("volume"),
    )


def instruments(lines: DataFrame) -> DataFrame:
    """SRC-7: instrument list to stock rows (before de-duplication)."""
    doc = parse_json(lines, schemas.INSTRUMENT)
    return doc.select(
        "ticker", "figi", F.col("name").alias("stock_name"),
        F.col("country_of_risk").alias("country_id"),
        text.default_if_empty("nominal.currency", DEFAULT_CURRENCY).alias("currency"),
        "lot", "class_code", "sector",
    )


def asset_shares(lines: DataFrame) -> DataFrame:
    """SRC-8 / FLT-16: shares of security assets.

    The asset filter runs before the explode and the kind filter inside it
    (``filter`` on the array), so non-share instruments never become rows.
    """
    doc = parse_json(lines, schemas.ASSET)
    shares = F.filter("instruments", lambda i: i.getField("instrument_kind") == SHARE_KIND)
    sec = doc.filter(F.col("type") == SECURITY_ASSET).withColumnRenamed("name", "stock_name")
    return (
        explode_rows(sec, shares, "i", "stock_name")
        .select(F.col("i.ticker").alias("ticker"), F.col("i.figi").alias("figi"),
                "stock_name", F.col("i.class_code").alias("class_code"))
    )
