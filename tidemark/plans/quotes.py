"""Quote maintenance: per-ticker fetch starts (AGG-7, FLT-10, STM-5, Q21),
incremental candles, batch de-duplication (DUP-3) and the keyed upsert."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import keep_best
from tidemark.operators.highwater import latest_per_key
from tidemark.operators.spans import micros
from tidemark.operators.upsert import upsert

QUOTE_KEY = ["ticker", "datetime_start"]
QUOTE_VALUES = ["datetime_end", "open_price", "close_price", "high_price", "low_price", "volume"]


def quote_high_water(quotes: DataFrame, active: DataFrame) -> DataFrame:
    """AGG-7 + FLT-10: newest stored candle end per ticker of an active
    forecast (a semi join instead of a literal ticker list)."""
    q = quotes.join(active.select("ticker"), "ticker", "left_semi")
    return latest_per_key(q, "ticker", "datetime_end", "date_inserted")


def fetch_starts(quotes: DataFrame, active: DataFrame) -> DataFrame:
    """STM-5 + Q21: where to fetch from, per ticker of an active forecast.

    The newest stored candle end, or, for a ticker without stored candles,
    the earliest post time of its active forecasts.
    """
    posted = active.groupBy("ticker").agg(F.min("date_inserted").alias("_posted"))
    hw = quote_high_water(quotes, active)
    return posted.join(hw, "ticker", "left").select(
        "ticker", F.coalesce(F.col("date_inserted"), F.col("_posted")).alias("fetch_from"))


def incremental_quotes(incoming: DataFrame, starts: DataFrame, others: bool = False) -> DataFrame:
    """STM-5: incoming candles at or after each ticker's fetch start; those of
    tickers without a start are left out or, with ``others``, taken whole."""
    due = F.col("datetime_start") >= F.col("fetch_from")
    return incoming.join(starts, "ticker", "left" if others else "inner").filter(
        due | F.col("fetch_from").isNull() if others else due).drop("fetch_from")


def moved_starts(marks: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """STM-5 with AGG-7: fetch starts moved up to the stored high-water marks.

    With ``starts`` only its tickers are fetched, each from the later of the
    two; without, every mark is a start.
    """
    m = marks.select("ticker", "high_water")
    if starts is None:
        return m.withColumnRenamed("high_water", "fetch_from")
    return starts.join(m, "ticker", "left").select("ticker", F.greatest("fetch_from", "high_water").alias("fetch_from"))


def dedup_quote_batch(batch: DataFrame) -> DataFrame:
    """DUP-3: one candle per (ticker, datetime_start): the shortest candle
    (earliest end), then the one with the larger volume."""
    return keep_best(batch, QUOTE_KEY, [-micros("datetime_end"), F.col("volume")])


def upsert_quotes(stored: DataFrame, batch: DataFrame, now: _dt.datetime, stored_by_key: bool = False) -> DataFrame:
    """SNK-6: de-duplicate the batch, then upsert on (ticker, datetime_start).

    A 10-minute candle and an hourly candle starting at the same full hour
    share a key (Q18): the newer write wins, and the candle length stays
    visible as ``datetime_end - datetime_start``.
    """
    return upsert(stored, dedup_quote_batch(batch), QUOTE_KEY, now, update=QUOTE_VALUES, stored_by_key=stored_by_key)


def fetch_requests(starts: DataFrame, stocks: DataFrame, now: _dt.datetime,
                   interval: str = "CANDLE_INTERVAL_10_MIN") -> DataFrame:
    """JON-11 + SCL-28: one candle request per ticker of an active forecast.

    The instrument code comes from the stock dimension (an equi join, left
    to AQE's size-checked broadcast); the window runs from the ticker's
    fetch start to ``now`` (open span). Tickers missing from the dimension
    cannot be requested and are left out.
    """
    from tidemark.functions.dates import lit_ts
    return starts.join(stocks.select("ticker", "figi"), "ticker", "inner").select(
        "ticker", "figi", F.col("fetch_from").alias("from_ts"), lit_ts(now).alias("to_ts"),
        F.lit(interval).alias("interval"))
