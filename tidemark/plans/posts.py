"""Post texts to forecasts (DOM-5), indicators (JON-10, DUP-5) and the
known/unknown ticker split (JON-7).

Parsing runs entirely in JVM expressions: the text is split into lines, each
candidate block is read once with anchored regular expressions, the parsed
blocks are folded with ``aggregate`` (a block that fails consumes its five
lines, one that parses consumes one), and the kept ones are exploded. Whole
texts are processed; nothing is truncated.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.arrays import explode_rows
from tidemark.functions.dates import iso_seconds, lit_ts
from tidemark.functions.text import regex_group, trim_ws
from tidemark.operators.dedup import keep_best

# Marker word, block length and line patterns of a forecast
# block, exactly as the post format writes them.
MARKER = "Бумага"
BLOCK_LINES = 5
SECURITY_PATTERN = r".*Бумага (.*)\.*\{\$(.*)\}.*"
RISE_MARKER = "Потенциал роста"
RISE_PATTERN = r".*роста (.*)%"
FALL_PATTERN = r".*падения (.*)%"
PERCENT_PATTERN = r".*В (.*)%.*"
TERM_PATTERN = r".*Срок (\d+) "
INDICATOR_PATTERN = r".*индикатора (.*)"
EPOCH = _dt.datetime(1970, 1, 1)


_BLOCK = ("struct<block_pos: int, company: string, ticker: string, forecast_direction: int, price_delta_forecast: double, "
          "success_procent: int, term: int, indicator_name: string, reason: string>")


def _found(lines: Column, pos: Column) -> Column:
    """What the patterns find in the block whose marker line is ``lines[pos]`` (0-based)."""
    def line(j: int) -> Column:
        return F.try_element_at(lines, pos + F.lit(1 + j))

    sec, pot, term, pct, ind = (line(j) for j in range(BLOCK_LINES))
    rise = pot.contains(RISE_MARKER)
    delta = F.when(rise, regex_group(pot, RISE_PATTERN)).otherwise(regex_group(pot, FALL_PATTERN))
    return F.struct(
        pos.alias("block_pos"),
        (pos + F.lit(BLOCK_LINES) > F.size(lines)).alias("short"),
        regex_group(sec, SECURITY_PATTERN, 1).alias("company"),
        regex_group(sec, SECURITY_PATTERN, 2).alias("ticker"),
        F.coalesce(rise, F.lit(False)).alias("rise"),
        delta.alias("raw_delta"),
        trim_ws(delta).try_cast("double").alias("delta"),
        trim_ws(regex_group(pct, PERCENT_PATTERN)).try_cast("int").alias("percent"),
        regex_group(term, TERM_PATTERN).try_cast("int").alias("term"),
        trim_ws(regex_group(ind, INDICATOR_PATTERN)).alias("indicator"))


def _typed(f: Column) -> Column:
    """The block of what was found. ``reason`` is NULL for a good one, else the
    first failing check in the order the format is read (Q15: failures are
    reported, not fatal)."""
    reason = (
        F.when(f.short, F.lit("short_block"))
        .when(f.company.isNull(), F.lit("no_security"))
        .when(f.raw_delta.isNull(), F.lit("no_potential"))
        .when(f.delta.isNull(), F.lit("bad_potential"))
        .when(f.percent.isNull(), F.lit("bad_percent"))
        .when(f.term.isNull(), F.lit("bad_term"))
        .when(f.indicator.isNull(), F.lit("bad_indicator"))
    )
    return F.struct(
        f.block_pos.alias("block_pos"), f.company.alias("company"), f.ticker.alias("ticker"),
        F.when(f.rise, F.lit(1)).otherwise(F.lit(2)).alias("forecast_direction"),
        F.when(f.rise, f.delta).otherwise(-f.delta).alias("price_delta_forecast"),
        f.percent.alias("success_procent"), f.term.alias("term"), f.indicator.alias("indicator_name"),
        reason.alias("reason"))


def _read_blocks(lines: Column) -> Column:
    """The blocks that a sequential reader visits, as an array.

    Every line with the marker is parsed once; the fold then keeps a parsed
    block if the blocks before it did not consume its line.
    """
    n = F.size(lines)
    starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                      lambda i: F.coalesce(F.try_element_at(lines, i + 1).contains(MARKER), F.lit(False)))
    parsed = F.transform(F.transform(starts, lambda i: _found(lines, i)), _typed)
    init = F.struct(F.lit(0).alias("nxt"), F.array().cast(f"array<{_BLOCK}>").alias("keep"))

    def step(acc: Column, b: Column) -> Column:
        taken = F.struct((b.block_pos + F.when(b.reason.isNull(), F.lit(1)).otherwise(F.lit(BLOCK_LINES))).alias("nxt"),
                         F.array_append(acc.getField("keep"), b.cast(_BLOCK)).alias("keep"))
        return F.when(b.block_pos >= acc.getField("nxt"), taken).otherwise(acc)

    return F.aggregate(parsed, init, step, lambda acc: acc.getField("keep"))


def blocks(items: DataFrame, hwm: _dt.datetime | DataFrame | None = None) -> DataFrame:
    """Every block a sequential reader would visit, parsed, with ``reason``.

    ``items``: ``analyst_company_id, external_id, inserted, text``.
    ``hwm``: only posts strictly newer are read (FLT-11). Either one
    timestamp, or a DataFrame ``analyst_company_id, hwm`` (one per company,
    see ``operators.highwater.last_run``); companies without a row read all.
    """
    p = items.withColumn("date_inserted", iso_seconds("inserted"))
    if isinstance(hwm, DataFrame):
        # one row a company: by an exchange the posts of a company would all meet in one task
        p = (p.join(F.broadcast(hwm.select("analyst_company_id", F.col("hwm").alias("_hwm"))),
                    "analyst_company_id", "left")
             .filter(F.col("date_inserted") > F.coalesce(F.col("_hwm"), lit_ts(EPOCH)))
             .drop("_hwm"))
    else:
        p = p.filter(F.col("date_inserted") > lit_ts(hwm or EPOCH))
    p = p.withColumn("lines", F.split(F.col("text"), "\n"))
    return explode_rows(p, _read_blocks(F.col("lines")), "b", "analyst_company_id", "external_id", "date_inserted").select(
        "analyst_company_id", "external_id", "date_inserted", "b.*")


def parse_forecasts(items: DataFrame, hwm=None) -> DataFrame:
    """DOM-5: good blocks as forecasts (dates from the post time, SCL-14)."""
    b = blocks(items, hwm).filter(F.col("reason").isNull()).drop("reason")
    start = F.to_date("date_inserted")
    return b.withColumn("start_date", start).withColumn("end_date", F.date_add(start, F.col("term")))


def rejected_blocks(items: DataFrame, hwm=None) -> DataFrame:
    """Q15 quarantine: blocks that failed, with the reason."""
    return blocks(items, hwm).filter(F.col("reason").isNotNull()).select(
        "analyst_company_id", "external_id", "date_inserted", "block_pos", "reason")


def newest_first() -> list[Column]:
    """Preference order of DUP-5 / DUP-6 (largest wins)."""
    return [F.col("date_inserted"), F.col("external_id"), -F.col("block_pos")]


def latest_forecasts(forecasts: DataFrame) -> DataFrame:
    """DUP-6 / Q11: one forecast per (company, ticker, start_date): newest
    post wins, then the larger post id, then the earlier block."""
    return keep_best(forecasts, ["analyst_company_id", "ticker", "start_date"], newest_first())


def new_indicators(forecasts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """JON-10 + DUP-5: indicators not yet known, with the success percent of
    their newest forecast (an existing name keeps its value, Q26)."""
    f = forecasts
    if known is not None:
        f = f.join(known.select("indicator_name"), "indicator_name", "left_anti")
    best = keep_best(f.select("indicator_name", "success_procent", *["date_inserted", "external_id", "block_pos"]),
                     ["indicator_name"], newest_first())
    return best.select("indicator_name", F.col("success_procent").alias("success_proc"))


def indicator_ids(indicators: DataFrame) -> DataFrame:
    """JON-9: indicators with a number of their own, the first 60 bits of the
    name's MD5: the same on every run and machine, without a counter.
    ``operators.quality.key_violations`` on it shows two names of one number."""
    return indicators.withColumn("indicator_id", F.conv(F.substring(F.md5("indicator_name"), 1, 15), 16, 10).cast("long"))


def with_indicator_ids(forecasts: DataFrame, indicators: DataFrame) -> DataFrame:
    """JON-9: each forecast with the id of its indicator; unknown names have none."""
    ids = indicator_ids(indicators).select("indicator_name", "indicator_id")
    return forecasts.join(ids, "indicator_name", "left")


def known_tickers(forecasts: DataFrame, stocks: DataFrame) -> DataFrame:
    """JON-7 flow side: forecasts whose ticker is in the stock dimension."""
    return forecasts.join(stocks.select("ticker"), "ticker", "left_semi")


def unknown_tickers(forecasts: DataFrame, stocks: DataFrame) -> DataFrame:
    """JON-7 quarantine side: forecasts with a ticker missing from stocks."""
    return forecasts.join(stocks.select("ticker"), "ticker", "left_anti")
