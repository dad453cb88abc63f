"""Adapters: build the domain inputs from the driver's parquet tables.

The domain pipelines read crime CSVs, landed JSON feeds, weblogs and
relational tables. For tests and benchmarks those inputs are derived from
the driver tables (see FIXTURES.md, section B) so that every query's work
grows with the data. All adapters are lazy DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """The rows dealt over ``parts`` tasks (default: the session's shuffle width), whatever files they come in."""
    return df.repartition(parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _s(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


# --- incident mart ---------------------------------------------------------

def crime(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """One incident per line item; district from the supplier's nation.

    Nation keys divisible by 12 give a NULL district (FLT-1 has work to do).
    """
    part_code = _s("l_partkey")
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         "l_shipdate", "l_discount", "l_tax")
    su = supplier.select("s_suppkey", "s_nationkey")
    return li.join(su, li.l_suppkey == su.s_suppkey).select(
        F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("INCIDENT_NUMBER"),
        F.when(F.length(part_code) < 5, F.lpad(part_code, 5, "0")).otherwise(part_code).alias("OFFENSE_CODE"),
        F.when(F.col("s_nationkey") % 12 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("D"), _s("s_nationkey"))).alias("DISTRICT"),
        F.to_date("l_shipdate").alias("OCCURRED_ON_DATE"),
        F.month("l_shipdate").alias("MONTH"),
        (F.lit(42) + F.col("l_discount")).alias("Lat"),
        (F.lit(-71) - F.col("l_tax")).alias("Long"),
        F.lit(None).cast("string").alias("SHOOTING"),
    )


def offense_codes(part: DataFrame) -> DataFrame:
    """Codes with deliberate duplicates: every tenth code appears twice."""
    base = part.select(F.col("p_partkey").cast("int").alias("CODE"),
                       F.concat("p_brand", F.lit(" - "), "p_type").alias("NAME"))
    dups = part.filter(F.col("p_partkey") % 10 == 0).select(
        F.col("p_partkey").cast("int").alias("CODE"),
        F.concat("p_brand", F.lit("X - dup")).alias("NAME"))
    return base.unionByName(dups)


# --- prices ----------------------------------------------------------------

def ticks(events: DataFrame) -> DataFrame:
    """One price tick per event: ticker ``T<user_id>``, price ``100 + value/10``."""
    return events.select(
        "event_id", "ts",
        F.concat(F.lit("T"), _s("user_id")).alias("ticker"),
        (F.lit(100) + F.col("value") / 10).alias("price"),
        "event_type",
        _k().alias("k"),
    )


def _tick_order() -> Column:
    # (ts, event_id) packed into one decimal so open/close stay hash aggregates.
    from tidemark.operators.spans import micros, order_key
    return order_key(micros("ts"), F.col("event_id"))


def hourly_quotes(tk: DataFrame) -> DataFrame:
    """Hourly OHLCV candles per ticker (the stored quotes table)."""
    p = F.col("price").cast(schemas.PRICE)
    order = _tick_order()
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return (
        tk.groupBy("ticker", hour.alias("datetime_start"))
        .agg(F.min_by(p, order).alias("open_price"),
             F.max_by(p, order).alias("close_price"),
             F.max(p).alias("high_price"),
             F.min(p).alias("low_price"),
             F.count(F.lit(1)).alias("volume"))
        .withColumn("datetime_end", F.col("datetime_start") + F.expr("INTERVAL 1 HOUR"))
        .select("ticker", "datetime_start", "datetime_end", "open_price",
                "close_price", "high_price", "low_price", "volume")
    )


def _units_nano(p: Column) -> Column:
    units = F.floor(p)
    return F.struct(units.cast("string").alias("units"),
                    ((p - units) * F.lit(1000000000)).cast("long").alias("nano"))


def candle_responses(quotes: DataFrame) -> DataFrame:
    """Landed candle responses as JSON text: one response per ticker and day.

    A response holds at most one day of hourly candles (24), so the
    ``collect_list`` is bounded by the calendar, not by the data volume.
    """
    candle = F.struct(
        F.date_format("datetime_start", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
        _units_nano(F.col("open_price")).alias("open"),
        _units_nano(F.col("close_price")).alias("close"),
        _units_nano(F.col("high_price")).alias("high"),
        _units_nano(F.col("low_price")).alias("low"),
        _s("volume").alias("volume"),
    )
    return (
        quotes.groupBy("ticker", F.to_date("datetime_start").alias("day"))
        .agg(F.collect_list(candle).alias("candles"))
        .select(F.to_json(F.struct("ticker", F.lit("CANDLE_INTERVAL_HOUR").alias("interval"),
                                   "candles")).alias("value"))
    )


# --- posts -----------------------------------------------------------------

NL = "\n"


def post_pages(events: DataFrame, faults: bool = False) -> DataFrame:
    """Landed post pages as JSON text, one page per event.

    The text holds an intro line and one forecast block of five lines; the
    analyst company is ``1 + event_id % 3``. Seeded variations: every 11th
    post writes its potential with a decimal comma (the block is rejected
    and its five lines are skipped); every 7th post carries a second block
    on the next ticker with another indicator family; every 37th post names
    a ticker that no instrument has.

    ``faults`` adds pages without posts: of each 20 pages one lacks its
    payload, one its items, one has none, and one is cut off.
    """
    ev = events.select("event_id", "ts", "user_id", _k().alias("k"))
    uid = _s("user_id")
    uid2 = _s(F.col("user_id") + 1)
    delta = _s((F.lit(1) + F.col("k")) / 2)
    delta = F.when(F.col("event_id") % 11 == 0, F.regexp_replace(delta, "[.]", ",")).otherwise(delta)
    block1 = F.concat(
        F.lit("Бумага Co "), uid, F.lit(" {$"), F.when(F.col("event_id") % 37 == 5, F.lit("X")).otherwise(F.lit("T")),
        uid, F.lit("}" + NL),
        F.when(F.col("event_id") % 2 == 0, F.lit("Потенциал роста ")).otherwise(F.lit("Потенциал падения ")),
        delta, F.lit("%" + NL + "Срок "),
        _s(F.lit(1) + F.col("event_id") % 10), F.lit(" дней" + NL + "В "),
        _s(F.lit(50) + F.col("k") % 50), F.lit("% случаев" + NL + "по сигналу индикатора RSI"),
        _s(F.col("k") % 5),
    )
    block2 = F.concat(
        F.lit(NL + "Бумага Co "), uid2, F.lit(" {$T"), uid2, F.lit("}" + NL + "Потенциал роста "),
        _s(F.col("k") / 4), F.lit("%" + NL + "Срок "), _s(F.lit(2) + F.col("event_id") % 5),
        F.lit(" дней" + NL + "В "), _s(F.lit(40) + F.col("k") % 40),
        F.lit("% случаев" + NL + "по сигналу индикатора MACD"), _s(F.col("k") % 3),
    )
    text = F.concat(F.lit("intro" + NL), block1,
                    F.when(F.col("event_id") % 7 == 0, block2).otherwise(F.lit("")))
    item = F.struct(
        _s("event_id").alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("inserted"),
        F.struct(text.alias("text")).alias("content"),
    )
    company = (F.lit(1) + F.col("event_id") % 3).cast("int").alias("analyst_company_id")
    payload = lambda items: F.struct(items.alias("items"), F.lit(None).cast("string").alias("nextCursor")).alias("payload")
    page = F.to_json(F.struct(company, payload(F.array(item))))
    if faults:
        kind, none = F.col("event_id") % 20, F.array(item)
        page = (F.when(kind == 3, F.to_json(F.struct(company)))
                .when(kind == 8, F.to_json(F.struct(company, payload(F.when(kind < 0, none)))))
                .when(kind == 13, F.to_json(F.struct(company, payload(F.slice(none, 1, 0)))))
                .when(kind == 18, F.substring(page, 1, 10)).otherwise(page))
    return ev.select(page.alias("value"))


def ten_minute_quotes(tk: DataFrame) -> DataFrame:
    """10-minute OHLCV candles per ticker (the incremental quote feed)."""
    p = F.col("price").cast(schemas.PRICE)
    order = _tick_order()
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    start = hour + F.make_dt_interval(mins=(F.floor(F.minute("ts") / 10) * 10).cast("int"))
    return (
        tk.groupBy("ticker", start.alias("datetime_start"))
        .agg(F.min_by(p, order).alias("open_price"),
             F.max_by(p, order).alias("close_price"),
             F.max(p).alias("high_price"),
             F.min(p).alias("low_price"),
             F.count(F.lit(1)).alias("volume"))
        .withColumn("datetime_end", F.col("datetime_start") + F.expr("INTERVAL 10 MINUTES"))
        .select("ticker", "datetime_start", "datetime_end", "open_price",
                "close_price", "high_price", "low_price", "volume")
    )


# --- instruments -----------------------------------------------------------

def instrument_lines(customer: DataFrame) -> DataFrame:
    """Landed instrument list as JSON lines, from customers.

    Every 50th customer appears twice, the second time with a later figi;
    negative balances have no currency.
    """
    c = customer
    key = _s("c_custkey")
    ru = F.col("c_custkey") % 4 == 0

    def inst(figi_prefix: str) -> Column:
        return F.struct(
            F.concat(F.lit("T"), key).alias("ticker"),
            F.concat(F.lit(figi_prefix), F.lpad(key, 8, "0")).alias("figi"),
            F.col("c_name").alias("name"),
            F.when(ru, F.lit("RU")).otherwise(F.lit("US")).alias("country_of_risk"),
            F.struct(F.when(F.col("c_acctbal") < 0, F.lit(""))
                     .when(ru, F.lit("rub")).otherwise(F.lit("usd")).alias("currency")).alias("nominal"),
            (F.lit(1) + F.col("c_custkey") % 10).cast("int").alias("lot"),
            F.when(ru, F.lit("TQBR")).otherwise(F.lit("SPBXM")).alias("class_code"),
            F.lower("c_mktsegment").alias("sector"),
        )

    first = c.select(F.to_json(inst("F")).alias("value"))
    dup = c.filter(F.col("c_custkey") % 50 == 0).select(F.to_json(inst("G")).alias("value"))
    return first.unionByName(dup)


def asset_lines(part: DataFrame) -> DataFrame:
    """Landed nested asset list as JSON lines, from parts."""
    key = _s("p_partkey")
    security = F.col("p_size") % 3 != 0
    share = F.struct(F.concat(F.lit("P"), key).alias("ticker"),
                     F.concat(F.lit("S"), F.lpad(key, 8, "0")).alias("figi"),
                     F.lit("TQBR").alias("class_code"),
                     F.lit("INSTRUMENT_TYPE_SHARE").alias("instrument_kind"))
    other = F.struct(F.concat(F.lit("B"), key).alias("ticker"),
                     F.concat(F.lit("O"), F.lpad(key, 8, "0")).alias("figi"),
                     F.lit("TQOB").alias("class_code"),
                     F.when(F.col("p_size") % 2 == 0, F.lit("INSTRUMENT_TYPE_BOND"))
                     .otherwise(F.lit("INSTRUMENT_TYPE_SHARE")).alias("instrument_kind"))
    asset = F.struct(
        F.when(security, F.lit("ASSET_TYPE_SECURITY")).otherwise(F.lit("ASSET_TYPE_CURRENCY")).alias("type"),
        F.col("p_name").alias("name"),
        F.array(share, other).alias("instruments"),
    )
    return part.select(F.to_json(asset).alias("value"))


# --- weblog ----------------------------------------------------------------

def weblog_lines(events: DataFrame, faults: bool = False) -> DataFrame:
    """Weblog rows (IP, Time, URL, Status) as text; ``k = 0`` rows are junk.

    With ``faults`` every 19th row has a time that cannot be read.
    """
    ev = events.select("event_id", "user_id", "ts", "event_type", _k().alias("k"))
    time = F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")
    if faults:
        time = F.when(F.col("event_id") % 19 == 7, F.lit("no time")).otherwise(time)
    url = F.when(F.col("k") == 0, F.lit("ReadInput")).otherwise(F.concat(
        F.lit("GET /"), "event_type", F.lit(".php"),
        F.when(F.col("k") % 3 == 0, F.concat(F.lit("?k="), _s("k"))).otherwise(F.lit("")),
        F.lit(" HTTP/1.1")))
    return ev.select(
        F.concat(F.lit("10.0.0."), _s(F.col("user_id") % 256)).alias("IP"),
        F.concat(F.lit("["), time).alias("Time"),
        url.alias("URL"),
        F.concat(F.when(F.col("event_type") == "error", F.lit("500")).otherwise(F.lit("200")),
                 F.lit(" ")).alias("Status"),
    )
