"""Query registry: every implemented query as ``(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables through the adapters in
``tidemark.sources.driver`` and runs a library plan over the whole tables.
Floating-point outputs that depend on summation order are rounded to six
places here (not in the library) so that independent engines hash equal.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import highwater, quality
from tidemark.operators.materialize import materialize, materialize_by_key
from tidemark.plans import districts, effectiveness, forecasts, outcomes, posts, quotes, stocks, weblog
from tidemark.sources import driver, feeds
from tidemark.sources.files import periods_frame

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def r6(c: str):
    return F.round(F.col(c), 6).alias(c)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return driver.table(spark, sf_dir, name)


def _scratch(spark, label):
    import uuid
    from tidemark.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/tidemark-streams/{label}-{uuid.uuid4().hex}"


# --- incident mart -----------------------------------------------------------

def _crime_inputs(spark, sf_dir):
    crime = driver.crime(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "supplier"))
    codes = driver.offense_codes(_t(spark, sf_dir, "part"))
    return crime, codes


@register("district_mart")
def q_district_mart(spark, sf_dir):
    crime, codes = _crime_inputs(spark, sf_dir)
    m = districts.district_mart(crime, codes)
    return m.select("district", "crimes_total", "crimes_monthly", "frequent_crime_types", r6("Lat"), r6("Long"))


@register("district_top_types")
def q_district_top_types(spark, sf_dir):
    crime, codes = _crime_inputs(spark, sf_dir)
    inc = districts.incidents(crime, codes)
    return districts.district_top_types(inc).select(
        F.col("DISTRICT").alias("district"), "crime_type", "district_crime_type_count", "rank")


def _landed_incidents(spark, sf_dir):
    """The incidents and codes as landed CSV, with one line cut off after its second field."""
    from tidemark import schemas
    from tidemark.sources import files
    from tidemark.streaming.streams import land
    root = _scratch(spark, "incidents")
    crime, codes = _crime_inputs(spark, sf_dir)
    given = {"OCCURRED_ON_DATE": F.date_format("OCCURRED_ON_DATE", "yyyy-MM-dd HH:mm:ss")}
    cols = [given.get(c, F.col(c) if c in crime.columns else F.lit(None).cast("string")).alias(c) for c in schemas.CRIME.fieldNames()]
    crime.select(*cols).write.option("header", True).csv(f"{root}/incidents")
    cut = crime.agg(F.concat(F.min("INCIDENT_NUMBER"), F.lit(",00001")).alias("cut"))
    header = F.lit(",".join(schemas.CRIME.fieldNames()))
    land(cut.select(F.explode(F.array(header, F.col("cut"))).alias("value")), f"{root}/cut")
    codes.write.option("header", True).csv(f"{root}/codes")
    good, rejected, seen = files.land_incidents(spark, f"{root}/incidents", f"{root}/cut")
    return good, rejected, seen, files.read_offense_codes(spark, f"{root}/codes")


@register("district_mart_csv")
def q_district_mart_csv(spark, sf_dir):
    """SRC-1 / SRC-2 to DOM-10: the mart from landed CSV files."""
    good, _, _, codes = _landed_incidents(spark, sf_dir)
    m = districts.district_mart(good, codes)
    return m.select("district", "crimes_total", "crimes_monthly", "frequent_crime_types", r6("Lat"), r6("Long"))


@register("rejected_incident_lines")
def q_rejected_incident_lines(spark, sf_dir):
    """SRC-1: the lines that are no incident, as they came, beside how many lines there were."""
    _, rejected, seen, _ = _landed_incidents(spark, sf_dir)
    n = seen.get
    return rejected.select(F.col("INCIDENT_NUMBER").alias("incident_number"), "line", F.lit(n["lines"]).cast("long").alias("lines"),
                           F.lit(n["rejected"]).cast("long").alias("rejected_lines"), F.lit(n["no_date"]).cast("long").alias("undated"))


@register("district_monthly")
def q_district_monthly(spark, sf_dir):
    crime, codes = _crime_inputs(spark, sf_dir)
    inc = districts.incidents(crime, codes)
    return districts.district_monthly(inc).select(
        F.col("DISTRICT").alias("district"), F.col("YEAR").alias("year"), F.col("MONTH").alias("month"),
        "month_crime_count", r6("Lat"), r6("Long"))


# --- forecast chain ----------------------------------------------------------

# Fixed run parameters of the registered queries (explicit, never "today").
AS_OF = _dt.date(2024, 2, 15)            # all spans over: every forecast can close
NOW = _dt.datetime(2024, 2, 15, 0, 0, 0)
LIVE_AS_OF = _dt.date(2024, 1, 20)       # mid-month: some forecasts still open
LIVE_NOW = _dt.datetime(2024, 1, 20, 0, 0, 0)
STORED_UNTIL = _dt.datetime(2024, 1, 20, 0, 0, 0)   # quotes stored before the live run
LOADED_AT = _dt.datetime(2024, 1, 20, 0, 0, 0)
REPLAY_FROM = _dt.datetime(2024, 1, 20, 0, 0, 0)    # posts re-ingested by a second run
PERIODS = [
    (0, "all time", None, None, True),
    (1, "week 1", _dt.date(2024, 1, 1), _dt.date(2024, 1, 7), True),
    (2, "week 2", _dt.date(2024, 1, 8), _dt.date(2024, 1, 14), True),
    (3, "after week 2", _dt.date(2024, 1, 14), _dt.date(2024, 1, 31), False),
    (4, "q4 (empty)", _dt.date(2024, 10, 1), _dt.date(2024, 12, 31), True),
]
FLAGSHIP = "effectiveness_report"


class Chain:
    """Stages of the forecast chain over one set of driver tables.

    The quotes and the parsed, priced and closed (evaluated) forecasts, which
    the original pipeline keeps in tables between its jobs and several
    later steps read, are written once per chain (``STORED``); the other stages
    stay lazy and Spark reuses their identical exchanges within a plan. A
    query that returns a stage itself gets the lazy plan.
    """

    # Stages written out by default: the tables the original pipeline keeps
    # between its jobs and that several later steps read.
    STORED = ("quotes", "parsed", "priced", "closed")

    def __init__(self, spark: SparkSession, sf_dir: str, stored=None, quotes_by_key: bool = False):
        self.spark, self.sf_dir = spark, sf_dir
        self.stored = set(self.STORED if stored is None else stored)
        self.quotes_by_key = quotes_by_key
        # the given event file has one row group; what lands as posts and ticks is dealt over all tasks
        ev = driver.spread(_t(spark, sf_dir, "events"), "event_id")
        self.items = feeds.post_items(driver.post_pages(ev))
        self.ticks = driver.ticks(ev)
        self._memo: dict = {}

    def _stage(self, name, build):
        if name not in self._memo:
            label = name if isinstance(name, str) else name[0]
            df = build()
            if label == "quotes" and self.quotes_by_key:
                self._memo[name] = materialize_by_key(df, label, quotes.QUOTE_KEY)
                return self._memo[name]
            self._memo[name] = materialize(df, label) if label in self.stored else df
        return self._memo[name]

    # lazy definitions -------------------------------------------------------
    def quotes_plan(self):
        return driver.hourly_quotes(self.ticks)

    def stocks_plan(self):
        return stocks.stock_dimension(feeds.instruments(driver.instrument_lines(_t(self.spark, self.sf_dir, "customer"))))

    def parsed_all(self):
        return posts.parse_forecasts(self.items)

    def parsed_plan(self):
        return posts.latest_forecasts(self.parsed_all())

    # stored stages ------------------------------------------------------------
    @property
    def quotes(self):
        return self._stage("quotes", self.quotes_plan)

    @property
    def stocks(self):
        return self._stage("stocks", self.stocks_plan)

    @property
    def parsed(self):
        return self._stage("parsed", self.parsed_plan)

    @property
    def known(self):
        return posts.known_tickers(self.parsed, self.stocks)

    @property
    def indicators(self):
        return posts.new_indicators(self.parsed)

    def priced_plan(self, as_of=AS_OF, now=NOW, strategy="rollup"):
        return forecasts.price_forecasts(self.known, self.quotes, as_of, now, strategy)

    def priced(self, as_of=AS_OF, now=NOW, strategy="rollup"):
        return self._stage(("priced", as_of, now, strategy), lambda: self.priced_plan(as_of, now, strategy))

    def closed_plan(self, strategy="rollup"):
        return forecasts.close_forecasts(self.priced(strategy=strategy), self.quotes, AS_OF, strategy)

    def closed(self, strategy="rollup"):
        return self._stage(("closed", strategy), lambda: self.closed_plan(strategy))

    def scored(self):
        return outcomes.score(outcomes.evaluated(self.closed()))

    def report_input(self):
        """JON-2 / PRJ-5: evaluated forecasts with stock and indicator columns."""
        st = self.stocks.select("ticker", "stock_name", "country_id", "sector")
        return self.scored().join(st, "ticker", "inner").join(self.indicators, "indicator_name", "inner")


KEYS = ["analyst_company_id", "ticker", "start_date"]


def _dbl(*cols):
    return [F.col(c).cast("double").alias(c) for c in cols]


@register("stock_dimension")
def q_stock_dimension(spark, sf_dir):
    return Chain(spark, sf_dir).stocks_plan()


@register("asset_shares")
def q_asset_shares(spark, sf_dir):
    return feeds.asset_shares(driver.asset_lines(_t(spark, sf_dir, "part")))


@register("parsed_forecasts")
def q_parsed_forecasts(spark, sf_dir):
    return Chain(spark, sf_dir).parsed_plan().select(
        *KEYS, "end_date", "forecast_direction", "price_delta_forecast", "success_procent", "term",
        "indicator_name", "company", "external_id", "date_inserted", "block_pos")


@register("rejected_blocks")
def q_rejected_blocks(spark, sf_dir):
    return posts.rejected_blocks(Chain(spark, sf_dir).items)


@register("new_indicators")
def q_new_indicators(spark, sf_dir):
    return Chain(spark, sf_dir).indicators


@register("unknown_tickers")
def q_unknown_tickers(spark, sf_dir):
    c = Chain(spark, sf_dir)
    return posts.unknown_tickers(c.parsed, c.stocks).select(*KEYS, "external_id")


@register("priced_forecasts")
def q_priced_forecasts(spark, sf_dir):
    p = Chain(spark, sf_dir).priced_plan()
    return p.select(*KEYS, "end_date", "forecast_direction", "external_id", "indicator_name",
                    *_dbl("price_delta_forecast", "price_start", "price_forecast", "price_end"))


@register("span_extrema")
def q_span_extrema(spark, sf_dir):
    c = Chain(spark, sf_dir)
    due = forecasts.due_forecasts(c.priced(), AS_OF)
    ex = forecasts.span_extrema(due, c.quotes)
    return ex.select(*KEYS, *_dbl("price_max_real", "price_min_real"), "price_max_date", "price_min_date")


@register("span_extrema_dyadic")
def q_span_extrema_dyadic(spark, sf_dir):
    """The same from cells of several sizes."""
    c = Chain(spark, sf_dir)
    ex = forecasts.span_extrema(forecasts.due_forecasts(c.priced(), AS_OF), c.quotes, "dyadic")
    return ex.select(*KEYS, *_dbl("price_max_real", "price_min_real"), "price_max_date", "price_min_date")


@register("long_span_extrema")
def q_long_span_extrema(spark, sf_dir):
    """JON-4 over long periods: per event the extrema of its ticker from two
    years before its time to up to 30 days after it."""
    from tidemark.operators import spans as span_ops
    ev = driver.spread(_t(spark, sf_dir, "events"), "event_id")
    day = F.expr("INTERVAL 1 DAY")
    spans = ev.select("event_id", F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("ticker"), F.col("ts").cast("timestamp_ntz").alias("ts"))
    # the quotes are read several times, as rows and for cells
    candles = materialize(driver.hourly_quotes(driver.ticks(ev)), "quotes")
    ex = span_ops.span_extrema(spans, candles, key="ticker", span_id="event_id", lo=F.col("ts") - 731 * day,
                               hi=F.col("ts") + (F.col("event_id") % 31).cast("int") * day, strategy="dyadic")
    return ex.select("event_id", *_dbl("max_p", "min_p"), F.col("max_t").alias("max_time"), F.col("min_t").alias("min_time"))


@register("closed_forecasts")
def q_closed_forecasts(spark, sf_dir):
    cl = Chain(spark, sf_dir).closed_plan()
    return cl.select(*KEYS, "forecast_direction", F.col("forecast_result").cast("int").alias("forecast_result"),
                     *_dbl("end_real_price_delta", "price_max_delta", "price_min_delta",
                           "price_max_real", "price_min_real"), "price_max_date", "price_min_date")


def _outcomes(spark, sf_dir, direction):
    s = Chain(spark, sf_dir).scored().filter(F.col("forecast_direction") == direction)
    return s.select(*KEYS, "res50", "proc50", "res90", "proc90", "res100", "proc100")


@register("rise_outcomes")
def q_rise_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir, 1)


@register("fall_outcomes")
def q_fall_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir, 2)


@register("forecast_metrics")
def q_forecast_metrics(spark, sf_dir):
    m = effectiveness.forecast_metrics(Chain(spark, sf_dir).scored(), periods_frame(spark, PERIODS))
    return m.select("period_id", "period", "direction", "forecasts", "success50", "success90", "success100",
                    "min_start_date", "max_start_date", r6("yield50"), r6("yield90"), r6("yield100"))


@register("effectiveness_report")
def q_effectiveness_report(spark, sf_dir):
    r = effectiveness.effectiveness_report(Chain(spark, sf_dir).report_input(), periods_frame(spark, PERIODS))
    return r.select("line", "period", "metric", r6("value"), "value_date")


def _live(spark, sf_dir, quotes_by_key=False):
    c = Chain(spark, sf_dir, quotes_by_key=quotes_by_key)
    return c, c.priced(LIVE_AS_OF, LIVE_NOW)


@register("active_forecasts")
def q_active_forecasts(spark, sf_dir):
    _, p = _live(spark, sf_dir)
    return forecasts.active_forecasts(p, LIVE_AS_OF).select(
        *KEYS, "end_date", *_dbl("price_start", "price_end"))


@register("due_forecasts")
def q_due_forecasts(spark, sf_dir):
    _, p = _live(spark, sf_dir)
    return forecasts.due_forecasts(p, LIVE_AS_OF, analyst_company_id=2).select(
        *KEYS, "end_date", *_dbl("price_start", "price_end"))


def _stored_quotes(c):
    from tidemark.functions.dates import lit_ts
    return (c.quotes.filter(F.col("datetime_start") < lit_ts(STORED_UNTIL))
            .withColumn("created_at", lit_ts(LOADED_AT)).withColumn("updated_at", lit_ts(LOADED_AT)))


@register("due_forecasts_all")
def q_due_forecasts_all(spark, sf_dir):
    _, p = _live(spark, sf_dir)
    return forecasts.due_forecasts(p, LIVE_AS_OF).select(*KEYS, "end_date", *_dbl("price_start", "price_end"))


@register("quote_high_water")
def q_quote_high_water(spark, sf_dir):
    c, p = _live(spark, sf_dir)
    return quotes.quote_high_water(_stored_quotes(c), forecasts.active_forecasts(p, LIVE_AS_OF))


def _increment(c, p):
    starts = quotes.fetch_starts(_stored_quotes(c), forecasts.active_forecasts(p, LIVE_AS_OF))
    return quotes.incremental_quotes(driver.ten_minute_quotes(c.ticks), starts)


@register("incremental_quotes")
def q_incremental_quotes(spark, sf_dir):
    c, p = _live(spark, sf_dir)
    return _increment(c, p).select("ticker", "datetime_start", "datetime_end",
                                   *_dbl("open_price", "close_price", "high_price", "low_price"), "volume")


@register("upsert_quotes")
def q_upsert_quotes(spark, sf_dir):
    c, p = _live(spark, sf_dir, quotes_by_key=True)
    u = quotes.upsert_quotes(_stored_quotes(c), _increment(c, p), LIVE_NOW, stored_by_key=True)
    return u.select("ticker", "datetime_start", "datetime_end",
                    *_dbl("open_price", "close_price", "high_price", "low_price"), "volume",
                    "created_at", "updated_at")


@register("fetch_requests")
def q_fetch_requests(spark, sf_dir):
    c, p = _live(spark, sf_dir)
    starts = quotes.fetch_starts(_stored_quotes(c), forecasts.active_forecasts(p, LIVE_AS_OF))
    return quotes.fetch_requests(starts, c.stocks, LIVE_NOW)


@register("quotes_from_candles")
def q_quotes_from_candles(spark, sf_dir):
    tk = driver.ticks(_t(spark, sf_dir, "events"))
    q = feeds.quotes_from_candles(driver.candle_responses(driver.hourly_quotes(tk)))
    return q.select("ticker", "datetime_start", "datetime_end",
                    *_dbl("open_price", "close_price", "high_price", "low_price"), "volume")


@register("upsert_forecasts")
def q_upsert_forecasts(spark, sf_dir):
    """SNK-5 + Q20: re-ingested posts update parsed columns of stored,
    already evaluated forecasts but never their evaluation columns."""
    from tidemark.functions.dates import lit_ts
    from tidemark.operators.upsert import upsert
    c = Chain(spark, sf_dir)
    stored = c.closed().withColumn("created_at", lit_ts(LOADED_AT)).withColumn("updated_at", lit_ts(LOADED_AT))
    replay_items = c.items.filter(F.col("inserted") >= REPLAY_FROM.strftime("%Y-%m-%dT%H:%M:%S"))
    replay = posts.known_tickers(posts.latest_forecasts(posts.parse_forecasts(replay_items)), c.stocks)
    batch = forecasts.price_forecasts(replay, c.quotes, AS_OF, NOW)
    cols = [x for x in stored.columns if x in batch.columns or x in ("created_at", "updated_at")]
    u = upsert(stored.select(*cols), batch.select(*[x for x in cols if x in batch.columns]), KEYS, NOW,
               keep=forecasts.EVALUATION)
    return u.select(*KEYS, "end_date", "external_id",
                    F.col("forecast_result").cast("int").alias("forecast_result"),
                    *_dbl("price_start", "price_end", "end_real_price_delta"), "created_at", "updated_at")


def _runs(c):
    first = c.items.filter(F.col("inserted") < REPLAY_FROM.strftime("%Y-%m-%dT%H:%M:%S"))
    second = c.items.filter(F.col("inserted") >= REPLAY_FROM.strftime("%Y-%m-%dT%H:%M:%S"))
    def rec(items, run_id, start):
        b = items.select("analyst_company_id", "external_id",
                         F.to_timestamp_ntz(F.split("inserted", "[.]").getItem(0),
                                            F.lit("yyyy-MM-dd'T'HH:mm:ss")).alias("date_inserted"))
        return highwater.run_record(b, run_id, start, start + _dt.timedelta(minutes=5))
    return rec(first, 1, REPLAY_FROM).unionByName(rec(second, 2, NOW))


@register("last_run")
def q_last_run(spark, sf_dir):
    c = Chain(spark, sf_dir)
    return highwater.last_run(_runs(c))


@register("company_external_ids")
def q_company_external_ids(spark, sf_dir):
    p = Chain(spark, sf_dir).parsed
    return p.filter(F.col("analyst_company_id") == 2).select("external_id").distinct()


@register("backfilled_end_prices")
def q_backfilled_end_prices(spark, sf_dir):
    """Q2: forecasts priced while still open get their end price later."""
    c = Chain(spark, sf_dir)
    live = c.priced(LIVE_AS_OF, LIVE_NOW)
    filled = forecasts.backfill_end_prices(live, c.quotes, AS_OF)
    return filled.select(*KEYS, "end_date", *_dbl("price_start", "price_end"))


@register("mixed_candle_lengths")
def q_mixed_candle_lengths(spark, sf_dir):
    """Q18: after the 10-minute upsert, tickers holding both candle lengths."""
    c, p = _live(spark, sf_dir)
    u = quotes.upsert_quotes(_stored_quotes(c), _increment(c, p), LIVE_NOW)
    return quality.mixed_candle_lengths(u)


@register("closed_from_post_time")
def q_closed_from_post_time(spark, sf_dir):
    """Q3 option: extrema window from the post time instead of midnight."""
    c = Chain(spark, sf_dir)
    cl = forecasts.close_forecasts(c.priced(), c.quotes, AS_OF, from_post_time=True)
    return cl.select(*KEYS, F.col("forecast_result").cast("int").alias("forecast_result"),
                     *_dbl("price_max_delta", "price_min_delta"), "price_max_date", "price_min_date")


@register("upsert_stocks")
def q_upsert_stocks(spark, sf_dir):
    """SNK-4: a stored dimension (the tickers posts named before the second run)
    refreshed from the full instrument list."""
    from tidemark.functions.dates import lit_ts
    inst = feeds.instruments(driver.instrument_lines(_t(spark, sf_dir, "customer")))
    named = Chain(spark, sf_dir).parsed.filter(F.col("date_inserted") < lit_ts(REPLAY_FROM)).select("ticker")
    before = stocks.stock_dimension(inst).join(named.distinct(), "ticker", "left_semi")
    stored = (before.withColumn("stock_name", F.upper("stock_name"))
              .withColumn("created_at", lit_ts(LOADED_AT)).withColumn("updated_at", lit_ts(LOADED_AT)))
    u = stocks.upsert_stocks(stored, inst, NOW)
    return u.select("ticker", "figi", "stock_name", "currency", "lot", "created_at", "updated_at")


# --- paths of the pipelines not covered above -------------------------------------

@register("parsed_since_high_water")
def q_parsed_since_high_water(spark, sf_dir):
    """FLT-11: a second run reads, per company, only posts after its last run;
    companies that never ran read all (1970 default)."""
    c = Chain(spark, sf_dir)
    first = _runs(c).filter((F.col("run_id") == 1) & (F.col("analyst_company_id") != 3))
    companies = c.items.select("analyst_company_id").distinct()
    hwm = highwater.last_run(first, companies)
    return posts.latest_forecasts(posts.parse_forecasts(c.items, hwm)).select(*KEYS, "end_date", "external_id")


@register("rendered_report")
def q_rendered_report(spark, sf_dir):
    """DOM-7 / SCL-30: the two-column text report with headings and blank rows."""
    r = effectiveness.effectiveness_report(Chain(spark, sf_dir).report_input(), periods_frame(spark, PERIODS))
    return effectiveness.render_report(r.withColumn("value", r6("value")), headings=True).select("line", "parameter", "value")


@register("index_documents")
def q_index_documents(spark, sf_dir):
    """SNK-8: search documents with exact-match copies, counted by their fields."""
    from tidemark.functions.dates import lit_ts
    v = weblog.page_views(driver.weblog_lines(_t(spark, sf_dir, "events")), lit_ts(INGEST_TIME))
    d = weblog.index_documents(v)
    return d.groupBy("IP_keyword", "URL_keyword", "page_visited_keyword", "page_params_keyword", "type_keyword",
                     F.concat_ws(",", "tags_keyword").alias("tags_keyword")).agg(F.count(F.lit(1)).alias("documents"))


@register("upsert_indicators")
def q_upsert_indicators(spark, sf_dir):
    """Q26: names of an earlier run keep their values, new names are added."""
    from tidemark.functions.dates import lit_ts
    c = Chain(spark, sf_dir)
    early = c.parsed.filter(F.col("date_inserted") < lit_ts(REPLAY_FROM))
    known = (posts.new_indicators(early).withColumn("created_at", lit_ts(LOADED_AT)).withColumn("updated_at", lit_ts(LOADED_AT)))
    new = (posts.new_indicators(c.parsed, known).withColumn("created_at", lit_ts(NOW)).withColumn("updated_at", lit_ts(NOW)))
    return known.unionByName(new)


# --- weblog --------------------------------------------------------------------

INGEST_TIME = _dt.datetime(2024, 2, 1, 0, 0, 0)


@register("page_views")
def q_page_views(spark, sf_dir):
    from tidemark.functions.dates import lit_ts
    v = weblog.page_views(driver.weblog_lines(_t(spark, sf_dir, "events")), lit_ts(INGEST_TIME))
    c = weblog.page_view_counts(v)
    return c.select("page_visited", "page_params", F.col("Status").alias("status"), "views", "first_seen", "last_seen")


@register("page_view_tags")
def q_page_view_tags(spark, sf_dir):
    from tidemark.functions.dates import lit_ts
    v = weblog.page_views(driver.weblog_lines(_t(spark, sf_dir, "events")), lit_ts(INGEST_TIME))
    return v.groupBy(F.concat_ws(",", "tags").alias("tags")).agg(F.count(F.lit(1)).alias("events"))


@register("keyword_fields")
def q_keyword_fields(spark, sf_dir):
    d = weblog.keyword_fields(_t(spark, sf_dir, "documents"))
    return d.select("doc_id", "text_keyword", "lang_keyword", "source_keyword",
                    F.length("text").cast("long").alias("text_chars"))


# --- streaming twins (STM-1..6): land the adapter output, drain it with
# availableNow in several micro-batches, return the final table -----------------

@register("page_views_stream")
def q_page_views_stream(spark, sf_dir):
    from tidemark.functions.dates import lit_ts
    from tidemark.streaming import streams
    root = _scratch(spark, "weblog")
    lines = driver.weblog_lines(_t(spark, sf_dir, "events"))
    streams.land(lines, f"{root}/in", fmt="csv")
    streams.start_weblog(spark, f"{root}/in", f"{root}/out", f"{root}/ck", ingest_time=lit_ts(INGEST_TIME)).awaitTermination()
    c = weblog.page_view_counts(spark.read.parquet(f"{root}/out"))
    return c.select("page_visited", "page_params", F.col("Status").alias("status"), "views", "first_seen", "last_seen")


def _quotes_stream(spark, sf_dir, starts=None):
    from tidemark import schemas
    from tidemark.sinks.tables import ChangeTable
    from tidemark.streaming import streams
    root = _scratch(spark, "quotes")
    tk = driver.ticks(_t(spark, sf_dir, "events"))
    streams.land(driver.candle_responses(driver.hourly_quotes(tk)), f"{root}/in")
    table = ChangeTable(spark, f"{root}/table", schemas.QUOTES, quotes.QUOTE_KEY)
    streams.start_quotes(spark, f"{root}/in", table, f"{root}/ck", NOW, starts=starts).awaitTermination()
    return table.read().select("ticker", "datetime_start", "datetime_end",
                               *_dbl("open_price", "close_price", "high_price", "low_price"), "volume")


@register("quotes_stream")
def q_quotes_stream(spark, sf_dir):
    return _quotes_stream(spark, sf_dir)


@register("quotes_stream_from_starts")
def q_quotes_stream_from_starts(spark, sf_dir):
    """STM-5: each ticker from its own start on, other tickers not at all."""
    c, p = _live(spark, sf_dir)
    return _quotes_stream(spark, sf_dir, quotes.fetch_starts(_stored_quotes(c), forecasts.active_forecasts(p, LIVE_AS_OF)))


def _posts_stream(spark, sf_dir):
    from tidemark import schemas
    from tidemark.sinks.tables import ChangeTable
    from tidemark.streaming import streams
    root = _scratch(spark, "posts")
    streams.land(driver.post_pages(driver.spread(_t(spark, sf_dir, "events"), "event_id")), f"{root}/in")
    fc = ChangeTable(spark, f"{root}/forecasts", schemas.FORECASTS, KEYS, order=["date_inserted", "external_id"])
    ind = ChangeTable(spark, f"{root}/indicators", schemas.INDICATORS, ["indicator_name"])
    streams.start_posts(spark, f"{root}/in", fc, ind, f"{root}/rejected", f"{root}/ck", NOW).awaitTermination()
    return fc, ind, f"{root}/rejected"


@register("posts_stream")
def q_posts_stream(spark, sf_dir):
    fc, _, _ = _posts_stream(spark, sf_dir)
    return fc.read().select(*KEYS, "end_date", "forecast_direction",
                            F.col("price_delta_forecast").cast("double").alias("price_delta_forecast"),
                            "external_id", "indicator_name", "date_inserted")


@register("posts_stream_rejected")
def q_posts_stream_rejected(spark, sf_dir):
    """SNK-3: the quarantine that the posts stream writes."""
    _, _, rejected = _posts_stream(spark, sf_dir)
    return spark.read.parquet(rejected).select("analyst_company_id", "external_id", "date_inserted", "block_pos", "reason")


SPLIT_DELAY = _dt.timedelta(hours=6)


@register("page_view_places")
def q_page_view_places(spark, sf_dir):
    """STM-1 / STM-2: three drops of the weblog: the first half of the month,
    the rest with some lines of before held back until then, and all lines
    once more. Stored once, late and untimed events, counted by page."""
    from tidemark.functions.dates import lit_ts
    from tidemark.streaming import once, streams
    root = _scratch(spark, "places")
    ev = _t(spark, sf_dir, "events")
    second = (F.col("ts") >= lit_ts(STORED_UNTIL)) | (
        (F.col("ts") < lit_ts(STORED_UNTIL - _dt.timedelta(days=1))) & (F.col("event_id") % 10 == 4))
    places = once.Places(spark, root)
    for n, drop in enumerate((ev.filter(~second), ev.filter(second), ev)):
        streams.land(driver.weblog_lines(drop, faults=True), f"{root}/in/drop={n}", fmt="csv")
        once.start_split(spark, f"{root}/in", places, f"{root}/ck-split", SPLIT_DELAY, INGEST_TIME).awaitTermination()
        once.start_once(spark, places, f"{root}/out", f"{root}/ck-once", SPLIT_DELAY).awaitTermination()
    cols = ["IP", "page_visited", "Status", "event_time"]
    rows = spark.read.parquet(f"{root}/out").select(F.lit("stored").alias("place"), *cols)
    for place in ("late", "untimed"):
        rows = rows.unionByName(places.read(place).select(F.lit(place).alias("place"), *cols))
    return rows.groupBy("place", "page_visited", F.col("Status").alias("status")).agg(
        F.count(F.lit(1)).alias("events"), F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"))


def _moving_quotes(spark, sf_dir):
    """Two drops of candle responses: those until STORED_UNTIL, then all of them
    with another volume. The second begins, per ticker, where the first ended."""
    from tidemark import schemas
    from tidemark.functions.dates import lit_ts
    from tidemark.sinks.tables import ChangeTable
    from tidemark.streaming import streams
    root = _scratch(spark, "moving")
    q = materialize(driver.hourly_quotes(driver.ticks(_t(spark, sf_dir, "events"))), "moving-quotes")
    table = ChangeTable(spark, f"{root}/table", schemas.QUOTES, quotes.QUOTE_KEY)
    marks = ChangeTable(spark, f"{root}/marks", schemas.QUOTE_MARKS, ["ticker"], order=["high_water"])
    used = ChangeTable(spark, f"{root}/used", schemas.BATCH_STARTS, ["ticker"])
    first = q.filter(F.col("datetime_start") < lit_ts(STORED_UNTIL))
    for n, drop in enumerate((first, q.withColumn("volume", F.col("volume") + 1000))):
        streams.land(driver.candle_responses(drop), f"{root}/in/drop={n}")
        streams.start_quotes(spark, f"{root}/in", table, f"{root}/ck", NOW, marks=marks, used=used).awaitTermination()
        streams.start_quote_marks(spark, table, marks, f"{root}/ck-marks", NOW).awaitTermination()
    return table, marks


@register("quotes_stream_moving_start")
def q_quotes_stream_moving_start(spark, sf_dir):
    """STM-5 with AGG-7: each micro-batch from the marks that the one before left."""
    table, _ = _moving_quotes(spark, sf_dir)
    return table.read().select("ticker", "datetime_start", "datetime_end", *_dbl("close_price"), "volume")


@register("quote_marks_stream")
def q_quote_marks_stream(spark, sf_dir):
    """AGG-7 as a running maximum: the marks after both drops."""
    _, marks = _moving_quotes(spark, sf_dir)
    return marks.read().select("ticker", "high_water")


def _faulty_posts_stream(spark, sf_dir):
    from tidemark import schemas
    from tidemark.sinks.tables import ChangeTable
    from tidemark.streaming import streams
    root = _scratch(spark, "faulty")
    streams.land(driver.post_pages(driver.spread(_t(spark, sf_dir, "events"), "event_id"), faults=True), f"{root}/in")
    fc = ChangeTable(spark, f"{root}/forecasts", schemas.FORECASTS, KEYS, order=["date_inserted", "external_id"])
    ind = ChangeTable(spark, f"{root}/indicators", schemas.INDICATORS, ["indicator_name"])
    log = ChangeTable(spark, f"{root}/log", schemas.PARSER_LOG, ["run_id", "analyst_company_id"])
    counts = ChangeTable(spark, f"{root}/counts", schemas.OBSERVED, ["stage", "metric"])
    streams.start_posts(spark, f"{root}/in", fc, ind, f"{root}/rejected", f"{root}/ck", NOW,
                        parser_log=log, counts=counts).awaitTermination()
    return log, counts


@register("observed_counts")
def q_observed_counts(spark, sf_dir):
    """FLT-15, Q24 and STM-2 counted while the rows pass: pages and responses
    without rows, forecasts without an outcome, lines without a time."""
    from tidemark.functions.dates import lit_ts
    from tidemark.operators import observed
    ev = _t(spark, sf_dir, "events")
    items, pages = feeds.observed_post_items(driver.post_pages(ev, faults=True))
    c = Chain(spark, sf_dir)
    candles, responses = feeds.observed_quotes(driver.candle_responses(c.quotes))
    seen = c.closed().select(*KEYS, *forecasts.EVALUATION)
    everything = c.priced().drop(*forecasts.EVALUATION).join(seen, KEYS, "left")
    scored, outcome = observed.observe(outcomes.score(everything), "outcomes", {
        "scored": F.lit(True), "no_outcome": F.col("outcome").isNull()})
    views, lines = observed.observe(weblog.page_views(driver.weblog_lines(ev, faults=True), lit_ts(INGEST_TIME)), "weblog", {
        "lines": F.lit(True), "no_time": weblog.untimed(), "no_page": F.col("page_visited").isNull()})
    for df, label in ((items, "items"), (candles, "candles"), (scored.drop("outcome"), "scored"), (views, "views")):
        materialize(df, f"observed-{label}")
    return observed.counts_frame(spark, {"posts": pages, "candles": responses, "outcomes": outcome, "weblog": lines})


@register("observed_counts_stream")
def q_observed_counts_stream(spark, sf_dir):
    """The same counts kept per micro-batch by the posts stream."""
    from tidemark.operators import observed
    _, counts = _faulty_posts_stream(spark, sf_dir)
    return observed.total_counts(counts)


@register("parser_runs_stream")
def q_parser_runs_stream(spark, sf_dir):
    """SNK-7: the run records that the posts stream opened and closed."""
    log, _ = _faulty_posts_stream(spark, sf_dir)
    return log.read().select("run_id", "analyst_company_id", F.col("end_time").isNotNull().alias("closed"), "forecast_datetime", "external_id")


# --- data quality --------------------------------------------------------------

@register("key_violations")
def q_key_violations(spark, sf_dir):
    return quality.key_violations(Chain(spark, sf_dir).parsed_all(), KEYS)


@register("null_violations")
def q_null_violations(spark, sf_dir):
    p = Chain(spark, sf_dir).priced()
    return quality.null_violations(p, ["ticker", "start_date", "end_date", "forecast_direction",
                                       "price_delta_forecast", "price_start", "price_end"])


@register("orphans")
def q_orphans(spark, sf_dir):
    """DQ-3: line items whose part is missing, and forecasts whose ticker is."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    pa = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"))
    a = quality.orphans(li, pa, ["l_partkey"]).select(
        F.lit("lineitem.l_partkey").alias("reference"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("row_key"))
    c = Chain(spark, sf_dir)
    b = quality.orphans(c.parsed, c.stocks, ["ticker"]).select(
        F.lit("forecast.ticker").alias("reference"),
        F.concat_ws("|", F.col("analyst_company_id").cast("string"), "ticker",
                    F.col("start_date").cast("string")).alias("row_key"))
    return a.unionByName(b)


@register("overflow_violations")
def q_overflow_violations(spark, sf_dir):
    """DQ-4 on the parsed values, before any cast. The declared types are
    narrowed (3,1 and 3 characters) so that the given posts break them."""
    p = Chain(spark, sf_dir).parsed_all()
    v = quality.overflow_violations(p, decimals={"price_delta_forecast": "decimal(3,1)"},
                                    lengths={"ticker": 20, "external_id": 3})
    return v.select(*KEYS, "block_pos", F.concat_ws(",", "violations").alias("violations"))


@register("code_violations")
def q_code_violations(spark, sf_dir):
    """DQ-5 on a coded column as it is given: roles other than the two of a dialogue."""
    c = _t(spark, sf_dir, "conversations")
    return quality.code_violations(c, {"role": ["user", "assistant"]}).select("conv_id", "turn", "role")


@register("forecast_code_violations")
def q_forecast_code_violations(spark, sf_dir):
    """DQ-5 on closed forecasts, some of them given a direction or a result that no code list has."""
    c = Chain(spark, sf_dir)
    post = F.col("external_id").cast("long")
    seeded = c.closed().withColumn("forecast_direction", F.when(post % 23 == 1, F.lit(3)).otherwise(F.col("forecast_direction"))) \
        .withColumn("forecast_result", F.when(post % 29 == 2, F.lit(-1)).otherwise(F.col("forecast_result").cast("int")))
    return quality.code_violations(seeded, quality.FORECAST_CODES).select(*KEYS, "forecast_direction", "forecast_result")


@register("first_closed_forecasts")
def q_first_closed_forecasts(spark, sf_dir):
    """DUP-2: of the closed forecasts of a ticker and day, the one with the smallest post id."""
    from tidemark.operators.dedup import first_by_id
    f = first_by_id(Chain(spark, sf_dir).closed(), ["ticker", "start_date"], "external_id")
    return f.select("ticker", "start_date", "analyst_company_id", "external_id", F.col("forecast_result").cast("int").alias("forecast_result"))


@register("forecast_indicator_ids")
def q_forecast_indicator_ids(spark, sf_dir):
    """JON-9: forecasts with the id of their indicator, none where the indicators
    known before the second run lack it."""
    from tidemark.functions.dates import lit_ts
    c = Chain(spark, sf_dir)
    known = posts.new_indicators(c.parsed.filter((F.col("date_inserted") < lit_ts(REPLAY_FROM)) & (F.col("indicator_name") != "RSI4")))
    return posts.with_indicator_ids(c.parsed, known).select(*KEYS, "indicator_name", "indicator_id")


@register("declared_key_violations")
def q_declared_key_violations(spark, sf_dir):
    """DQ-1 for all five declared keys, over the rows as they arrive: how many
    key values occur more than once."""
    c = Chain(spark, sf_dir)
    parsed = c.parsed_all()
    inst = feeds.instruments(driver.instrument_lines(_t(spark, sf_dir, "customer")))
    candles = feeds.quotes_from_candles(driver.candle_responses(c.quotes_plan()))
    given = {
        "stocks": (inst, ["ticker"]),
        "indicators": (parsed, ["indicator_name"]),
        "stocks_forecasts": (parsed, KEYS),
        "stocks_quotes": (candles.unionByName(candles), ["ticker", "datetime_start"]),
        "parser_log": (_runs(c), ["forecast_datetime"]),
    }
    out = None
    for name, (df, keys) in given.items():
        one = quality.key_violations(df, keys).agg(F.count(F.lit(1)).alias("repeated_keys")).select(F.lit(name).alias("table_name"), "repeated_keys")
        out = one if out is None else out.unionByName(one)
    return out
