"""Declared schemas of the domain tables (all fields nullable unless noted)."""

from pyspark.sql import types as T

S, I, L, D, DT, TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.DateType(),
    T.TimestampNTZType(),
)


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


PRICE = T.DecimalType(16, 6)
PRICE_END = T.DecimalType(16, 10)
DELTA = T.DecimalType(7, 3)

CRIME = _struct(
    ("INCIDENT_NUMBER", S), ("OFFENSE_CODE", S), ("OFFENSE_CODE_GROUP", S),
    ("OFFENSE_DESCRIPTION", S), ("DISTRICT", S), ("REPORTING_AREA", S),
    ("SHOOTING", S), ("OCCURRED_ON_DATE", DT), ("YEAR", I), ("MONTH", I),
    ("DAY_OF_WEEK", S), ("HOUR", I), ("UCR_PART", I), ("STREET", S),
    ("Lat", D), ("Long", D), ("Location", S),
)

OFFENSE_CODES = _struct(("CODE", I), ("NAME", S))

STOCKS = _struct(
    ("ticker", S), ("figi", S), ("stock_name", S), ("country_id", S),
    ("currency", S), ("lot", I), ("class_code", S), ("sector", S),
    ("created_at", TS), ("updated_at", TS),
)

INDICATORS = _struct(
    ("indicator_name", S), ("success_proc", I), ("created_at", TS), ("updated_at", TS),
)

# Stored forecasts: natural key (analyst_company_id, ticker, start_date)
# instead of a serial id (Q17); the indicator is referenced by name.
FORECASTS = _struct(
    ("analyst_company_id", I), ("ticker", S), ("start_date", DT),
    ("end_date", DT), ("forecast_direction", I), ("price_start", PRICE),
    ("price_forecast", PRICE), ("price_delta_forecast", DELTA),
    ("price_end", PRICE_END), ("price_max_real", PRICE), ("price_max_date", TS),
    ("price_min_real", PRICE), ("price_min_date", TS),
    ("end_real_price_delta", DELTA), ("price_max_delta", DELTA),
    ("price_min_delta", DELTA), ("forecast_result", T.ShortType()),
    ("external_id", S), ("indicator_name", S), ("date_inserted", TS),
    ("created_at", TS), ("updated_at", TS),
)

QUOTES = _struct(
    ("ticker", S), ("datetime_start", TS), ("datetime_end", TS),
    ("open_price", PRICE), ("close_price", PRICE), ("high_price", PRICE),
    ("low_price", PRICE), ("volume", L), ("created_at", TS), ("updated_at", TS),
)

PARSER_LOG = _struct(
    ("run_id", L), ("analyst_company_id", I), ("start_time", TS), ("end_time", TS),
    ("forecast_datetime", TS), ("external_id", S), ("created_at", TS), ("updated_at", TS),
)

# Newest stored candle end per ticker, and the fetch starts that a batch used.
QUOTE_MARKS = _struct(("ticker", S), ("high_water", TS), ("created_at", TS), ("updated_at", TS))
BATCH_STARTS = _struct(("ticker", S), ("fetch_from", TS))

# Counts observed per micro-batch, and the newest event time of each.
OBSERVED = _struct(("stage", S), ("metric", S), ("rows", L))
STREAM_MARKS = _struct(("mark_id", S), ("newest", TS))

# Landed JSON shapes of the two feeds.
UNITS_NANO = _struct(("units", S), ("nano", L))

POSTS_PAGE = _struct(
    ("payload", _struct(
        ("items", T.ArrayType(_struct(
            ("id", S), ("inserted", S), ("content", _struct(("text", S))),
        ))),
        ("nextCursor", S),
    )),
)

CANDLES_RESPONSE = _struct(
    ("ticker", S),
    ("interval", S),
    ("candles", T.ArrayType(_struct(
        ("time", S), ("open", UNITS_NANO), ("close", UNITS_NANO),
        ("high", UNITS_NANO), ("low", UNITS_NANO), ("volume", S),
    ))),
)

INSTRUMENT = _struct(
    ("ticker", S), ("figi", S), ("name", S), ("country_of_risk", S),
    ("nominal", _struct(("currency", S))), ("lot", I), ("class_code", S), ("sector", S),
)

ASSET = _struct(
    ("type", S), ("name", S),
    ("instruments", T.ArrayType(_struct(
        ("ticker", S), ("figi", S), ("class_code", S), ("instrument_kind", S),
    ))),
)

# Weblog lines are read without header handling: four text columns.
WEBLOG = _struct(("IP", S), ("Time", S), ("URL", S), ("Status", S))

PAGE_VIEWS = _struct(
    ("IP", S), ("Time", S), ("URL", S), ("page_visited", S), ("page_params", S), ("Status", I),
    ("event_time", TS), ("type", S), ("tags", T.ArrayType(S)),
)

OUTCOME = T.StructType([
    T.StructField("res50", I), T.StructField("proc50", D),
    T.StructField("res90", I), T.StructField("proc90", D),
    T.StructField("res100", I), T.StructField("proc100", D),
])
