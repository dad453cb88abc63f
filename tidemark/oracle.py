"""Independent DuckDB SQL for every registered query (the correctness gate).

The SQL re-derives each result from the raw driver tables with DuckDB's
own functions; it shares no code path with the Spark plans. Common table
expressions are composed from the fragments below.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- incident mart -----------------------------------------------------------

CRIME = r"""crime AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS INCIDENT_NUMBER,
         CASE WHEN length(CAST(l_partkey AS VARCHAR)) < 5 THEN lpad(CAST(l_partkey AS VARCHAR), 5, '0')
              ELSE CAST(l_partkey AS VARCHAR) END AS OFFENSE_CODE,
         CASE WHEN s_nationkey % 12 = 0 THEN NULL ELSE 'D' || CAST(s_nationkey AS VARCHAR) END AS DISTRICT,
         CAST(l_shipdate AS DATE) AS OCCURRED_ON_DATE, month(l_shipdate) AS MONTH,
         42 + l_discount AS Lat, -71 - l_tax AS Long
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""

CODES = r"""codes AS (
  SELECT CAST(p_partkey AS INTEGER) AS CODE, p_brand || ' - ' || p_type AS NAME FROM part
  UNION ALL
  SELECT CAST(p_partkey AS INTEGER), p_brand || 'X - dup' FROM part WHERE p_partkey % 10 = 0)"""

INC = r"""types AS (
  SELECT CODE, regexp_split_to_array(min(NAME), '\s+\-\s+')[1] AS crime_type FROM codes GROUP BY CODE),
inc AS (
  SELECT c.*, year(c.OCCURRED_ON_DATE) AS YEAR, t.crime_type
  FROM crime c JOIN types t ON TRY_CAST(c.OFFENSE_CODE AS INTEGER) = t.CODE
  WHERE c.DISTRICT IS NOT NULL)"""

def mean6(col: str) -> str:
    """Exact mean of ``col`` (summed as decimal(20,10)) rounded half-up to 6 places."""
    n = f"CAST(sum(CAST({col} AS DECIMAL(20,10))) * 10000000000 AS HUGEINT)"
    c = f"CAST(count({col}) AS HUGEINT)"
    q = f"((2 * abs({n}) * 1000000 + {c} * 10000000000) // (2 * {c} * 10000000000))"
    return (f"CASE WHEN count({col}) = 0 THEN NULL ELSE "
            f"CAST(CAST(sign({n}) * {q} AS DECIMAL(38,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DOUBLE) END")


MONTHLY = r"""monthly AS (
  SELECT DISTRICT, YEAR, MONTH, count(INCIDENT_NUMBER) AS month_crime_count,
         avg(Lat) AS Lat, avg(Long) AS Long
  FROM inc GROUP BY DISTRICT, YEAR, MONTH)"""

MONTHLY6 = f"""monthly AS (
  SELECT DISTRICT, YEAR, MONTH, count(INCIDENT_NUMBER) AS month_crime_count,
         {mean6('Lat')} AS Lat, {mean6('Long')} AS Long
  FROM inc GROUP BY DISTRICT, YEAR, MONTH)"""

TOP = r"""tc AS (SELECT DISTRICT, crime_type, count(*) AS district_crime_type_count FROM inc GROUP BY 1, 2),
top AS (
  SELECT * FROM (SELECT *, rank() OVER (PARTITION BY DISTRICT ORDER BY district_crime_type_count DESC) AS rank
                 FROM tc) WHERE rank <= 3)"""

ORACLE["district_mart"] = _with(CRIME, CODES, INC, MONTHLY, TOP) + r""",
stats AS (
  SELECT DISTRICT, quantile_disc(month_crime_count, 0.5) AS crimes_monthly,
         CAST(sum(month_crime_count) AS BIGINT) AS crimes_total, avg(Lat) AS Lat, avg(Long) AS Long
  FROM monthly GROUP BY DISTRICT),
topc AS (
  SELECT DISTRICT, string_agg(crime_type, ', ' ORDER BY district_crime_type_count DESC, crime_type) AS frequent_crime_types
  FROM top GROUP BY DISTRICT)
SELECT s.DISTRICT AS district, crimes_total, crimes_monthly, frequent_crime_types,
       round(Lat, 6) AS Lat, round(Long, 6) AS Long
FROM topc JOIN stats s ON topc.DISTRICT = s.DISTRICT"""

ORACLE["district_top_types"] = _with(CRIME, CODES, INC, TOP) + r"""
SELECT DISTRICT AS district, crime_type, district_crime_type_count, CAST(rank AS INTEGER) AS rank FROM top"""

ORACLE["district_monthly"] = _with(CRIME, CODES, INC, MONTHLY6) + r"""
SELECT DISTRICT AS district, CAST(YEAR AS INTEGER) AS year, CAST(MONTH AS INTEGER) AS month,
       month_crime_count, Lat, Long FROM monthly"""


# --- forecast chain ----------------------------------------------------------
# Run parameters mirror tidemark.catalog (AS_OF 2024-02-15, live run 2024-01-20).

AS_OF = "DATE '2024-02-15'"
NOW = "TIMESTAMP '2024-02-15 00:00:00'"
LIVE_AS_OF = "DATE '2024-01-20'"
LIVE_NOW = "TIMESTAMP '2024-01-20 00:00:00'"
LOADED_AT = "TIMESTAMP '2024-01-20 00:00:00'"
REPLAY_FROM = "TIMESTAMP '2024-01-20 00:00:00'"
KEYS = "analyst_company_id, ticker, start_date"

PX = r"""px AS (
  SELECT event_id, ts, 'T' || CAST(user_id AS VARCHAR) AS ticker, 100 + value / 10 AS price, event_type,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events)"""

QUOTES = r"""quotes AS (
  SELECT ticker, date_trunc('hour', ts) AS datetime_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS datetime_end,
         arg_min(CAST(price AS DECIMAL(16,6)), {'t': ts, 'e': event_id}) AS open_price,
         arg_max(CAST(price AS DECIMAL(16,6)), {'t': ts, 'e': event_id}) AS close_price,
         max(CAST(price AS DECIMAL(16,6))) AS high_price, min(CAST(price AS DECIMAL(16,6))) AS low_price,
         count(*) AS volume
  FROM px GROUP BY ticker, date_trunc('hour', ts))"""

QUOTES10 = r"""quotes10 AS (
  SELECT ticker, time_bucket(INTERVAL 10 MINUTE, ts) AS datetime_start,
         time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS datetime_end,
         arg_min(CAST(price AS DECIMAL(16,6)), {'t': ts, 'e': event_id}) AS open_price,
         arg_max(CAST(price AS DECIMAL(16,6)), {'t': ts, 'e': event_id}) AS close_price,
         max(CAST(price AS DECIMAL(16,6))) AS high_price, min(CAST(price AS DECIMAL(16,6))) AS low_price,
         count(*) AS volume
  FROM px GROUP BY ticker, time_bucket(INTERVAL 10 MINUTE, ts))"""

POSTS = r"""pe AS (
  SELECT event_id, ts, user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM events),
posts AS (
  SELECT CAST(1 + event_id % 3 AS INTEGER) AS analyst_company_id, CAST(event_id AS VARCHAR) AS external_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') AS inserted, date_trunc('second', ts) AS date_inserted,
         'intro' || chr(10) || 'Бумага Co ' || user_id || ' {$' || CASE WHEN event_id % 37 = 5 THEN 'X' ELSE 'T' END
         || user_id || '}' || chr(10)
         || CASE WHEN event_id % 2 = 0 THEN 'Потенциал роста ' ELSE 'Потенциал падения ' END
         || CASE WHEN event_id % 11 = 0 THEN replace(CAST((1 + k) / 2 AS VARCHAR), '.', ',')
                 ELSE CAST((1 + k) / 2 AS VARCHAR) END
         || '%' || chr(10) || 'Срок ' || (1 + event_id % 10) || ' дней' || chr(10)
         || 'В ' || (50 + k % 50) || '% случаев' || chr(10) || 'по сигналу индикатора RSI' || (k % 5)
         || CASE WHEN event_id % 7 = 0 THEN
              chr(10) || 'Бумага Co ' || (user_id + 1) || ' {$T' || (user_id + 1) || '}' || chr(10)
              || 'Потенциал роста ' || CAST(k / 4 AS VARCHAR) || '%' || chr(10)
              || 'Срок ' || (2 + event_id % 5) || ' дней' || chr(10)
              || 'В ' || (40 + k % 40) || '% случаев' || chr(10) || 'по сигналу индикатора MACD' || (k % 3)
            ELSE '' END AS text
  FROM pe)"""

_SEC = r"(?s)^.*Бумага (.*)\.*\{\$(.*)\}.*"
_RISE = r"(?s)^.*роста (.*)%"
_FALL = r"(?s)^.*падения (.*)%"
_PCT = r"(?s)^.*В (.*)%.*"
_TERM = r"(?s)^.*Срок (\d+) "
_IND = r"(?s)^.*индикатора (.*)"


def _grp(s: str, pat: str, g: int = 1) -> str:
    return f"(CASE WHEN regexp_matches({s}, '{pat}') THEN regexp_extract({s}, '{pat}', {g}) END)"


def _trim(s: str) -> str:
    return rf"regexp_replace({s}, '^\s+|\s+$', '', 'g')"


def _block(lines: str, pos: str) -> dict[str, str]:
    ln = [f"{lines}[{pos} + {1 + j}]" for j in range(5)]
    rise = f"contains({ln[1]}, 'Потенциал роста')"
    raw = f"(CASE WHEN {rise} THEN {_grp(ln[1], _RISE)} ELSE {_grp(ln[1], _FALL)} END)"
    delta = f"TRY_CAST({_trim(raw)} AS DOUBLE)"
    pct = f"TRY_CAST({_trim(_grp(ln[3], _PCT))} AS INTEGER)"
    term = f"TRY_CAST({_grp(ln[2], _TERM)} AS INTEGER)"
    ind = _trim(_grp(ln[4], _IND))
    company = _grp(ln[0], _SEC, 1)
    reason = (f"(CASE WHEN {pos} + 5 > len({lines}) THEN 'short_block' WHEN {company} IS NULL THEN 'no_security' "
              f"WHEN {raw} IS NULL THEN 'no_potential' WHEN {delta} IS NULL THEN 'bad_potential' "
              f"WHEN {pct} IS NULL THEN 'bad_percent' WHEN {term} IS NULL THEN 'bad_term' "
              f"WHEN {ind} IS NULL THEN 'bad_indicator' END)")
    return {
        "company": company,
        "ticker": _grp(ln[0], _SEC, 2),
        "forecast_direction": f"(CASE WHEN {rise} THEN 1 ELSE 2 END)",
        "price_delta_forecast": f"(CASE WHEN {rise} THEN {delta} ELSE -{delta} END)",
        "success_procent": pct,
        "term": term,
        "indicator_name": ind,
        "reason": reason,
    }


_KEPT = ("(list_reduce(list_filter(range(0, len(lines)), lambda i: coalesce(contains(lines[i + 1], 'Бумага'), false)), "
         "lambda acc, i: CASE WHEN i >= acc.nxt THEN {'nxt': CASE WHEN " + _block("lines", "i")["reason"]
         + " IS NULL THEN i + 1 ELSE i + 5 END, 'keep': list_append(acc.keep, i)} ELSE acc END, "
         "{'nxt': 0::BIGINT, 'keep': []::BIGINT[]})).keep")

_BF = _block("lines", "bpos")


def blocks_cte(src: str = "posts", name: str = "blocks", where: str = "TRUE") -> str:
    fields = ", ".join(f"{v} AS {k}" for k, v in _BF.items())
    return (f"{name} AS (\n  SELECT analyst_company_id, external_id, date_inserted, CAST(bpos AS INTEGER) AS block_pos, "
            f"{fields}\n  FROM (SELECT *, unnest(kept) AS bpos FROM (SELECT *, {_KEPT} AS kept\n"
            f"        FROM (SELECT *, string_split(text, chr(10)) AS lines FROM {src} WHERE {where}))))")


def parsed_cte(blocks: str = "blocks", all_name: str = "parsed_all", name: str = "parsed") -> str:
    return f"""{all_name} AS (
  SELECT * EXCLUDE (reason), CAST(date_inserted AS DATE) AS start_date,
         CAST(date_inserted AS DATE) + term AS end_date
  FROM {blocks} WHERE reason IS NULL),
{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {KEYS}
                                 ORDER BY date_inserted DESC, external_id DESC, block_pos ASC) AS rn
    FROM {all_name}) WHERE rn = 1)"""


STOCKS = r"""inst AS (
  SELECT 'T' || CAST(c_custkey AS VARCHAR) AS ticker, 'F' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS figi,
         c_name AS stock_name, CASE WHEN c_custkey % 4 = 0 THEN 'RU' ELSE 'US' END AS country_id,
         CASE WHEN c_acctbal < 0 THEN 'usd' WHEN c_custkey % 4 = 0 THEN 'rub' ELSE 'usd' END AS currency,
         CAST(1 + c_custkey % 10 AS INTEGER) AS lot,
         CASE WHEN c_custkey % 4 = 0 THEN 'TQBR' ELSE 'SPBXM' END AS class_code, lower(c_mktsegment) AS sector
  FROM customer
  UNION ALL
  SELECT 'T' || CAST(c_custkey AS VARCHAR), 'G' || lpad(CAST(c_custkey AS VARCHAR), 8, '0'),
         c_name, CASE WHEN c_custkey % 4 = 0 THEN 'RU' ELSE 'US' END,
         CASE WHEN c_acctbal < 0 THEN 'usd' WHEN c_custkey % 4 = 0 THEN 'rub' ELSE 'usd' END,
         CAST(1 + c_custkey % 10 AS INTEGER), CASE WHEN c_custkey % 4 = 0 THEN 'TQBR' ELSE 'SPBXM' END,
         lower(c_mktsegment)
  FROM customer WHERE c_custkey % 50 = 0),
stocks AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY figi) AS rn FROM inst)
  WHERE rn = 1)"""

KNOWN = """known AS (SELECT * FROM parsed WHERE ticker IN (SELECT ticker FROM stocks))"""


def priced_cte(as_of: str, now: str, src: str = "known", name: str = "priced") -> str:
    hi = f"CASE WHEN p.end_date IS NULL OR p.end_date >= {as_of} THEN {now} ELSE CAST(p.end_date AS TIMESTAMP) + INTERVAL 12 HOUR END"
    return f"""{name}_fl AS (
  SELECT p.analyst_company_id, p.ticker, p.start_date,
         arg_min(q.open_price, q.datetime_start) AS first_open, arg_max(q.open_price, q.datetime_start) AS last_open
  FROM {src} p JOIN quotes q ON q.ticker = p.ticker
       AND q.datetime_start >= p.date_inserted AND q.datetime_start <= {hi}
  GROUP BY p.analyst_company_id, p.ticker, p.start_date),
{name} AS (
  SELECT k.* EXCLUDE (price_delta_forecast), CAST(k.price_delta_forecast AS DECIMAL(7,3)) AS price_delta_forecast,
         f.first_open AS price_start,
         CASE WHEN k.end_date <= {as_of} THEN CAST(f.last_open AS DECIMAL(16,10)) END AS price_end,
         CAST(f.first_open * (1 + CAST(k.price_delta_forecast AS DECIMAL(7,3)) * 0.01) AS DECIMAL(16,6)) AS price_forecast,
         CAST(NULL AS SMALLINT) AS forecast_result
  FROM {src} k LEFT JOIN {name}_fl f USING ({KEYS}))"""


DUE = f"""due AS (SELECT * FROM priced WHERE forecast_result IS NULL AND end_date < {AS_OF} AND price_start IS NOT NULL)"""


def extrema_cte(src: str = "due", name: str = "ext", lo: str = "CAST(d.start_date AS TIMESTAMP)") -> str:
    return f"""{name} AS (
  SELECT d.analyst_company_id, d.ticker, d.start_date,
         max(q.high_price) AS price_max_real,
         arg_max(q.datetime_end, {{'p': q.high_price, 'o': -epoch_us(q.datetime_end)}}) FILTER (WHERE q.high_price IS NOT NULL) AS price_max_date,
         min(q.low_price) AS price_min_real,
         arg_min(q.datetime_end, {{'p': q.low_price, 'o': epoch_us(q.datetime_end)}}) FILTER (WHERE q.low_price IS NOT NULL) AS price_min_date
  FROM {src} d JOIN quotes q ON q.ticker = d.ticker
       AND q.datetime_end >= {lo}
       AND q.datetime_end <= CAST(d.end_date AS TIMESTAMP) + INTERVAL 12 HOUR
  GROUP BY d.analyst_company_id, d.ticker, d.start_date)"""


def pct3(x: str, p0: str) -> str:
    """Exact 100*(x-p0)/p0 rounded half-even to 3 places, as DECIMAL(7,3)."""
    n = f"(CAST(({x} - {p0}) * 10000000000 AS HUGEINT) * 10)"
    b = f"CAST({p0} * 1000000 AS HUGEINT)"
    q = f"(abs({n}) // abs({b}))"
    r = f"(abs({n}) - {q} * abs({b}))"
    q2 = f"({q} + CASE WHEN 2 * {r} > abs({b}) OR (2 * {r} = abs({b}) AND {q} % 2 = 1) THEN 1 ELSE 0 END)"
    v = f"(sign({n}) * sign({b}) * {q2})"
    return (f"(CASE WHEN {b} = 0 OR {b} IS NULL OR {n} IS NULL OR abs({q2}) >= 10000000 THEN NULL "
            f"ELSE CAST(CAST({v} AS DECIMAL(18,0)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(7,3)) END)")


CLOSED = f"""closed0 AS (
  SELECT d.*, e.price_max_real, e.price_max_date, e.price_min_real, e.price_min_date
  FROM due d JOIN ext e USING ({KEYS})
  WHERE d.price_end IS NOT NULL AND d.price_end <> 0),
closed1 AS (
  SELECT * EXCLUDE (forecast_result), {pct3('price_end', 'price_start')} AS end_real_price_delta,
         {pct3('price_max_real', 'price_start')} AS price_max_delta,
         {pct3('price_min_real', 'price_start')} AS price_min_delta
  FROM closed0),
closed AS (
  SELECT *, CAST(CASE WHEN end_real_price_delta = 0 THEN 3
              WHEN forecast_direction = 1 AND end_real_price_delta > 0 THEN 1
              WHEN forecast_direction = 1 AND end_real_price_delta < 0 THEN 2
              WHEN forecast_direction = 2 AND end_real_price_delta < 0 THEN 1
              WHEN forecast_direction = 2 AND end_real_price_delta > 0 THEN 2 END AS SMALLINT) AS forecast_result
  FROM closed1)"""


def _days(x: str) -> str:
    d = f"date_diff('day', start_date, CAST({x} AS DATE))"
    return f"(CASE WHEN {d} = 0 THEN 1 ELSE {d} END)"


def _outcome_sql() -> str:
    d, ps, pe = "CAST(price_delta_forecast AS DOUBLE)", "CAST(price_start AS DOUBLE)", "CAST(price_end AS DOUBLE)"
    mx, mn = "CAST(price_max_real AS DOUBLE)", "CAST(price_min_real AS DOUBLE)"
    mxd, mnd = "price_max_date", "price_min_date"
    endp = f"((100 * ({pe} - {ps}) / {ps}) / {_days('end_date')})"
    stop = f"({ps} * (1 - 0.5 * {d} / 100))"

    def tgt(c):
        return f"({ps} * (1 + {c} * {d} / 100))"

    t50 = tgt("0.5")
    rise50 = [
        (f"{stop} >= {mn} AND ({mnd} <= {mxd} OR {mx} < {t50})", "-1", f"(-0.5 * {d}) / {_days(mnd)}"),
        (f"{stop} < {mn} AND {mx} < {t50} AND {pe} <= {ps}", "-2", endp),
        (f"{mx} > {t50} AND ({mxd} <= {mnd} OR {stop} < {mn})", "1", f"(0.5 * {d}) / {_days(mxd)}"),
        (f"{mx} < {t50} AND {stop} < {mn} AND {pe} >= {ps}", "2", endp),
    ]
    fall50 = [
        (f"{stop} <= {mx} AND ({mxd} <= {mnd} OR {mn} > {t50})", "-1", f"(0.5 * {d}) / {_days(mxd)}"),
        (f"{stop} > {mx} AND {mn} > {t50} AND {pe} >= {ps}", "-2", endp),
        (f"{mn} < {t50} AND ({mnd} < {mxd} OR {stop} > {mx})", "1", f"(-0.5 * {d}) / {_days(mnd)}"),
        (f"{mn} > {t50} AND {stop} > {mx} AND {pe} <= {ps}", "2",
         f"((100 * ({ps} - {pe}) / {ps}) / {_days('end_date')})"),
    ]

    def chain(branches, part):
        idx = 1 if part == "c" else 2
        body = " ".join(f"WHEN {b[0]} THEN {b[idx]}" for b in branches)
        return f"CASE {body} ELSE {'0' if part == 'c' else '0.0'} END"

    out = {}
    for name, branches in (("rise", rise50), ("fall", fall50)):
        out[(name, "res50")] = f"CAST({chain(branches, 'c')} AS INTEGER)"
        out[(name, "proc50")] = f"CAST({chain(branches, 'y')} AS DOUBLE)"
    for e, c in (("90", "0.9"), ("100", "1")):
        hit_r = f"{mx} > {tgt(c)}"
        out[("rise", "res" + e)] = f"CAST(CASE WHEN {hit_r} THEN 1 WHEN {endp} < 0 THEN -1 ELSE 2 END AS INTEGER)"
        out[("rise", "proc" + e)] = f"CAST(CASE WHEN {hit_r} THEN ({c} * {d}) / {_days(mxd)} ELSE {endp} END AS DOUBLE)"
        hit_f = f"{mn} < {tgt(c)}"
        out[("fall", "res" + e)] = f"CAST(CASE WHEN {hit_f} THEN 1 WHEN {endp} > 0 THEN -1 ELSE 2 END AS INTEGER)"
        out[("fall", "proc" + e)] = f"CAST(CASE WHEN {hit_f} THEN (-{c} * {d}) / {_days(mnd)} ELSE -{endp} END AS DOUBLE)"
    cols = []
    for f in ("res50", "proc50", "res90", "proc90", "res100", "proc100"):
        cols.append(f"CASE WHEN forecast_direction = 1 THEN {out[('rise', f)]} "
                    f"WHEN forecast_direction = 2 THEN {out[('fall', f)]} END AS {f}")
    return ", ".join(cols)


SCORED = f"""scored AS (
  SELECT *, {_outcome_sql()}
  FROM closed WHERE forecast_result IS NOT NULL AND forecast_result <> 0)"""

INDICATORS = """indicators AS (
  SELECT indicator_name, success_procent AS success_proc FROM (
    SELECT *, row_number() OVER (PARTITION BY indicator_name
                                 ORDER BY date_inserted DESC, external_id DESC, block_pos ASC) AS rn
    FROM parsed) WHERE rn = 1)"""

PERIODS = """periods AS (
  SELECT * FROM (VALUES (0, 'all time', NULL::DATE, NULL::DATE, true),
                        (1, 'week 1', DATE '2024-01-01', DATE '2024-01-07', true),
                        (2, 'week 2', DATE '2024-01-08', DATE '2024-01-14', true),
                        (3, 'after week 2', DATE '2024-01-14', DATE '2024-01-31', false),
                        (4, 'q4 (empty)', DATE '2024-10-01', DATE '2024-12-31', true))
         v(period_id, period, lo, hi, lo_inclusive)),
inper AS (
  SELECT s.*, p.period_id, p.period FROM scored_x s JOIN periods p
    ON (p.lo IS NULL OR (p.lo_inclusive AND s.start_date >= p.lo) OR (NOT p.lo_inclusive AND s.start_date > p.lo))
   AND (p.hi IS NULL OR s.start_date <= p.hi))"""

CHAIN = [PX, QUOTES, POSTS, blocks_cte(), parsed_cte(), STOCKS, KNOWN, priced_cte(AS_OF, NOW), DUE,
         extrema_cte(), CLOSED, SCORED]

ORACLE["stock_dimension"] = _with(STOCKS) + "SELECT ticker, figi, stock_name, country_id, currency, lot, class_code, sector FROM stocks"

ORACLE["asset_shares"] = r"""SELECT ticker, figi, stock_name, class_code FROM (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS ticker, 'S' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS figi,
         p_name AS stock_name, 'TQBR' AS class_code FROM part WHERE p_size % 3 <> 0
  UNION ALL
  SELECT 'B' || CAST(p_partkey AS VARCHAR), 'O' || lpad(CAST(p_partkey AS VARCHAR), 8, '0'), p_name, 'TQOB'
  FROM part WHERE p_size % 3 <> 0 AND p_size % 2 <> 0)"""

ORACLE["parsed_forecasts"] = _with(POSTS, blocks_cte(), parsed_cte()) + f"""
SELECT {KEYS}, end_date, CAST(forecast_direction AS INTEGER) AS forecast_direction, price_delta_forecast,
       success_procent, term, indicator_name, company, external_id, date_inserted, block_pos
FROM parsed"""

ORACLE["rejected_blocks"] = _with(POSTS, blocks_cte()) + """
SELECT analyst_company_id, external_id, date_inserted, block_pos, reason FROM blocks WHERE reason IS NOT NULL"""

ORACLE["new_indicators"] = _with(POSTS, blocks_cte(), parsed_cte(), INDICATORS) + "SELECT * FROM indicators"

ORACLE["unknown_tickers"] = _with(POSTS, blocks_cte(), parsed_cte(), STOCKS) + f"""
SELECT {KEYS}, external_id FROM parsed WHERE ticker NOT IN (SELECT ticker FROM stocks)"""

ORACLE["priced_forecasts"] = _with(*CHAIN[:8]) + f"""
SELECT {KEYS}, end_date, CAST(forecast_direction AS INTEGER) AS forecast_direction, external_id, indicator_name,
       CAST(price_delta_forecast AS DOUBLE) AS price_delta_forecast, CAST(price_start AS DOUBLE) AS price_start,
       CAST(price_forecast AS DOUBLE) AS price_forecast, CAST(price_end AS DOUBLE) AS price_end
FROM priced"""

ORACLE["span_extrema"] = _with(*CHAIN[:10]) + f"""
SELECT {KEYS}, CAST(price_max_real AS DOUBLE) AS price_max_real, CAST(price_min_real AS DOUBLE) AS price_min_real,
       price_max_date, price_min_date FROM ext"""

ORACLE["closed_forecasts"] = _with(*CHAIN[:11]) + f"""
SELECT {KEYS}, CAST(forecast_direction AS INTEGER) AS forecast_direction,
       CAST(forecast_result AS INTEGER) AS forecast_result,
       CAST(end_real_price_delta AS DOUBLE) AS end_real_price_delta,
       CAST(price_max_delta AS DOUBLE) AS price_max_delta, CAST(price_min_delta AS DOUBLE) AS price_min_delta,
       CAST(price_max_real AS DOUBLE) AS price_max_real, CAST(price_min_real AS DOUBLE) AS price_min_real,
       price_max_date, price_min_date
FROM closed"""

ORACLE["rise_outcomes"] = _with(*CHAIN) + f"""
SELECT {KEYS}, res50, proc50, res90, proc90, res100, proc100 FROM scored WHERE forecast_direction = 1"""

ORACLE["fall_outcomes"] = _with(*CHAIN) + f"""
SELECT {KEYS}, res50, proc50, res90, proc90, res100, proc100 FROM scored WHERE forecast_direction = 2"""

ORACLE["forecast_metrics"] = _with(*CHAIN, "scored_x AS (SELECT * FROM scored)", PERIODS) + """,
m AS (
  SELECT period_id, forecast_direction AS direction, count(*) AS forecasts,
         min(start_date) AS min_start_date, max(start_date) AS max_start_date,
         count(*) FILTER (WHERE res50 >= 1) AS success50, avg(proc50) AS yield50,
         count(*) FILTER (WHERE res90 >= 1) AS success90, avg(proc90) AS yield90,
         count(*) FILTER (WHERE res100 >= 1) AS success100, avg(proc100) AS yield100
  FROM inper GROUP BY period_id, forecast_direction),
grid AS (SELECT p.period_id, p.period, d.direction FROM periods p, (VALUES (1), (2)) d(direction))
SELECT g.period_id, g.period, g.direction,
       coalesce(m.forecasts, 0) AS forecasts, coalesce(m.success50, 0) AS success50,
       coalesce(m.success90, 0) AS success90, coalesce(m.success100, 0) AS success100,
       m.min_start_date, m.max_start_date,
       round(m.yield50, 6) AS yield50, round(m.yield90, 6) AS yield90, round(m.yield100, 6) AS yield100
FROM grid g LEFT JOIN m ON g.period_id = m.period_id AND g.direction = m.direction"""

_REPORT_METRICS = ["rise_forecasts", "fall_forecasts"] + [
    f"{d}_{kind}_{e}" for d in ("rise", "fall") for e in ("50", "90", "100") for kind in ("success_pct", "yield")]


def _report_sql() -> str:
    wide_cols = ["min(start_date) FILTER (WHERE forecast_direction = 1) AS min_date",
                 "max(start_date) FILTER (WHERE forecast_direction = 1) AS max_date",
                 "CAST(count(*) FILTER (WHERE forecast_direction = 1) AS DOUBLE) AS rise_forecasts",
                 "CAST(count(*) FILTER (WHERE forecast_direction = 2) AS DOUBLE) AS fall_forecasts"]
    for d, code in (("rise", 1), ("fall", 2)):
        for e in ("50", "90", "100"):
            n = f"count(*) FILTER (WHERE forecast_direction = {code})"
            ok = f"count(*) FILTER (WHERE forecast_direction = {code} AND res{e} >= 1)"
            wide_cols.append(f"CASE WHEN {n} = 0 THEN NULL ELSE 100.0 * {ok} / {n} END AS {d}_success_pct_{e}")
            wide_cols.append(f"avg(proc{e}) FILTER (WHERE forecast_direction = {code}) AS {d}_yield_{e}")
    lines = []
    for i, m in enumerate(_REPORT_METRICS):
        lines.append(f"SELECT CAST(10 + w.period_id * 20 + {i + 3} AS INTEGER) AS line, w.period, '{m}' AS metric, "
                     f"round(CAST(w.{m} AS DOUBLE), 6) AS value, CAST(NULL AS DATE) AS value_date FROM w")
    for i, m in enumerate(("min_date", "max_date")):
        lines.append(f"SELECT CAST(10 + w.period_id * 20 + {i + 1} AS INTEGER), w.period, '{m}', "
                     f"CAST(NULL AS DOUBLE), w.{m} FROM w")
    totals = ("SELECT CAST(1 AS INTEGER), 'total', 'all_forecasts', CAST(count(*) AS DOUBLE), CAST(NULL AS DATE) FROM scored_x "
              "UNION ALL SELECT 2, 'total', 'ru_forecasts', CAST(count(*) FILTER (WHERE country_id = 'RU') AS DOUBLE), NULL FROM scored_x "
              "UNION ALL SELECT 3, 'total', 'other_forecasts', CAST(count(*) FILTER (WHERE country_id <> 'RU') AS DOUBLE), NULL FROM scored_x")
    return (f""",
wide AS (SELECT period_id, {', '.join(wide_cols)} FROM inper GROUP BY period_id),
w AS (SELECT p.period_id, p.period, wide.* EXCLUDE (period_id) FROM periods p LEFT JOIN wide ON p.period_id = wide.period_id)
""" + "\nUNION ALL ".join(lines) + "\nUNION ALL " + totals)


ORACLE["effectiveness_report"] = _with(
    *CHAIN, INDICATORS,
    """scored_x AS (SELECT s.*, st.stock_name, st.country_id, st.sector, i.success_proc
                 FROM scored s JOIN stocks st ON s.ticker = st.ticker
                 JOIN indicators i ON s.indicator_name = i.indicator_name)""",
    PERIODS) + _report_sql()

LIVE = [PX, QUOTES, POSTS, blocks_cte(), parsed_cte(), STOCKS, KNOWN, priced_cte(LIVE_AS_OF, LIVE_NOW, name="live"),
        f"""active AS (SELECT * FROM live WHERE forecast_result IS NULL AND end_date >= {LIVE_AS_OF}
                      AND price_start IS NOT NULL)""",
        f"""stored AS (SELECT *, {LOADED_AT} AS created_at, {LOADED_AT} AS updated_at
                      FROM quotes WHERE datetime_start < {LOADED_AT})"""]

ORACLE["active_forecasts"] = _with(*LIVE) + f"""
SELECT {KEYS}, end_date, CAST(price_start AS DOUBLE) AS price_start, CAST(price_end AS DOUBLE) AS price_end FROM active"""

ORACLE["due_forecasts"] = _with(*LIVE) + f"""
SELECT {KEYS}, end_date, CAST(price_start AS DOUBLE) AS price_start, CAST(price_end AS DOUBLE) AS price_end
FROM live WHERE forecast_result IS NULL AND end_date < {LIVE_AS_OF} AND price_start IS NOT NULL
  AND analyst_company_id = 2"""

ORACLE["due_forecasts_all"] = ORACLE["due_forecasts"].replace("\n  AND analyst_company_id = 2", "")

HW = """hw AS (SELECT ticker, max(datetime_end) AS date_inserted FROM stored
              WHERE ticker IN (SELECT ticker FROM active) GROUP BY ticker),
starts AS (SELECT a.ticker, coalesce(hw.date_inserted, a.posted) AS fetch_from
           FROM (SELECT ticker, min(date_inserted) AS posted FROM active GROUP BY ticker) a
           LEFT JOIN hw ON a.ticker = hw.ticker),
inc AS (SELECT q.* FROM quotes10 q JOIN starts s ON q.ticker = s.ticker WHERE q.datetime_start >= s.fetch_from)"""

ORACLE["quote_high_water"] = _with(*LIVE, QUOTES10, HW) + "SELECT ticker, date_inserted FROM hw"

_QCOLS = ("CAST(open_price AS DOUBLE) AS open_price, CAST(close_price AS DOUBLE) AS close_price, "
          "CAST(high_price AS DOUBLE) AS high_price, CAST(low_price AS DOUBLE) AS low_price")

ORACLE["incremental_quotes"] = _with(*LIVE, QUOTES10, HW) + f"""
SELECT ticker, datetime_start, datetime_end, {_QCOLS}, volume FROM inc"""

ORACLE["upsert_quotes"] = _with(*LIVE, QUOTES10, HW) + f"""
SELECT ticker, datetime_start, datetime_end, {_QCOLS}, volume, created_at, updated_at
FROM stored WHERE (ticker, datetime_start) NOT IN (SELECT (ticker, datetime_start) FROM inc)
UNION ALL
SELECT i.ticker, i.datetime_start, i.datetime_end, CAST(i.open_price AS DOUBLE), CAST(i.close_price AS DOUBLE),
       CAST(i.high_price AS DOUBLE), CAST(i.low_price AS DOUBLE), i.volume,
       coalesce(s.created_at, {LIVE_NOW}), {LIVE_NOW}
FROM inc i LEFT JOIN stored s ON i.ticker = s.ticker AND i.datetime_start = s.datetime_start"""

ORACLE["quotes_from_candles"] = _with(PX, QUOTES) + f"""
SELECT ticker, datetime_start, datetime_end, {_QCOLS}, volume FROM quotes"""

ORACLE["upsert_forecasts"] = _with(
    *CHAIN[:11],
    f"""stored AS (SELECT *, {LOADED_AT} AS created_at, {LOADED_AT} AS updated_at FROM closed)""",
    blocks_cte(name="rblocks", where=f"date_inserted >= {REPLAY_FROM}"),
    parsed_cte("rblocks", "rparsed_all", "rparsed"),
    "rknown AS (SELECT * FROM rparsed WHERE ticker IN (SELECT ticker FROM stocks))",
    priced_cte(AS_OF, NOW, src="rknown", name="batch")) + f"""
SELECT {KEYS}, end_date, external_id, CAST(forecast_result AS INTEGER) AS forecast_result,
       CAST(price_start AS DOUBLE) AS price_start, CAST(price_end AS DOUBLE) AS price_end,
       CAST(end_real_price_delta AS DOUBLE) AS end_real_price_delta, created_at, updated_at
FROM stored WHERE ({KEYS}) NOT IN (SELECT ({KEYS}) FROM batch)
UNION ALL
SELECT b.analyst_company_id, b.ticker, b.start_date, b.end_date, b.external_id,
       CASE WHEN s.ticker IS NULL THEN CAST(b.forecast_result AS INTEGER) ELSE CAST(s.forecast_result AS INTEGER) END,
       CAST(b.price_start AS DOUBLE), CAST(b.price_end AS DOUBLE),
       CASE WHEN s.ticker IS NULL THEN NULL ELSE CAST(s.end_real_price_delta AS DOUBLE) END,
       coalesce(s.created_at, {NOW}), {NOW}
FROM batch b LEFT JOIN stored s USING ({KEYS})"""

ORACLE["last_run"] = _with(POSTS, f"""runs AS (
  SELECT 1 AS run_id, analyst_company_id, max(date_inserted) AS forecast_datetime,
         arg_max(external_id, {{'d': date_inserted, 'e': external_id}}) AS external_id
  FROM posts WHERE date_inserted < {REPLAY_FROM} GROUP BY analyst_company_id
  UNION ALL
  SELECT 2, analyst_company_id, max(date_inserted), arg_max(external_id, {{'d': date_inserted, 'e': external_id}})
  FROM posts WHERE date_inserted >= {REPLAY_FROM} GROUP BY analyst_company_id)""") + """
SELECT analyst_company_id, CAST(arg_max(run_id, {'f': forecast_datetime, 'r': run_id}) AS BIGINT) AS run_id,
       max(forecast_datetime) AS hwm, arg_max(external_id, {'f': forecast_datetime, 'r': run_id}) AS external_id
FROM runs WHERE forecast_datetime IS NOT NULL GROUP BY analyst_company_id"""

ORACLE["company_external_ids"] = _with(POSTS, blocks_cte(), parsed_cte()) + """
SELECT DISTINCT external_id FROM parsed WHERE analyst_company_id = 2"""

# --- weblog --------------------------------------------------------------------

_URI = r"((?:/[A-Za-z0-9$.+!*''(){},~:;=@#%&_\-]*)+)(\?[A-Za-z0-9$.+!*''|(){},~@#%&/=:;_?\-\[\]<>]*)?"

WEBLOG = rf"""wl AS (
  SELECT '10.0.0.' || CAST(user_id % 256 AS VARCHAR) AS IP, '[' || strftime(ts, '%d/%b/%Y:%H:%M:%S') AS Time,
         CASE WHEN k = 0 THEN 'ReadInput' ELSE 'GET /' || event_type || '.php'
              || CASE WHEN k % 3 = 0 THEN '?k=' || CAST(k AS VARCHAR) ELSE '' END || ' HTTP/1.1' END AS URL,
         CASE WHEN event_type = 'error' THEN '500' ELSE '200' END || ' ' AS Status
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)),
pv0 AS (
  SELECT *, nullif(regexp_extract(URL, '{_URI}', 1), '') AS page_visited,
         nullif(regexp_extract(URL, '{_URI}', 2), '') AS page_params,
         regexp_replace(Status, '\s', '', 'g') AS status_txt,
         CASE WHEN starts_with(Time, '[') THEN substr(Time, 2) END AS time_txt
  FROM wl),
pv AS (
  SELECT *, TRY_CAST(status_txt AS INTEGER) AS status_code,
         try_strptime(coalesce(time_txt, Time), '%d/%b/%Y:%H:%M:%S') AS parsed_time,
         coalesce(try_strptime(coalesce(time_txt, Time), '%d/%b/%Y:%H:%M:%S'), TIMESTAMP '2024-02-01 00:00:00') AS event_time
  FROM pv0)"""

ORACLE["page_views"] = _with(WEBLOG) + """
SELECT page_visited, page_params, status_code AS status, count(*) AS views, min(event_time) AS first_seen,
       max(event_time) AS last_seen
FROM pv GROUP BY page_visited, page_params, status_code"""

ORACLE["page_view_tags"] = _with(WEBLOG) + """
SELECT tags, count(*) AS events FROM (
  SELECT concat_ws(',', CASE WHEN page_visited IS NULL THEN '_grokparsefailure' END,
                        CASE WHEN time_txt IS NULL THEN '_dissectfailure' END,
                        CASE WHEN status_code IS NULL AND status_txt <> '' THEN '_convertfailure' END,
                        CASE WHEN parsed_time IS NULL THEN '_dateparsefailure' END) AS tags
  FROM pv) GROUP BY tags"""

ORACLE["keyword_fields"] = """
SELECT doc_id, CASE WHEN length(text) <= 256 THEN text END AS text_keyword,
       CASE WHEN length(lang) <= 256 THEN lang END AS lang_keyword,
       CASE WHEN length(source) <= 256 THEN source END AS source_keyword,
       length(text) AS text_chars
FROM documents"""

# --- data quality --------------------------------------------------------------

ORACLE["key_violations"] = _with(POSTS, blocks_cte(), parsed_cte()) + f"""
SELECT {KEYS}, count(*) AS n FROM parsed_all GROUP BY {KEYS} HAVING count(*) > 1"""

ORACLE["null_violations"] = _with(*CHAIN[:8]) + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM priced"
    for c in ["ticker", "start_date", "end_date", "forecast_direction", "price_delta_forecast",
              "price_start", "price_end"])

ORACLE["orphans"] = _with(POSTS, blocks_cte(), parsed_cte(), STOCKS) + """
SELECT 'lineitem.l_partkey' AS reference, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS row_key
FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL
SELECT 'forecast.ticker', CAST(analyst_company_id AS VARCHAR) || '|' || ticker || '|' || CAST(start_date AS VARCHAR)
FROM parsed WHERE ticker NOT IN (SELECT ticker FROM stocks)"""

ORACLE["overflow_violations"] = _with(POSTS, blocks_cte(), parsed_cte()) + f"""
SELECT {KEYS}, block_pos, concat_ws(',', CASE WHEN TRY_CAST(price_delta_forecast AS DECIMAL(3,1)) IS NULL THEN 'price_delta_forecast:decimal(3,1)' END,
                            CASE WHEN length(ticker) > 20 THEN 'ticker:len>20' END,
                            CASE WHEN length(external_id) > 3 THEN 'external_id:len>3' END) AS violations
FROM parsed_all WHERE TRY_CAST(price_delta_forecast AS DECIMAL(3,1)) IS NULL OR length(ticker) > 20 OR length(external_id) > 3"""

ORACLE["code_violations"] = """
SELECT conv_id, turn, role FROM conversations WHERE role NOT IN ('user', 'assistant')"""


ORACLE["backfilled_end_prices"] = _with(*LIVE, f"""bf AS (
  SELECT l.analyst_company_id, l.ticker, l.start_date, arg_max(q.open_price, q.datetime_start) AS pe
  FROM live l JOIN quotes q ON q.ticker = l.ticker AND q.datetime_start >= l.date_inserted
       AND q.datetime_start <= CAST(l.end_date AS TIMESTAMP) + INTERVAL 12 HOUR
  WHERE l.price_end IS NULL AND l.end_date <= {AS_OF} AND l.price_start IS NOT NULL AND l.forecast_result IS NULL
  GROUP BY l.analyst_company_id, l.ticker, l.start_date)""") + f"""
SELECT {KEYS}, end_date, CAST(price_start AS DOUBLE) AS price_start,
       CAST(coalesce(price_end, CAST(bf.pe AS DECIMAL(16,10))) AS DOUBLE) AS price_end
FROM live LEFT JOIN bf USING ({KEYS})"""

ORACLE["mixed_candle_lengths"] = _with(*LIVE, QUOTES10, HW, """u AS (
  SELECT ticker, datetime_start, datetime_end FROM stored
  WHERE (ticker, datetime_start) NOT IN (SELECT (ticker, datetime_start) FROM inc)
  UNION ALL SELECT ticker, datetime_start, datetime_end FROM inc)""") + """
SELECT ticker, count(*) AS lengths, CAST(sum(candles) AS BIGINT) AS candles, min(candle_seconds) AS min_seconds,
       max(candle_seconds) AS max_seconds
FROM (SELECT ticker, date_diff('second', datetime_start, datetime_end) AS candle_seconds, count(*) AS candles
      FROM u GROUP BY ticker, date_diff('second', datetime_start, datetime_end))
GROUP BY ticker HAVING count(*) > 1"""

ORACLE["closed_from_post_time"] = _with(*CHAIN[:9], extrema_cte(lo="d.date_inserted"), CLOSED) + f"""
SELECT {KEYS}, CAST(forecast_result AS INTEGER) AS forecast_result,
       CAST(price_max_delta AS DOUBLE) AS price_max_delta, CAST(price_min_delta AS DOUBLE) AS price_min_delta,
       price_max_date, price_min_date
FROM closed"""

ORACLE["upsert_stocks"] = _with(POSTS, blocks_cte(), parsed_cte(), STOCKS) + f"""
SELECT s.ticker, s.figi, s.stock_name, s.currency, s.lot,
       CASE WHEN old.ticker IS NULL THEN {NOW} ELSE {LOADED_AT} END AS created_at, {NOW} AS updated_at
FROM stocks s LEFT JOIN (SELECT DISTINCT ticker FROM parsed WHERE date_inserted < {REPLAY_FROM}) old ON s.ticker = old.ticker"""


ORACLE["fetch_requests"] = _with(*LIVE, QUOTES10, HW) + f"""
SELECT s.ticker, st.figi, s.fetch_from AS from_ts, {LIVE_NOW} AS to_ts, 'CANDLE_INTERVAL_10_MIN' AS interval
FROM starts s JOIN stocks st ON s.ticker = st.ticker"""


# --- streaming twins: the final tables equal their batch twins ---------------------

ORACLE["page_views_stream"] = ORACLE["page_views"]
ORACLE["quotes_stream"] = ORACLE["quotes_from_candles"]
ORACLE["posts_stream"] = _with(POSTS, blocks_cte(), parsed_cte()) + f"""
SELECT {KEYS}, end_date, CAST(forecast_direction AS INTEGER) AS forecast_direction,
       CAST(CAST(price_delta_forecast AS DECIMAL(7,3)) AS DOUBLE) AS price_delta_forecast,
       external_id, indicator_name, date_inserted
FROM parsed"""
ORACLE["posts_stream_rejected"] = ORACLE["rejected_blocks"]
ORACLE["quotes_stream_from_starts"] = _with(*LIVE, QUOTES10, HW) + f"""
SELECT q.ticker, q.datetime_start, q.datetime_end, CAST(q.open_price AS DOUBLE) AS open_price,
       CAST(q.close_price AS DOUBLE) AS close_price, CAST(q.high_price AS DOUBLE) AS high_price,
       CAST(q.low_price AS DOUBLE) AS low_price, q.volume
FROM quotes q JOIN starts s ON q.ticker = s.ticker WHERE q.datetime_start >= s.fetch_from"""


# --- paths not covered above -------------------------------------------------------

ORACLE["parsed_since_high_water"] = _with(
    POSTS, f"""done AS (SELECT analyst_company_id AS company, max(date_inserted) AS hwm FROM posts
      WHERE date_inserted < {REPLAY_FROM} AND analyst_company_id <> 3 GROUP BY 1),
fresh AS (SELECT posts.* FROM posts LEFT JOIN done ON company = analyst_company_id
          WHERE date_inserted > coalesce(hwm, TIMESTAMP '1970-01-01 00:00:00'))""",
    blocks_cte("fresh"), parsed_cte()) + f"SELECT {KEYS}, end_date, external_id FROM parsed"

ORACLE["upsert_indicators"] = _with(POSTS, blocks_cte(), parsed_cte(), f"""ranked AS (
  SELECT indicator_name, success_procent, date_inserted < {REPLAY_FROM} AS early,
         row_number() OVER (PARTITION BY indicator_name, date_inserted < {REPLAY_FROM}
                            ORDER BY date_inserted DESC, external_id DESC, block_pos ASC) AS rn FROM parsed)""") + f"""
SELECT indicator_name, arg_max(success_procent, early) AS success_proc,
       CASE WHEN bool_or(early) THEN {LOADED_AT} ELSE {NOW} END AS created_at,
       CASE WHEN bool_or(early) THEN {LOADED_AT} ELSE {NOW} END AS updated_at
FROM ranked WHERE rn = 1 GROUP BY indicator_name"""

ORACLE["index_documents"] = _with(WEBLOG) + """
SELECT IP AS IP_keyword, CASE WHEN page_visited IS NULL THEN URL END AS URL_keyword,
       page_visited AS page_visited_keyword, page_params AS page_params_keyword, 'weblog' AS type_keyword,
       concat_ws(',', CASE WHEN page_visited IS NULL THEN '_grokparsefailure' END,
                 CASE WHEN time_txt IS NULL THEN '_dissectfailure' END,
                 CASE WHEN status_code IS NULL AND status_txt <> '' THEN '_convertfailure' END,
                 CASE WHEN parsed_time IS NULL THEN '_dateparsefailure' END) AS tags_keyword,
       count(*) AS documents
FROM pv GROUP BY ALL"""

ORACLE["rendered_report"] = f"""WITH report AS ({ORACLE["effectiveness_report"]})
SELECT line, metric AS parameter,
       coalesce(CASE WHEN value_date IS NOT NULL THEN strftime(value_date, '%Y-%m-%d') WHEN value IS NULL THEN NULL
                WHEN contains(metric, 'success_pct') THEN printf('%.1f', round(value, 1))
                WHEN contains(metric, 'yield') THEN printf('%.3f', round(value, 3))
                ELSE CAST(CAST(value AS BIGINT) AS VARCHAR) END, '') AS value
FROM report
UNION ALL SELECT line - 1, period, '' FROM report WHERE metric = 'min_date'
UNION ALL SELECT line - 2, '', '' FROM report WHERE metric = 'min_date' AND line > 11"""

ORACLE["declared_key_violations"] = _with(PX, QUOTES, POSTS, blocks_cte(), parsed_cte(), STOCKS, f"""runs AS (
  SELECT max(date_inserted) AS forecast_datetime FROM posts
  GROUP BY analyst_company_id, date_inserted < {REPLAY_FROM})""") + f"""
SELECT 'stocks' AS table_name, count(*) AS repeated_keys FROM (SELECT ticker FROM inst GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'indicators', count(*) FROM (SELECT indicator_name FROM parsed_all GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'stocks_forecasts', count(*) FROM (SELECT {KEYS} FROM parsed_all GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'stocks_quotes', count(*) FROM quotes
UNION ALL SELECT 'parser_log', count(*) FROM (SELECT forecast_datetime FROM runs GROUP BY ALL HAVING count(*) > 1)"""


# --- streams with state, counts while the data passes ------------------------------

ORACLE["page_view_places"] = _with(WEBLOG.replace(
    "'[' || strftime(ts, '%d/%b/%Y:%H:%M:%S') AS Time", """'[' || CASE WHEN event_id % 19 = 7 THEN 'no time'
         ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') END AS Time, ts >= TIMESTAMP '2024-01-20'
         OR (ts < TIMESTAMP '2024-01-19' AND event_id % 10 = 4) AS second_drop""")) + """,
d AS (SELECT 1 AS n, * FROM pv WHERE NOT second_drop UNION ALL SELECT 2, * FROM pv WHERE second_drop UNION ALL SELECT 3, * FROM pv),
m AS (SELECT n + 1 AS n, max(parsed_time) AS newest FROM d GROUP BY n),
k AS (SELECT d.*, CASE WHEN parsed_time IS NULL THEN 'untimed'
          WHEN parsed_time < (SELECT max(newest) FROM m WHERE m.n <= d.n) - INTERVAL 6 HOUR THEN 'late' ELSE 'stored' END AS place FROM d),
r AS (SELECT place, page_visited, status_code, event_time FROM k WHERE place <> 'stored'
      UNION ALL SELECT place, page_visited, status_code, event_time
      FROM (SELECT DISTINCT place, IP, Time, URL, Status, page_visited, status_code, event_time FROM k WHERE place = 'stored'))
SELECT place, page_visited, status_code AS status, count(*) AS events, min(event_time) AS first_seen, max(event_time) AS last_seen
FROM r GROUP BY ALL"""

ORACLE["quotes_stream_moving_start"] = _with(PX, QUOTES) + """
SELECT q.ticker, q.datetime_start, q.datetime_end, CAST(q.close_price AS DOUBLE) AS close_price,
       CASE WHEN q.datetime_start < h.hw THEN q.volume ELSE q.volume + 1000 END AS volume
FROM quotes q LEFT JOIN (SELECT ticker, max(datetime_end) AS hw FROM quotes
                         WHERE datetime_start < TIMESTAMP '2024-01-20' GROUP BY ticker) h ON h.ticker = q.ticker"""
ORACLE["quote_marks_stream"] = _with(PX, QUOTES) + "SELECT ticker, max(datetime_end) AS high_water FROM quotes GROUP BY ticker"

_PAGE_COUNTS = """SELECT 'posts' AS stage, 'documents' AS metric, count(*) AS rows FROM events
UNION ALL SELECT 'posts', 'unreadable', count(*) FILTER (event_id % 20 = 18) FROM events
UNION ALL SELECT 'posts', 'no_payload', count(*) FILTER (event_id % 20 = 3) FROM events
UNION ALL SELECT 'posts', 'no_items', count(*) FILTER (event_id % 20 = 8) FROM events
UNION ALL SELECT 'posts', 'empty', count(*) FILTER (event_id % 20 = 13) FROM events"""
ORACLE["observed_counts"] = _with(*CHAIN[:11], WEBLOG) + _PAGE_COUNTS + """
UNION ALL SELECT 'candles', 'documents', count(DISTINCT (ticker, CAST(datetime_start AS DATE))) FROM quotes
UNION ALL SELECT 'candles', unnest(['unreadable', 'no_candles', 'empty']), 0
UNION ALL SELECT 'outcomes', 'scored', count(*) FROM priced
UNION ALL SELECT 'outcomes', 'no_outcome', (SELECT count(*) FROM priced) - (SELECT count(*) FROM closed)
UNION ALL SELECT 'weblog', 'lines', count(*) FROM events
UNION ALL SELECT 'weblog', 'no_time', count(*) FILTER (event_id % 19 = 7) FROM events
UNION ALL SELECT 'weblog', 'no_page', count(*) FILTER (page_visited IS NULL) FROM pv"""
_HEALTHY = "pages AS (SELECT * FROM posts WHERE CAST(external_id AS BIGINT) % 20 NOT IN (3, 8, 13, 18))"
ORACLE["observed_counts_stream"] = _with(POSTS, _HEALTHY, blocks_cte("pages")) + _PAGE_COUNTS + """
UNION ALL SELECT 'blocks', 'blocks', count(*) FROM blocks
UNION ALL SELECT 'blocks', 'rejected', count(*) FILTER (reason IS NOT NULL) FROM blocks"""
ORACLE["parser_runs_stream"] = _with(POSTS, _HEALTHY, blocks_cte("pages")) + """
SELECT 0::BIGINT AS run_id, analyst_company_id, true AS closed, max(date_inserted) AS forecast_datetime,
       arg_max(external_id, {'d': date_inserted, 'e': external_id}) AS external_id
FROM blocks GROUP BY analyst_company_id"""


# --- landed CSV, long spans, code lists, first by id, indicator ids -------------------

ORACLE["district_mart_csv"] = ORACLE["district_mart"]
ORACLE["rejected_incident_lines"] = """
SELECT min(n) AS incident_number, min(n) || ',00001' AS line, count(*) + 1 AS lines, 1::BIGINT AS rejected_lines,
       count(*) FILTER (l_shipdate IS NULL) AS undated
FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS n, l_shipdate
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""
ORACLE["span_extrema_dyadic"] = ORACLE["span_extrema"]
ORACLE["long_span_extrema"] = _with(PX, QUOTES) + """
SELECT e.event_id, CAST(max(q.high_price) AS DOUBLE) AS max_p, CAST(min(q.low_price) AS DOUBLE) AS min_p,
       arg_max(q.datetime_end, {'p': q.high_price, 'o': -epoch_us(q.datetime_end)}) AS max_time,
       arg_min(q.datetime_end, {'p': q.low_price, 'o': epoch_us(q.datetime_end)}) AS min_time
FROM events e JOIN quotes q ON q.ticker = 'T' || e.user_id AND q.datetime_end >= e.ts - INTERVAL 731 DAY
     AND q.datetime_end <= e.ts + to_days(CAST(e.event_id % 31 AS INTEGER))
GROUP BY e.event_id"""
ORACLE["forecast_code_violations"] = _with(*CHAIN[:11]) + f"""
SELECT * FROM (
  SELECT {KEYS}, CASE WHEN CAST(external_id AS BIGINT) % 23 = 1 THEN 3 ELSE CAST(forecast_direction AS INTEGER) END AS forecast_direction,
         CASE WHEN CAST(external_id AS BIGINT) % 29 = 2 THEN -1 ELSE CAST(forecast_result AS INTEGER) END AS forecast_result
  FROM closed) WHERE forecast_direction NOT IN (1, 2) OR forecast_result NOT BETWEEN 0 AND 3"""
ORACLE["first_closed_forecasts"] = _with(*CHAIN[:11]) + """
SELECT ticker, start_date, analyst_company_id, external_id, CAST(forecast_result AS INTEGER) AS forecast_result
FROM closed QUALIFY row_number() OVER (PARTITION BY ticker, start_date ORDER BY CAST(external_id AS BIGINT)) = 1"""
ORACLE["forecast_indicator_ids"] = _with(POSTS, blocks_cte(), parsed_cte()) + f"""
SELECT {KEYS}, indicator_name, CASE WHEN indicator_name <> 'RSI4' AND indicator_name IN (
           SELECT indicator_name FROM parsed WHERE date_inserted < {REPLAY_FROM})
       THEN CAST('0x' || substr(md5(indicator_name), 1, 15) AS BIGINT) END AS indicator_id
FROM parsed"""
