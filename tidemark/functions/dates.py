"""Date and time expressions. Timestamps are zone-less (``timestamp_ntz``)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Candle interval names and their lengths.
CANDLE_INTERVALS = {
    "CANDLE_INTERVAL_HOUR": "1 HOUR",
    "CANDLE_INTERVAL_10_MIN": "10 MINUTES",
}
# Weblog access time format, after the leading "[" is removed.
WEBLOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"
# Posts carry ISO times; everything from the first "." on is dropped.
ISO_SECONDS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
# Last candle that still counts for a span ends at noon of its end date.
SPAN_END_TIME = "12 HOURS"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_date(d: _dt.date | str | None) -> Column:
    """A date literal; ``None`` means today (SCL-25: the clock is read only
    at the edge, by Spark, once per query)."""
    if d is None:
        return F.current_date()
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def lit_ts(t: _dt.datetime | str | None) -> Column:
    """A zone-less timestamp literal; ``None`` means now (SCL-25)."""
    if t is None:
        return F.localtimestamp()
    if isinstance(t, str):
        t = _dt.datetime.fromisoformat(t)
    return F.lit(t).cast("timestamp_ntz")


def day_count(later: Column | str, start_date: Column | str) -> Column:
    """SCL-17: whole days from ``start_date`` to the date of ``later``; 0 becomes 1."""
    d = F.datediff(F.to_date(_c(later)), _c(start_date))
    return F.when(d == 0, F.lit(1)).otherwise(d)


def iso_seconds(s: Column | str) -> Column:
    """SCL-13: ISO text cut at the first ``.``, parsed to a zone-less timestamp."""
    head = F.split(_c(s), r"[.]").getItem(0)
    return F.try_to_timestamp(head, F.lit(ISO_SECONDS_FORMAT)).cast("timestamp_ntz")


def weblog_time(s: Column | str) -> Column:
    """SCL-7: ``dd/MMM/yyyy:HH:mm:ss`` to timestamp; junk gives NULL."""
    return F.try_to_timestamp(_c(s), F.lit(WEBLOG_TIME_FORMAT)).cast("timestamp_ntz")


def span_end_ts(end_date: Column | str) -> Column:
    """Inclusive upper bound of a forecast span: ``end_date`` 12:00."""
    return F.to_timestamp_ntz(_c(end_date)) + F.expr(f"INTERVAL {SPAN_END_TIME}")


def clamp_span_end(end_date: Column | str, as_of: _dt.date | None, now: _dt.datetime | None) -> Column:
    """SCL-28: ``now`` when the span is open (NULL end or end >= as_of), else end 12:00."""
    e = _c(end_date)
    return F.when(e.isNull() | (e >= lit_date(as_of)), lit_ts(now)).otherwise(span_end_ts(e))


def candle_end(start: Column | str, interval: Column | str) -> Column:
    """SCL-9: candle end from its start and interval name; unknown name gives NULL."""
    start, interval = _c(start), _c(interval)
    expr = None
    for name, length in CANDLE_INTERVALS.items():
        branch = start + F.expr(f"INTERVAL {length}")
        expr = F.when(interval == name, branch) if expr is None else expr.when(interval == name, branch)
    return expr
