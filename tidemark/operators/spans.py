"""Range joins: aggregate the time-stamped rows of a key inside each span.

Used for forecast life spans over candles (JON-4 extrema, JON-6 first and
last candle). Three physical strategies give identical rows:

``binned``
    spans are exploded to the calendar days they touch and joined on
    (key, day); each span meets only the rows of its own days.
``rollup`` (default)
    rows are first reduced to one row per (key, day) holding mergeable
    partial results; days lying wholly inside a span take that roll-up row,
    only the edge days of a span meet raw rows. Both kinds of right-hand rows go through
    one join on (key, day, tier). A hot key-day costs one roll-up row per
    span-day.
``dyadic``
    for long spans and for days that hold very many rows. Rows are reduced
    to cells of several sizes: parts of a day (``DAY_PARTS``), days, and
    blocks of 2, 4, 8, ... days. A span takes the fewest cells that fill
    it, about 2 log2(days) blocks and some parts of its edge days, and meets raw
    rows only in the smallest cells that its ends cut. Cells and raw rows go
    through one join on (key, tier, cell), so that the rows of one key and
    day are spread over its parts.

Measures are mergeable (max, min, and max_by/min_by over another measure),
so partial results combine exactly and the strategies agree row for row.
Every measure keeps a primitive or decimal aggregation buffer, which lets
Spark use hash aggregation with map-side combining throughout.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampNTZType

from tidemark.functions.arrays import explode_rows

STRATEGIES = ("binned", "rollup", "dyadic")
# Cells of a day, coarse to fine, each number a multiple of the one before;
# a span has at most twice as many cells of a size as fit in the next larger one.
DAY_PARTS = (4, 32)
# Sizes of day blocks: 1, 2, 4, ... days; spans beyond the largest take several of it.
BLOCK_SIZES = 14
DAY_MICROS = 86_400_000_000
# Tier of raw rows; day blocks of 2^k days have tier k, day parts FIRST_PART + their place in DAY_PARTS.
RAW, FIRST_PART = -1, 100
# Order keys pack (major, minor) into one decimal(38,0): minor lies in
# [0, MINOR_SPAN) after adding MINOR_OFFSET, so comparing the packed value
# compares major first and minor second.
MINOR_SPAN = 10 ** 20
MINOR_OFFSET = 5 * 10 ** 19


class Measure(NamedTuple):
    expr: Column
    agg: str            # "max" | "min" | "max_by" | "min_by"
    by: str | None = None   # for *_by: name of the measure that orders


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 00:00 of a zone-less timestamp.

    Computed as a plain difference of zone-less values, so the order and the
    numbers do not depend on the session time zone (no DST folds).
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    epoch = F.lit(_dt.datetime(1970, 1, 1)).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, c.cast("timestamp_ntz"))


def order_key(major: Column, minor: Column) -> Column:
    """A decimal(38,0) ordered like ``struct(major, minor)``.

    ``major`` must be integral with |major| < 1e17, ``minor`` a long. Unlike
    a struct, a decimal is a mutable aggregation buffer type, so
    ``max``/``max_by`` over it stay hash aggregates.
    """
    d = "decimal(38,0)"
    return (major.cast(d) * F.lit(Decimal(MINOR_SPAN)).cast(d)
            + (minor.cast(d) + F.lit(Decimal(MINOR_OFFSET)).cast(d))).cast(d)


def unpacked(k: Column) -> tuple[Column, Column]:
    """(major, minor) of an ``order_key``: a decimal and a long."""
    span = F.lit(Decimal(MINOR_SPAN)).cast("decimal(38,0)")
    minor = F.pmod(k, span)
    major = F.call_function("div", k - minor, span).cast("decimal(18,0)")
    return major, (minor - F.lit(Decimal(MINOR_OFFSET)).cast("decimal(38,0)")).cast("long")


def from_micros(us: Column) -> Column:
    """The zone-less timestamp that ``micros`` makes ``us`` of."""
    epoch = F.lit(_dt.datetime(1970, 1, 1)).cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=(us.cast("decimal(24,0)") * F.lit(Decimal("0.000001"))).cast("decimal(18,6)"))


def _merge(name: str, m: Measure) -> Column:
    c = F.col(name)
    if m.agg == "max":
        return F.max(c).alias(name)
    if m.agg == "min":
        return F.min(c).alias(name)
    if m.agg == "max_by":
        return F.max_by(c, F.col(m.by)).alias(name)
    if m.agg == "min_by":
        return F.min_by(c, F.col(m.by)).alias(name)
    raise ValueError(m.agg)


def _span_days(lo: Column, hi: Column) -> Column:
    lo_d, hi_d = F.to_date(lo), F.to_date(hi)
    return F.when(hi_d >= lo_d, F.sequence(lo_d, hi_d)).otherwise(F.array().cast("array<date>"))


def _floor_div(x: Column, n: int) -> Column:
    return ((x - F.pmod(x, F.lit(n))) / F.lit(n)).cast("long") if n & (n - 1) else F.shiftright(x, n.bit_length() - 1)


def _ceil_div(x: Column, n: int) -> Column:
    return -_floor_div(-x, n)


def span_cells(lo: Column, hi: Column) -> Column:
    """The cells (tier, cell) that a span ``lo <= time <= hi`` is made of; none if ``hi < lo``."""
    a, b = micros(lo), micros(hi) + 1
    cell = lambda tier, c: F.struct(F.lit(tier).alias("_tier"), c.cast("long").alias("_cell"))
    none = F.array().cast("array<struct<_tier: int, _cell: bigint>>")

    def run(tier, start, stop):
        return F.when(start < stop, F.transform(F.sequence(start, F.greatest(stop - 1, start)), lambda c: cell(tier, c))).otherwise(none)

    first, last = _ceil_div(a, DAY_MICROS), _floor_div(b, DAY_MICROS)
    parts = []
    for k in range(BLOCK_SIZES - 1):
        # blocks of this size that no larger one of the span holds: an odd first one, and an odd last one
        low, high = _ceil_div(first, 1 << k), _floor_div(last, 1 << k)
        parts += [F.when((low < high) & (F.pmod(low, F.lit(2)) == 1), cell(k, low)),
                  F.when((low < high) & (F.pmod(high, F.lit(2)) == 1), cell(k, high - 1))]
    top = BLOCK_SIZES - 1
    lists = [F.array_compact(F.array(*parts)), run(top, _ceil_div(first, 1 << top), _floor_div(last, 1 << top))]
    per_day = 1
    for j, n in enumerate(DAY_PARTS):
        low, high = _ceil_div(a, DAY_MICROS // n), _floor_div(b, DAY_MICROS // n)
        ratio, inner = n // per_day, first < last
        lists += [run(FIRST_PART + j, low, F.when(inner, first * ratio).otherwise(high)),
                  F.when(inner, run(FIRST_PART + j, last * ratio, high)).otherwise(none)]
        first, last, per_day = low, high, n
    unit = DAY_MICROS // per_day
    cut = F.array_compact(F.array(F.when(first * unit > a, cell(RAW, first - 1)), F.when(last * unit < b, cell(RAW, last))))
    return F.when(a < b, F.concat(*lists, F.array_distinct(cut))).otherwise(none)


def row_cells(ev: DataFrame, key: str, merged: list[Column], names: list[str]) -> DataFrame:
    """(key, _tier, _cell, _t, measures): raw rows (key, _t, measures) by their smallest
    cell, and the merged cells of all sizes.

    Rows are first merged to the smallest cells, which spreads a hot day. Of
    these a key has at most ``DAY_PARTS[-1]`` a day, so all larger ones are
    merged where the key's cells lie, without another exchange.
    """
    cols = [key, "_tier", "_cell", "_t", *names]
    fine = ev.withColumn("_cell", _floor_div(micros("_t"), DAY_MICROS // DAY_PARTS[-1]))
    raw = fine.withColumn("_tier", F.lit(RAW)).select(*cols)
    small = F.col("_cell")
    cell = lambda tier, c: F.struct(F.lit(tier).alias("_tier"), c.cast("long").alias("_cell"))
    sizes = [cell(FIRST_PART + j, _floor_div(small, DAY_PARTS[-1] // n)) for j, n in enumerate(DAY_PARTS)]
    sizes += [cell(k, F.shiftright(_floor_div(small, DAY_PARTS[-1]), k)) for k in range(BLOCK_SIZES)]
    # the exchange by key alone serves the groups of all sizes
    by_key = fine.groupBy(key, "_cell").agg(*merged).repartition(key)
    parts = by_key.select(key, F.explode(F.array(*sizes)).alias("_c"), *names)
    cells = parts.groupBy(key, F.col("_c._tier").alias("_tier"), F.col("_c._cell").alias("_cell")).agg(*merged)
    return raw.unionByName(cells.withColumn("_t", F.lit(None).cast(ev.schema["_t"].dataType)).select(*cols))


def within_rows(sp: DataFrame, ev: DataFrame, key: str) -> DataFrame:
    """Spans (key, _lo, _hi) cut to the days from their key's first to its last row (key, _t).

    A span keeps all its rows. What it loses are cells without rows: a span of
    years over a month of rows takes the cells of a month. Spans of keys without rows are absent.
    """
    ends = ev.groupBy(key).agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    last = F.to_timestamp_ntz(F.date_add(F.to_date("_last"), 1)) - F.expr("INTERVAL 1 MICROSECOND")
    return sp.hint("merge").join(ends, key).select(
        *[c for c in sp.columns if c not in ("_lo", "_hi")],
        F.greatest("_lo", F.to_timestamp_ntz(F.to_date("_first"))).alias("_lo"), F.least("_hi", last).alias("_hi"))


def span_aggregate(
    spans: DataFrame,
    rows: DataFrame,
    *,
    key: str,
    span_id: str,
    lo: Column,
    hi: Column,
    time_col: str,
    measures: Mapping[str, Measure],
    strategy: str = "rollup",
) -> DataFrame:
    """Per span, merge ``measures`` over the rows with ``lo <= time <= hi``.

    Returns ``span_id`` plus one column per measure; spans without rows are
    absent (inner semantics).
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    names = list(measures)
    merged = [_merge(n, m) for n, m in measures.items()]
    sp = spans.select(F.col(span_id).alias("_id"), F.col(key), lo.alias("_lo"), hi.alias("_hi"))
    ev = rows.select(F.col(key), F.col(time_col).alias("_t"), *[m.expr.alias(n) for n, m in measures.items()])
    in_span = F.col("_t").between(F.col("_lo"), F.col("_hi"))

    if strategy == "dyadic":
        ev = ev.filter(F.col(key).isNotNull() & F.col("_t").isNotNull())
        sp = within_rows(sp.filter(F.col("_lo").isNotNull() & F.col("_hi").isNotNull()), ev, key)
        raw = F.col("_c._tier") == RAW
        pieces = explode_rows(sp, span_cells(F.col("_lo"), F.col("_hi")), "_c").select(
            "_id", key, F.when(raw, F.col("_lo")).alias("_lo"), F.when(raw, F.col("_hi")).alias("_hi"), "_c._tier", "_c._cell")
        # Spark takes exploded spans to be as small as the spans: without the hint it broadcasts them
        parts = (pieces.hint("merge").join(row_cells(ev, key, merged, names), [key, "_tier", "_cell"])
                 .filter((F.col("_tier") != RAW) | in_span).select("_id", *names))
        return parts.groupBy("_id").agg(*merged).withColumnRenamed("_id", span_id)

    # Spark takes exploded spans to be as small as the spans: without the hint it broadcasts them
    days = explode_rows(sp, _span_days(F.col("_lo"), F.col("_hi")), "_day")
    ev_d = ev.withColumn("_day", F.to_date("_t"))
    if strategy == "binned":
        parts = days.hint("merge").join(ev_d, [key, "_day"]).filter(in_span).select("_id", *names)
    else:
        lo_day = F.to_date("_lo")
        whole = (((F.col("_day") > lo_day)
                  | ((F.col("_day") == lo_day) & (F.col("_lo") == F.to_timestamp_ntz(lo_day))))
                 & (F.col("_day") < F.to_date("_hi")))
        days = days.withColumn("_tier", whole.cast("int"))
        roll = ev_d.groupBy(key, "_day").agg(*merged).select(
            key, "_day", F.lit(1).alias("_tier"), F.lit(None).cast(ev.schema["_t"].dataType).alias("_t"), *names)
        # raw rows move once, into the join: to leave out those of days inside spans would move them twice
        raw = ev_d.select(key, "_day", F.lit(0).alias("_tier"), "_t", *names)
        right = roll.unionByName(raw)
        edge = F.col("_tier") == 0
        days = days.select("_id", key, "_day", "_tier", *[F.when(edge, F.col(c)).alias(c) for c in ("_lo", "_hi")])
        parts = (days.hint("merge").join(right, [key, "_day", "_tier"])
                 .filter((F.col("_tier") == 1) | in_span).select("_id", *names))

    return parts.groupBy("_id").agg(*merged).withColumnRenamed("_id", span_id)


def extrema_measures(high: str = "high_price", low: str = "low_price", time_col: str = "datetime_end",
                     price_scale: int = 6) -> dict[str, Measure]:
    """AGG-8: highest high and lowest low with the time of each.

    Ties go to the earliest row; NULL prices never win (Q7). Outputs
    ``max_p, max_t, min_p, min_t`` (``*_k`` are the packed order keys).
    """
    t = F.col(time_col)
    scale = F.lit(10 ** price_scale)
    hi_units = (F.col(high) * scale).cast("decimal(38,0)")
    lo_units = (F.col(low) * scale).cast("decimal(38,0)")
    return {
        "max_p": Measure(F.col(high), "max"),
        "max_k": Measure(order_key(hi_units, -micros(t)), "max"),
        "max_t": Measure(t, "max_by", "max_k"),
        "min_p": Measure(F.col(low), "min"),
        "min_k": Measure(order_key(lo_units, micros(t)), "min"),
        "min_t": Measure(t, "min_by", "min_k"),
    }


def span_extrema(spans: DataFrame, rows: DataFrame, *, key: str, span_id: str, lo: Column, hi: Column, strategy: str = "rollup",
                 high: str = "high_price", low: str = "low_price", time_col: str = "datetime_end", price_scale: int = 6) -> DataFrame:
    """(span_id, max_p, max_t, min_p, min_t) of ``extrema_measures`` per span.

    The packed order keys hold price and time, so only the two keys are moved
    and merged, and the four values are read from them at the end. Prices of a type that
    the keys do not hold exactly are merged as they are.
    """
    measures = extrema_measures(high, low, time_col, price_scale)
    types = [rows.schema[c].dataType for c in (high, low)]
    exact = (all(isinstance(t, DecimalType) and t.scale <= price_scale and t.precision - t.scale + price_scale <= 17 for t in types)
             and isinstance(rows.schema[time_col].dataType, TimestampNTZType))
    if exact:
        measures = {k: measures[k] for k in ("max_k", "min_k")}
    out = span_aggregate(spans, rows, key=key, span_id=span_id, lo=lo, hi=hi, time_col=time_col, measures=measures, strategy=strategy)
    if not exact:
        return out.select(span_id, "max_p", "max_t", "min_p", "min_t")
    found = [(unpacked(F.col(k))) for k in ("max_k", "min_k")]
    price = lambda x, t: (x[0] * F.lit(Decimal(1).scaleb(-price_scale))).cast(t)
    return out.select(span_id, price(found[0], types[0]).alias("max_p"), from_micros(-found[0][1]).alias("max_t"),
                      price(found[1], types[1]).alias("min_p"), from_micros(found[1][1]).alias("min_t"))


def first_last_measures(value: str = "open_price", time_col: str = "datetime_start") -> dict[str, Measure]:
    """SRT-4 / JON-6: value of the earliest and of the latest row
    (``first_v``, ``last_v``); times are unique per key in a keyed table."""
    t, v = F.col(time_col), F.col(value)
    return {
        "first_t": Measure(t, "min"),
        "first_v": Measure(v, "min_by", "first_t"),
        "last_t": Measure(t, "max"),
        "last_v": Measure(v, "max_by", "last_t"),
    }
