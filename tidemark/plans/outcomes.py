"""Scoring of closed forecasts under three exit rules (DOM-1, DOM-2; the
rise and fall scoring functions UDF-1 and UDF-2 of the original).

Native ``CASE WHEN`` chains instead of a Python UDF: the arithmetic keeps
the order of the original formulas (``(c * d) / days``) so doubles agree
bit for bit, and the result is a typed struct rather than a packed string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.dates import day_count
from tidemark.functions.numbers import to_double

# The three exit rules (share of the forecast move that
# closes the position) and the stop-loss share of the first rule.
EXITS = (("50", 0.5), ("90", 0.9), ("100", 1))
STOP_SHARE = 0.5
INPUTS = ["start_date", "end_date", "price_start", "price_delta_forecast", "price_end",
          "price_max_real", "price_max_date", "price_min_real", "price_min_date"]


def _inputs():
    d = to_double("price_delta_forecast")
    ps, pe = to_double("price_start"), to_double("price_end")
    mx, mn = to_double("price_max_real"), to_double("price_min_real")
    mxd, mnd = F.col("price_max_date"), F.col("price_min_date")
    sd, ed = F.col("start_date"), F.col("end_date")
    end_pct = F.try_divide(F.lit(100) * (pe - ps), ps) / day_count(ed, sd)  # Q25: zero ps -> NULL
    return d, ps, pe, mx, mn, mxd, mnd, sd, ed, end_pct


def _r(code: Column, y: Column) -> Column:
    return F.struct(code.cast("int").alias("c"), y.cast("double").alias("y"))


def _target(ps: Column, d: Column, c) -> Column:
    return ps * (F.lit(1) + F.lit(c) * d / F.lit(100))


def rise_outcome() -> Column:
    """DOM-1 as a struct<res50, proc50, res90, proc90, res100, proc100>."""
    d, ps, pe, mx, mn, mxd, mnd, sd, ed, end_pct = _inputs()
    stop = ps * (F.lit(1) - F.lit(STOP_SHARE) * d / F.lit(100))
    tgt = _target(ps, d, STOP_SHARE)
    res50 = (F.when((stop >= mn) & ((mnd <= mxd) | (mx < tgt)), _r(F.lit(-1), F.lit(-STOP_SHARE) * d / day_count(mnd, sd)))
             .when((stop < mn) & (mx < tgt) & (pe <= ps), _r(F.lit(-2), end_pct))
             .when((mx > tgt) & ((mxd <= mnd) | (stop < mn)), _r(F.lit(1), F.lit(STOP_SHARE) * d / day_count(mxd, sd)))
             .when((mx < tgt) & (stop < mn) & (pe >= ps), _r(F.lit(2), end_pct))
             .otherwise(_r(F.lit(0), F.lit(0.0))))
    parts = [res50]
    for _, c in EXITS[1:]:
        hit = mx > _target(ps, d, c)
        parts.append(F.when(hit, _r(F.lit(1), F.lit(c) * d / day_count(mxd, sd)))
                     .otherwise(_r(F.when(end_pct < 0, F.lit(-1)).otherwise(F.lit(2)), end_pct)))
    return _pack(parts)


def fall_outcome(negate_loss: bool = False) -> Column:
    """DOM-2. ``negate_loss`` flips the sign of the exit-50 code -2 yield,
    which the original reports as a positive number (Q5)."""
    d, ps, pe, mx, mn, mxd, mnd, sd, ed, end_pct = _inputs()
    stop = ps * (F.lit(1) - F.lit(STOP_SHARE) * d / F.lit(100))
    tgt = _target(ps, d, STOP_SHARE)
    loss_yield = -end_pct if negate_loss else end_pct
    res50 = (F.when((stop <= mx) & ((mxd <= mnd) | (mn > tgt)), _r(F.lit(-1), F.lit(STOP_SHARE) * d / day_count(mxd, sd)))
             .when((stop > mx) & (mn > tgt) & (pe >= ps), _r(F.lit(-2), loss_yield))
             .when((mn < tgt) & ((mnd < mxd) | (stop > mx)), _r(F.lit(1), F.lit(-STOP_SHARE) * d / day_count(mnd, sd)))
             .when((mn > tgt) & (stop > mx) & (pe <= ps),
                   _r(F.lit(2), F.try_divide(F.lit(100) * (ps - pe), ps) / day_count(ed, sd)))
             .otherwise(_r(F.lit(0), F.lit(0.0))))
    parts = [res50]
    for _, c in EXITS[1:]:
        hit = mn < _target(ps, d, c)
        parts.append(F.when(hit, _r(F.lit(1), F.lit(-c) * d / day_count(mnd, sd)))
                     .otherwise(_r(F.when(end_pct > 0, F.lit(-1)).otherwise(F.lit(2)), -end_pct)))
    return _pack(parts)


def _pack(parts) -> Column:
    fields = []
    for (name, _), p in zip(EXITS, parts):
        fields.append(p.getField("c").alias("res" + name))
        fields.append(p.getField("y").alias("proc" + name))
    any_null = F.lit(False)
    for c in INPUTS:
        any_null = any_null | F.col(c).isNull()
    # Q24: a NULL input gives a NULL outcome instead of failing the job.
    return F.when(~any_null, F.struct(*fields)).cast(schemas.OUTCOME)


def score(forecasts: DataFrame, negate_loss: bool = False) -> DataFrame:
    """Add ``outcome`` by direction (FLT-3 without splitting the table) and
    its six fields as columns (PRJ-7)."""
    o = (F.when(F.col("forecast_direction") == 1, rise_outcome())
         .when(F.col("forecast_direction") == 2, fall_outcome(negate_loss)))
    return forecasts.withColumn("outcome", o).select("*", "outcome.*")


def evaluated(forecasts: DataFrame) -> DataFrame:
    """FLT-9 with Q1: only forecasts with a real result code."""
    r = F.col("forecast_result")
    return forecasts.filter(r.isNotNull() & (r != 0))
