"""Rows x reporting periods (JON-8) as an equi-join on days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def period_days(periods: DataFrame, first: str, last: str) -> DataFrame:
    """``periods`` with one row per ``day`` of each, within [``first``, ``last``] of its row.

    ``periods`` has ``period_id, period, lo, hi, lo_inclusive``; a NULL bound
    is open.
    """
    start = F.when(F.col("lo_inclusive"), F.col("lo")).otherwise(F.date_add("lo", 1))
    lo = F.greatest(F.col(first), F.coalesce(start, F.col(first)))
    hi = F.least(F.col(last), F.coalesce("hi", F.col(last)))
    some = periods.withColumn("_lo", lo).withColumn("_hi", hi).filter(F.col("_lo") <= F.col("_hi"))
    return some.select("period_id", "period", F.explode(F.sequence("_lo", "_hi")).alias("day"))


def assign_periods(df: DataFrame, periods: DataFrame, date_col: str) -> DataFrame:
    """Every row once per period containing ``date_col`` (periods may overlap).

    The periods are spelled out as days between the first and the last date
    of ``df`` and joined on the day, so any number of periods is a hash or
    sort join. Callers aggregate facts per day first: the join then sees one
    row per day and group, not the facts.
    """
    span = df.agg(F.min(date_col).alias("_first"), F.max(date_col).alias("_last"))  # one row
    days = period_days(periods.join(F.broadcast(span), F.lit(True)), "_first", "_last")
    return df.join(days, df[date_col] == days["day"], "inner").drop("day")
