"""High-water marks and run records (AGG-7, AGG-14, SRT-3, SNK-7)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import lit_ts

EPOCH = _dt.datetime(1970, 1, 1)


def latest_per_key(df: DataFrame, key: str, time_col: str, alias: str) -> DataFrame:
    """AGG-7: ``max(time_col)`` per key (partial aggregation, skew-safe)."""
    return df.groupBy(key).agg(F.max(time_col).alias(alias))


def run_record(items: DataFrame, run_id: int, start_time: _dt.datetime, end_time: _dt.datetime) -> DataFrame:
    """AGG-14 / SNK-7: one run record per company: newest post time and its id.

    ``items`` are the parsed posts of this run (``analyst_company_id,
    external_id, date_inserted``).
    """
    return items.groupBy("analyst_company_id").agg(
        F.max("date_inserted").alias("forecast_datetime"),
        F.max_by("external_id", F.struct("date_inserted", "external_id")).alias("external_id"),
    ).select(F.lit(run_id).cast("long").alias("run_id"), "analyst_company_id",
             lit_ts(start_time).alias("start_time"), lit_ts(end_time).alias("end_time"),
             "forecast_datetime", "external_id")


def open_run(spark: SparkSession, run_id: int, start_time: _dt.datetime) -> DataFrame:
    """SNK-7, first step: a run that has begun. ``run_record`` of the finished
    run replaces it, so a run that died in between keeps its NULL end time."""
    return spark.range(1).select(
        F.lit(run_id).cast("long").alias("run_id"), F.lit(None).cast("int").alias("analyst_company_id"),
        lit_ts(start_time).alias("start_time"), F.lit(None).cast("timestamp_ntz").alias("end_time"),
        F.lit(None).cast("timestamp_ntz").alias("forecast_datetime"), F.lit(None).cast("string").alias("external_id"))


def open_runs(parser_log: DataFrame) -> DataFrame:
    """Runs that were begun and not finished: what has to be done again."""
    return parser_log.filter(F.col("end_time").isNull())


def last_run(parser_log: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """SRT-3 with Q23: per company the run with the newest forecast time.

    Runs without a forecast time are ignored; with ``companies`` given,
    companies that never ran get the 1970-01-01 default as ``hwm``.
    """
    done = parser_log.filter(F.col("forecast_datetime").isNotNull())
    best = done.groupBy("analyst_company_id").agg(
        F.max_by(F.struct("run_id", "forecast_datetime", "external_id"),
                 F.struct("forecast_datetime", "run_id")).alias("r"))
    out = best.select("analyst_company_id", F.col("r.run_id").alias("run_id"),
                      F.col("r.forecast_datetime").alias("hwm"), F.col("r.external_id").alias("external_id"))
    if companies is not None:
        out = companies.select("analyst_company_id").distinct().join(out, "analyst_company_id", "left") \
            .withColumn("hwm", F.coalesce(F.col("hwm"), lit_ts(EPOCH)))
    return out
