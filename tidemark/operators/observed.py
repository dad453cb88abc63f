"""Counts taken while the data passes (FLT-15, Q24, Q28): no second scan.

``observe`` attaches counts to a DataFrame; the first action on what is built
from it fills them. Streams use it per micro-batch and store the counts with
the batch, so that a replay replaces its own.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.tables import ChangeTable

COUNTS = "stage string, metric string, rows long"


def observe(df: DataFrame, stage: str, counts: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` unchanged, and how many of its rows meet each condition (NULL does not)."""
    seen = Observation(stage)
    return df.observe(seen, *[F.count_if(c).alias(name) for name, c in counts.items()]), seen


def counts_frame(spark: SparkSession, seen: Mapping[str, Observation]) -> DataFrame:
    """(stage, metric, rows) of finished observations: one row per named count, however large the data."""
    rows = [(stage, metric, int(n or 0)) for stage, o in seen.items() for metric, n in o.get.items()]
    return spark.createDataFrame(rows, COUNTS)


def store_counts(table: ChangeTable, seen: Mapping[str, Observation], stream_id: str, batch_id: int, now: _dt.datetime) -> None:
    """Keep a micro-batch's counts under its own partition."""
    table.append(counts_frame(table.spark, seen), stream_id, batch_id, now, check_unique=False)


def total_counts(table: ChangeTable) -> DataFrame:
    """(stage, metric, rows) over all micro-batches of all streams."""
    return table.changes().groupBy("stage", "metric").agg(F.sum("rows").alias("rows"))
