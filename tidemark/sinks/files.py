"""File sinks (SNK-1, SNK-2, SNK-8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DISPLAY_ROWS = 200


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """SNK-1: parquet write (whole result; one action)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def display(df: DataFrame, order_by: Sequence[str] = ("line",), n: int = DISPLAY_ROWS) -> DataFrame:
    """SNK-2: the first ``n`` rows in order, for a console ``show``.

    Display only: the limit is the feature here (a bounded screen), and the
    computed tables stay whole.
    """
    return df.orderBy(*order_by).limit(n)


def write_index_documents(docs: DataFrame, path: str, time_col: str = "event_time", mode: str = "append") -> None:
    """SNK-8 (batch form): search documents as JSON, partitioned by event date."""
    (docs.withColumn("event_date", F.to_date(time_col))
     .write.mode(mode).partitionBy("event_date").json(path))
