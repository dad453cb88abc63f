"""Keyed tables as partitioned change sets: the storage side of the upsert (DOM-8).

Every micro-batch is appended as its own partition ``stream_id`` /
``batch_id``. Writing that partition again replaces exactly it (dynamic
partition overwrite), so a replay changes nothing, while a new stream or a
new checkpoint, whose batch numbers start at 0 again, has a partition of its
own and loses nothing. The current table is the best change of each key.
A write touches the batch only, never the stored rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from tidemark.functions.dates import lit_ts
from tidemark.operators.upsert import assert_unique

PARTITION = ["stream_id", "batch_id"]


class ChangeTable:
    """``order`` ranks the changes of a key, the largest is current (default: the latest write)."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str], order: Sequence[str] = ()):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.order = list(keys), list(order)
        self.stored = StructType(list(schema.fields)).add("stream_id", StringType()).add("batch_id", LongType())
        # an empty partitioned write makes the folder, so that reading needs no check
        empty = spark.createDataFrame([], self.stored)
        empty.write.mode("append").partitionBy(*PARTITION).parquet(self.root)

    def append(self, batch: DataFrame, stream_id: str, batch_id: int, now: _dt.datetime, check_unique: bool = True) -> None:
        """Store the changes of one micro-batch; columns it lacks are NULL.

        ``created_at`` and ``updated_at`` are ``now``; the batch must be
        unique on the keys.
        """
        if check_unique:
            assert_unique(batch, self.keys)

        def value(field) -> Column:
            if field.name in ("created_at", "updated_at"):
                return lit_ts(now).alias(field.name)
            have = F.col(field.name) if field.name in batch.columns else F.lit(None)
            return have.cast(field.dataType).alias(field.name)

        rows = batch.select(*[value(f) for f in self.schema.fields],
                            F.lit(stream_id).alias("stream_id"), F.lit(batch_id).cast("long").alias("batch_id"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION).parquet(self.root)

    def changes(self) -> DataFrame:
        """All stored changes with their stream and batch."""
        return self.spark.read.schema(self.stored).parquet(self.root)

    def read(self) -> DataFrame:
        """The current table: one row per key, ``created_at`` from its first change."""
        latest = [c for c in ("updated_at",) if c in self.schema.names] + ["batch_id", "stream_id"]
        cols = [f.name for f in self.schema.fields if f.name not in self.keys]
        best = self.changes().groupBy(*self.keys).agg(
            F.max_by(F.struct(*cols), F.struct(*self.order, *latest)).alias("r"),
            *([F.min("created_at").alias("_created")] if "created_at" in cols else []))
        take = lambda c: F.col("_created" if c == "created_at" else f"r.{c}").alias(c)
        return best.select(*[F.col(c) if c in self.keys else take(c) for c in self.schema.names])


def compact(table: ChangeTable, root: str) -> ChangeTable:
    """The current rows of ``table`` as the only batch of a new table at ``root``."""
    out = ChangeTable(table.spark, root, table.schema, table.keys, table.order)
    rows = table.read().select("*", F.lit("compacted").alias("stream_id"), F.lit(0).cast("long").alias("batch_id"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION).parquet(out.root)
    return out
