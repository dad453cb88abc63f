"""Keyed upsert (DOM-8, SNK-3..7) without row-level table operations.

``upsert`` is a pure DataFrame function: target rows whose key is not in
the batch, plus batch rows merged with the target's bookkeeping columns.
Streams store their micro-batches as change sets instead
(``tidemark.sinks.tables``); a catalog with row-level operations (MERGE) can
replace both.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import lit_ts


class DuplicateKeyError(ValueError):
    """The batch holds a key twice; a keyed upsert would be ambiguous."""


def assert_unique(batch: DataFrame, keys: Sequence[str]) -> None:
    """Fail when ``batch`` repeats a key (the database would refuse it too).

    One aggregate job; only the count of offending keys reaches the driver.
    """
    n = batch.groupBy(*keys).count().filter("count > 1").count()
    if n:
        raise DuplicateKeyError(f"{n} duplicate key(s) on {list(keys)} in upsert batch")


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], now: _dt.datetime,
           update: Sequence[str] | None = None, keep: Sequence[str] = (),
           only_if_newer: str | None = None, stored_by_key: bool = False) -> DataFrame:
    """Insert new keys, update matched ones.

    * ``update``: columns the batch overwrites on a match (default: all
      batch columns except the keys).
    * ``keep``: columns the batch must never overwrite on a match, e.g.
      evaluation results when re-ingesting parsed rows (Q20); new rows take
      the batch value.
    * ``created_at`` survives a match; ``updated_at`` becomes ``now``; new
      rows get ``now`` for both.

    * ``only_if_newer``: a column (e.g. the post time); a matched row is
      changed only when the batch value is not older than the stored one,
      so a late, older record never overwrites a newer one (Q11).

    * ``stored_by_key``: the target is stored bucketed by ``keys``
      (``materialize_by_key``) and holds each key once. It is then read once, where it lies,
      beside the shuffled batch. Without, the target is read twice
      but never moves as long as the batch's keys are few.

    Target columns missing from the batch stay as they are on a match and
    are NULL for new rows. The batch must be unique on ``keys``, which must not be NULL.
    """
    keys = list(keys)
    cols = target.columns
    batch_cols = set(batch.columns)
    update = [c for c in (update or [c for c in batch.columns if c not in keys]) if c not in keep]
    b = batch.alias("b")
    if stored_by_key:
        mark = F.lit(True)
        both = (target.withColumn("_stored", mark).alias("t").join(batch.withColumn("_given", mark).alias("b"), [F.col("t." + k) == F.col("b." + k) for k in keys], "full"))
        matched, given = F.col("t._stored").isNotNull(), F.col("b._given").isNotNull()
        new = _values(target, keys, cols, batch_cols, update, matched, only_if_newer, now)
        return both.select(*[F.when(given, v).otherwise(F.col("t." + c)).alias(c) for c, v in zip(cols, new)])
    # The batch is small next to the target. Both target passes are joins
    # against the batch keys only (semi and anti), which AQE can broadcast
    # while the target streams through without a shuffle; the batch is then
    # left-joined to just the matched target rows.
    bk = batch.select(*keys)
    hit = target.join(bk, keys, "left_semi").alias("t")
    on = [F.col("t." + k).eqNullSafe(F.col("b." + k)) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    merged = b.join(hit, cond, "left")
    matched = F.col("t." + keys[0]).isNotNull() if keys else F.lit(False)
    out = _values(target, keys, cols, batch_cols, update, matched, only_if_newer, now)
    untouched = target.join(bk, keys, "left_anti")
    return untouched.select(*cols).unionByName(merged.select(*[v.alias(c) for c, v in zip(cols, out)]))


def _values(target: DataFrame, keys, cols, batch_cols, update, matched: Column, only_if_newer: str | None, now: _dt.datetime) -> list[Column]:
    """The columns of a batch row (``b``) beside the stored row of its key (``t``), if there is one."""
    stale = F.lit(False)
    if only_if_newer:
        stale = matched & (F.col("b." + only_if_newer) < F.col("t." + only_if_newer))
    now_c = lit_ts(now)
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col("b." + c))
        elif c == "created_at":
            out.append(F.when(matched, F.col("t.created_at")).otherwise(now_c))
        elif c == "updated_at":
            out.append(F.when(stale, F.col("t.updated_at")).otherwise(now_c))
        elif c in update and c in batch_cols:
            out.append(F.when(stale, F.col("t." + c)).otherwise(F.col("b." + c).cast(target.schema[c].dataType)))
        elif c in batch_cols:
            out.append(F.when(matched, F.col("t." + c)).otherwise(F.col("b." + c)).cast(target.schema[c].dataType))
        else:
            out.append(F.col("t." + c))
    return out
