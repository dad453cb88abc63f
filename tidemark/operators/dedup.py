"""De-duplication by key (DUP-1..6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_best(df: DataFrame, keys: Sequence[str], prefer: Sequence[Column], largest: bool = True) -> DataFrame:
    """One row per key: the row whose ``struct(*prefer)`` is largest
    (smallest with ``largest=False``).

    Expressed as ``groupBy(keys).agg(max_by(struct(row), struct(prefer)))``
    rather than ``row_number()`` over a window: the hash aggregate combines
    map-side, so a hot key is reduced to one row per task before the
    shuffle instead of being sorted whole in one task. ``prefer`` must be a
    total order (end it with a unique column) for a deterministic survivor.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if largest else F.min_by
    best = pick(F.struct(*[F.col(c) for c in rest]), F.struct(*prefer)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_best." + c).alias(c) for c in rest])


def first_by_id(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """DUP-2 / SRT-2: the row with the smallest id per key, as a work list in id
    order would take it. Numeric ids given as text count as numbers and come
    first, then other text; NULL ids come last."""
    number = F.col(id_col).try_cast("long")
    return keep_best(df, keys, [F.col(id_col).isNull(), number.isNull(), number, F.col(id_col)], largest=False)


def keep_min_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """DUP-1 made deterministic: one row per ``key`` holding ``min(value)``."""
    return df.groupBy(key).agg(F.min(value).alias(value))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-1: keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
