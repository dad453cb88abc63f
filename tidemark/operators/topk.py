"""Top-k per group (WIN-1, SRT-1) and ordered group concatenation (AGG-6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                 rank_col: str = "rank") -> DataFrame:
    """Rows whose ``rank()`` within ``group`` is at most ``k`` (ties may give more).

    Spark plans a ``WindowGroupLimit`` below the window, so each task keeps
    only the leading rows per group before the sort of the window stage.
    Callers feed pre-aggregated rows (one per group and item), so a group
    is bounded by its number of distinct items, not by the raw data size.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.select("*", F.rank().over(w).alias(rank_col)).filter(F.col(rank_col) <= k)


def ordered_concat(values: str, order: Sequence[Column], sep: str = ", ") -> Column:
    """AGG-6 with an explicit order: ``concat_ws(sep, values sorted by order)``.

    ``order`` columns are sorted ascending; negate numeric ones for
    descending. Used only on small, already-aggregated groups.
    """
    keyed = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col(values).alias("v"))
    return F.concat_ws(sep, F.transform(F.array_sort(F.collect_list(keyed)), lambda x: x.getField("v")))
