"""Held-out folds and bounded training samples, by hashes of the row's id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(id_col: str) -> Column:
    """crc32 of the id as text, mod 5; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def held_out(id_col: str) -> Column:
    """Whether a row is never learned from: fold 0, or no id."""
    return F.coalesce(fold(id_col) == 0, F.lit(True))


def bounded_sample(rows: DataFrame, id_col: str, bound: int) -> DataFrame:
    """About ``bound`` of the rows, drawn by a hash of the id; all if there are fewer."""
    n = rows.select(id_col).count()
    if n <= bound:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), id_col), F.lit(1 << 24)) < int((1 << 24) * bound / n))
