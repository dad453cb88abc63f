"""Stock dimension from the instrument feed (SRC-7, DUP-4, SNK-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import keep_best


def stock_dimension(instrument_rows: DataFrame) -> DataFrame:
    """DUP-4: one instrument per ticker, the one with the smallest figi."""
    return keep_best(instrument_rows, ["ticker"], [F.col("figi")], largest=False)


STOCK_VALUES = ["figi", "stock_name", "country_id", "currency", "lot", "class_code", "sector"]


def upsert_stocks(stored: DataFrame, instrument_rows: DataFrame, now) -> DataFrame:
    """SNK-4: one set-based upsert of the de-duplicated instrument list on
    ticker (Q22: no per-row writes)."""
    from tidemark.operators.upsert import upsert
    return upsert(stored, stock_dimension(instrument_rows), ["ticker"], now, update=STOCK_VALUES)
