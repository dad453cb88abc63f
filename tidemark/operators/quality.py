"""Data-quality operators for the declared constraints (DQ-1..5).

Each returns a DataFrame report; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import duplicate_keys


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-1: keys present more than once."""
    return duplicate_keys(df, keys)


def null_violations(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """DQ-2: NULL count per required column, one pass, tidy output."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    stack = ", ".join(f"'{c}', `{c}`" for c in required)
    return counts.selectExpr(f"stack({len(required)}, {stack}) as (column_name, null_count)")


def orphans(df: DataFrame, ref: DataFrame, on: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """DQ-3: rows of ``df`` whose reference is missing in ``ref``.

    ``on`` is a list of shared column names or a mapping df column -> ref
    column. A row with a NULL in its reference refers to nothing and is no
    orphan, as with a foreign key.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    named = ref.select(*[F.col(r).alias(f"_ref{i}") for i, r in enumerate(pairs.values())]).distinct()
    refers, cond = F.lit(True), F.lit(True)
    for i, c in enumerate(pairs):
        refers, cond = refers & F.col(c).isNotNull(), cond & (F.col(c) == F.col(f"_ref{i}"))
    return df.filter(refers).join(named, cond, "left_anti")


def overflow_violations(df: DataFrame, decimals: Mapping[str, str] = None,
                        lengths: Mapping[str, int] = None) -> DataFrame:
    """DQ-4: values that do not fit the declared decimal type or text length."""
    cond = F.lit(False)
    flags = []
    for c, t in (decimals or {}).items():
        bad = F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()
        flags.append(F.when(bad, F.lit(f"{c}:{t}")))
        cond = cond | bad
    for c, n in (lengths or {}).items():
        bad = F.length(F.col(c)) > n
        flags.append(F.when(bad, F.lit(f"{c}:len>{n}")))
        cond = cond | bad
    return df.filter(cond).withColumn("violations", F.array_compact(F.array(*flags)))


def code_violations(df: DataFrame, allowed: Mapping[str, Sequence]) -> DataFrame:
    """DQ-5: non-NULL values outside the allowed code lists."""
    cond = F.lit(False)
    for c, vals in allowed.items():
        cond = cond | (F.col(c).isNotNull() & ~F.col(c).isin(*vals))
    return df.filter(cond)


# The codes of a stored forecast (0: result not computed yet).
FORECAST_CODES = {"forecast_direction": (1, 2), "forecast_result": (0, 1, 2, 3)}


def mixed_candle_lengths(quotes: DataFrame, key: str = "ticker") -> DataFrame:
    """Q18: keys whose stored candles have more than one length
    (``datetime_end - datetime_start``), e.g. hourly and 10-minute candles
    written under the same (ticker, datetime_start) key space."""
    length = F.timestamp_diff("SECOND", F.col("datetime_start"), F.col("datetime_end"))
    per = quotes.groupBy(key, length.alias("candle_seconds")).agg(F.count(F.lit(1)).alias("candles"))
    return per.groupBy(key).agg(
        F.count(F.lit(1)).alias("lengths"),
        F.sum("candles").alias("candles"),
        F.min("candle_seconds").alias("min_seconds"),
        F.max("candle_seconds").alias("max_seconds"),
    ).filter(F.col("lengths") > 1)
