"""Array helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, arr: Column, alias: str, *keep) -> DataFrame:
    """One row per non-NULL element of ``arr`` (NULL and empty arrays give none).

    Same rows as ``explode`` followed by dropping NULL elements, but written
    with ``explode_outer``: for a plain ``explode`` the optimizer infers a
    ``size(arr) > 0`` filter below the generator, which evaluates a computed
    array (a JSON decode, a parse fold) a second time per row.
    """
    cols = list(keep) if keep else [c for c in df.columns]
    return df.select(*cols, F.explode_outer(arr).alias(alias)).filter(F.col(alias).isNotNull())
