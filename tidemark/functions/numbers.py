"""Price and percentage expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import DELTA, PRICE


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def units_nano(price: Column | str) -> Column:
    """SCL-10: ``{units, nano}`` to an exact decimal (``units + nano / 1e9``).

    Done in decimals: ``nano`` is scaled by 1e-9 as ``decimal(18,0)`` so a
    9-digit value cannot overflow, then the sum is cast to the price type.
    """
    p = _c(price)
    units = p.getField("units").try_cast("decimal(20,0)")
    nano = p.getField("nano").cast("decimal(18,0)") * F.lit(0.000000001).cast("decimal(10,9)")
    return (units + nano).try_cast(PRICE)


def target_price(price_start: Column | str, delta_pct: Column | str) -> Column:
    """SCL-15: ``price_start * (1 + delta / 100)`` in the price type."""
    return (_c(price_start) * (F.lit(1) + _c(delta_pct) / F.lit(100))).try_cast(PRICE)


def pct_delta(x: Column | str, p0: Column | str) -> Column:
    """SCL-16: ``100 * (x - p0) / p0`` rounded half-even to 3 places.

    Decimal arithmetic throughout; a zero ``p0`` or an out-of-range result
    gives NULL instead of failing the job (Q25, DQ-4).
    """
    x, p0 = _c(x), _c(p0)
    return F.bround(F.try_divide(F.lit(100) * (x - p0), p0), 3).try_cast(DELTA)


def to_double(c: Column | str) -> Column:
    """SCL-23: numeric to double, the type the scoring arithmetic runs in."""
    return _c(c).cast("double")
