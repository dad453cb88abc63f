"""A filter of fixed size that tells, where rows are, which of them can have a partner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter by hash (16 MB): its size does not grow with the data.
FILTER_BITS = 1 << 27
_WORD = 32768  # bits of one bitmap


def _longs(map_: str) -> Column:
    """A bitmap as whole numbers of 64 bits, the first byte highest: read where they are, while bytes would be copied for every row."""
    long = lambda i: F.conv(F.hex(F.substring(map_, i * 8 + 1, F.lit(8))), 16, -10).cast("bigint")
    return F.transform(F.sequence(F.lit(0), F.lit(_WORD // 64 - 1)), long)


def _bit(map_: str, at: Column) -> Column:
    """Whether bit ``at`` of a bitmap of ``_longs`` is set."""
    at = at.cast("int")
    shift = F.lit(56) - F.call_function("shiftright", at, F.lit(3)).bitwiseAND(F.lit(7)) * 8 + at.bitwiseAND(F.lit(7))
    held_ = F.get(map_, F.call_function("shiftright", at, F.lit(6)))
    return F.call_function("shiftright", held_, shift).bitwiseAND(F.lit(1).cast("bigint")) == 1


def _placed(ids: DataFrame) -> DataFrame:
    """``ids`` (h, ...) with ``_word`` and the bits ``_a`` and ``_b`` of each in the word's two bitmaps."""
    h = F.col("h")
    second = F.shiftrightunsigned(h, 40).bitwiseAND(F.lit(_WORD - 1).cast("bigint"))
    word = F.floor(F.pmod(h, F.lit(FILTER_BITS // 2)) / _WORD)
    return ids.select("*", word.alias("_word"), F.pmod(h, F.lit(_WORD)).cast("bigint").alias("_a"), second.alias("_b"))


def bitmaps(ids: DataFrame, twice: bool = False) -> DataFrame:
    """``ids`` (h) -> (word, a, b): two bitmaps of FILTER_BITS hashed bits in all, whatever the number of ids.

    With ``twice`` also a2 and b2, of those ids alone that occur more than once.
    """
    rows = _placed(ids.select("h")).drop("h").repartition("_word")
    if twice:
        rows = rows.groupBy("_word", "_a", "_b").agg(F.count("*").alias("_k"))
    kinds = {x: F.col(f"_{x}") for x in "ab"} | ({f"{x}2": F.when(F.col("_k") > 1, F.col(f"_{x}")) for x in "ab"} if twice else {})
    maps = rows.groupBy(F.col("_word").alias("word")).agg(*[F.bitmap_construct_agg(bit).alias(name) for name, bit in kinds.items()])
    return maps.select("word", *[_longs(name).alias(name) for name in kinds])


def held(rows: DataFrame, *maps: DataFrame) -> DataFrame:
    """``rows`` (h, ...) with ``marked``: true if ``h`` is in one of ``maps`` (word, a, b) of ``bitmaps``, and for few others.

    A map is broadcast as FILTER_BITS / 65536 rows of 8 KB at most. The more
    ids it has, the more others are marked; callers treat marked rows exactly.
    """
    rows, hit, more = _placed(rows), F.lit(False), ["_word", "_a", "_b"]
    for k, map_ in enumerate(maps):
        names = [f"_word{k}", f"_a{k}", f"_b{k}"]
        rows = rows.join(F.broadcast(map_.select("word", "a", "b").toDF(*names)), F.col("_word") == F.col(names[0]), "left")
        hit, more = hit | F.coalesce(_bit(names[1], F.col("_a")) & _bit(names[2], F.col("_b")), F.lit(False)), more + names
    return rows.withColumn("marked", hit).drop(*more)


def marked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` (h, ...) with ``marked``: true if ``h`` is in ``ids`` (h), and for few others.

    Reads a bitmap of FILTER_BITS hashed bits, broadcast as FILTER_BITS / 32768
    rows of 4 KB at most, whatever the number of ids. The more ids there are,
    the more others are marked; callers treat marked rows exactly.
    """
    bit = F.pmod(F.col("h"), F.lit(FILTER_BITS))
    maps = ids.select(F.floor(bit / _WORD).alias("word"), (bit % _WORD).alias("bit")).repartition("word")
    maps = maps.groupBy("word").agg(F.bitmap_construct_agg("bit").alias("map"))
    maps = maps.select("word", _longs("map").alias("map"))
    rows = rows.withColumn("_word", F.floor(bit / _WORD))
    hit = _bit("map", F.pmod(F.col("h"), F.lit(_WORD)))
    return rows.join(F.broadcast(maps), F.col("_word") == F.col("word"), "left").withColumn("marked", F.coalesce(hit, F.lit(False))).drop("_word", "word", "map")
