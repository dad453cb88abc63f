"""Vector tables: usable rows, and one class per distinct vector."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W


def usable(vectors: DataFrame, id_col: str, vec_col: str, allow_zero: bool = True) -> DataFrame:
    """(id, vec array<double>) without null ids, null or empty vectors, null or
    non-finite components and, unless allowed, zero vectors."""
    v = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(F.col("id").isNotNull() & (F.size("vec") > 0)).where(fine)
    return v if allow_zero else v.where(F.exists("vec", lambda x: x != 0))


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """(vec, ids): one row per distinct vector with its ``keep`` smallest ids.

    Rows with equal vectors have equal scores for every query and are told
    apart by id alone, so a search for the ``keep - 1`` best needs no more of
    them. The rank limit is applied before the shuffle too, so a vector that
    very many rows share sends ``keep`` rows per task.
    """
    first = W.Window.partitionBy("vec").orderBy("id")
    low = rows.withColumn("at", F.dense_rank().over(first)).where(F.col("at") <= keep)
    return low.groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("ids"))


def best(found: DataFrame, k: int, descending: bool) -> DataFrame:
    """(query_id, score, ids) -> (query_id, rank, vec_id, score): the k best per query, ties to smaller ids."""
    one = found.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    pick = F.max("score") if descending else F.min("score")
    one = one.groupBy("query_id", "vec_id").agg(pick.alias("score"))
    order = W.Window.partitionBy("query_id").orderBy(F.desc("score") if descending else F.asc("score"), "vec_id")
    return one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
