"""Exact top-k inner products by no-random-access aggregation of sorted lists.

Each component is a list of (row, value) sorted by value. A query reads every
list from its good end (largest first for a positive weight, smallest first
for a negative one), to the same depth. What is not read yet is bounded by the
list's frontier from above and by its far end from below; rows whose upper
bound is below the k-th best lower bound cannot qualify and are closed, seen
or not. The lists are read on until all components of the rows still open
are read: their scores are final then. No row is looked up aside.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import vectors

#: Rows of a block of lists; queries of a block; rows whose lists are read together.
BLOCK_ROWS, BLOCK_QUERIES, LIST_ROWS, READ_QUERIES = 16384, 4096, 2048, 256
#: Steps in which a list is read; share of (query, row) pairs from which down the open ones are followed one by one.
STEPS, FEW = 16, 1 / 32


def _keep_best(q, score, first, at, keep):
    """The ``keep`` best of each query by score, then first id."""
    order = np.lexsort((first, -score, q))
    q, score, first, at = q[order], score[order], first[order], at[order]
    begin = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.empty(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(begin, np.diff(np.concatenate((begin, [len(q)]))))
    ok = rank < keep
    return q[ok], score[ok], first[ok], at[ok]


def read_lists(x: np.ndarray, queries: np.ndarray, threshold: np.ndarray, keep: int):
    """(query, row, score, depth) of all rows that can be among a query's ``keep`` best, given what is known to be reached.

    ``depth`` is the share of every list that was read. Only components read
    so far are used of any row. While many (query, row) pairs are open, the
    bounds of the rows that some query has open are matrix products; few open
    pairs are followed one by one, until all their components are read or the
    bounds close them. All numbers are whole and far below 2**53, so doubles are exact.
    """
    n, d = x.shape
    order = np.argsort(x, axis=0, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n)[:, None].repeat(d, 1), axis=0)
    by_value = np.take_along_axis(x, order, axis=0)
    up, down, step = np.maximum(queries, 0), np.minimum(queries, 0), max(1, ceil(n / STEPS))
    rows, open_pairs, t = np.arange(n), np.ones((len(queries), n), bool), 0
    while not t or t < n and open_pairs.sum() > len(queries) * n * FEW:
        t = min(n, t + step)
        top, bottom, values = rank[rows] >= n - t, rank[rows] < t, x[rows]
        lower = up @ np.where(top, values, by_value[0]).T + down @ np.where(bottom, values, by_value[-1]).T
        if len(rows) >= keep:
            reached = np.where(open_pairs, lower, -np.inf)
            threshold = np.maximum(threshold, np.partition(reached, len(rows) - keep, axis=1)[:, len(rows) - keep])
        if t < n and (up @ by_value[n - t] + down @ by_value[t - 1] >= threshold).all():
            continue  # rows not seen yet can still qualify for every query: no end in sight
        upper = up @ np.where(top, values, by_value[n - t]).T + down @ np.where(bottom, values, by_value[t - 1]).T
        open_pairs &= upper >= threshold[:, None]
        some = open_pairs.any(axis=0)
        rows, open_pairs, lower = rows[some], open_pairs[:, some], lower[:, some]
    q, at = np.nonzero(open_pairs)
    row = rows[at]
    if t == n:
        return q, row, lower[q, at], 1.0
    while True:
        w, values = queries[q], x[row]
        read = np.where(w > 0, rank[row] >= n - t, rank[row] < t) | (w == 0)
        upper = (w * np.where(read, values, np.where(w > 0, by_value[n - t], by_value[t - 1]))).sum(axis=1)
        lower = (w * np.where(read, values, np.where(w > 0, by_value[0], by_value[-1]))).sum(axis=1)
        # closed rows are below the threshold already, so open ones alone can raise it
        held = _keep_best(q, lower, row, row, keep)
        full = np.bincount(held[0], minlength=len(queries)) >= keep
        least = np.full(len(queries), np.inf)
        np.minimum.at(least, held[0], held[1])
        threshold = np.where(full, np.maximum(threshold, least), threshold)
        ok = upper >= threshold[q]
        q, row, lower, read = q[ok], row[ok], lower[ok], read[ok]
        if read.all():
            return q, row, lower, t / n
        t = min(n, t + step)


def top_inner_products(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``rows`` (id, vec of whole numbers), ``queries`` (id, vec) -> (query_id, rank, vec_id, score).

    The exact k best of every query among all rows but its own id. Distinct
    vectors are hashed into blocks of about BLOCK_ROWS, queries into blocks of
    about BLOCK_QUERIES, and each pair of blocks is one task's work; the
    blocks are of distinct vectors, so no repeated vector can fill one.
    Vectors of another length than the query's are no candidates.
    """
    keep = k + 1
    cls = vectors.classes(rows, keep).withColumn("d", F.size("vec"))
    ask = queries.select(F.col("id").alias("query_id"), "vec").distinct().withColumn("d", F.size("vec"))
    n_blocks = max(1, ceil(rows.count() / BLOCK_ROWS))
    n_asks = max(1, ceil(queries.count() / BLOCK_QUERIES))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cls = cls.withColumn("block", F.pmod(F.xxhash64("vec"), F.lit(n_blocks)).cast("int")).withColumn("part", numbers(n_asks))
    ask = ask.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(n_asks)).cast("int")).withColumn("block", numbers(n_blocks))

    def matrix(column) -> np.ndarray:
        flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("score", pa.int64()), ("ids", pa.list_(pa.int64()))])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        x, want, ids = matrix(left["vec"]), matrix(right["vec"]), left["ids"].combine_chunks()
        first = pa.compute.list_element(ids, 0).to_numpy()
        names, found = right["query_id"].to_numpy(), []
        for a in range(0, len(want), READ_QUERIES):
            part = want[a : a + READ_QUERIES]
            held = tuple(np.empty(0, t) for t in (np.int64, np.float64, np.int64, np.int64))
            for b in range(0, len(x), LIST_ROWS):
                reached = np.full(len(part), -np.inf)
                full = np.flatnonzero(np.bincount(held[0], minlength=len(part)) >= keep)
                if len(full):
                    low = np.full(len(part), np.inf)
                    np.minimum.at(low, held[0], held[1])
                    reached[full] = low[full]
                q, row, score, _ = read_lists(x[b : b + LIST_ROWS], part, reached, keep)
                held = _keep_best(*(np.concatenate(p) for p in zip(held, (q, score, first[row + b], row + b))), keep)
            found.append(pa.table([names[held[0] + a], held[1].astype(np.int64), ids.take(pa.array(held[3]))], schema=schema))
        return pa.concat_tables(found)

    met = cls.groupBy("part", "block", "d").cogroup(ask.groupBy("part", "block", "d")).applyInArrow(
        search, "query_id bigint, score bigint, ids array<bigint>")
    return vectors.best(met, k, descending=True)


def search(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, scale: int = 256,
           query_every: int = 50) -> DataFrame:
    """Exact top-k of the rows whose id is divisible by ``query_every``, on floor(scale * component).

    Defined cases: null ids, null or empty vectors and vectors with a null or
    non-finite component take no part; a zero vector does. Repeated rows count
    once; an id with two vectors is two candidates, of which the better one
    counts. Fewer candidates than k: all. No rows: an empty result. Only the
    two named columns are read.
    """
    rows = vectors.usable(table, id_col, vec_col).select("id", F.transform("vec", lambda x: F.floor(x * scale).cast("double")).alias("vec"))
    return top_inner_products(rows, rows.where(F.col("id") % query_every == 0), k)
