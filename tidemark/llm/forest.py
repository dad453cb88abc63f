"""Approximate nearest neighbours: a forest of random-projection trees.

The trees are fitted on a bounded sample of the vectors; every row is then
routed to its leaf in every tree. A query walks all trees at once through one
shared priority queue, ordered by its distance to the splits on the way, and
takes the best leaves of whichever tree. The rows of these leaves are ranked
by exact distance, where they lie.
"""

from __future__ import annotations

import heapq
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import vectors
from tidemark.llm.store import Shared, stored

#: Rows of one leaf that one task takes; a fuller leaf is dealt over several.
TASK_ROWS = 20_000


class Forest:
    """``trees`` balanced trees: node i of tree t splits on ``dirs[t, i] . x > cuts[t, i]``."""

    def __init__(self, sample: np.ndarray, trees: int, leaf_rows: int, seed: int):
        rng, (n, d) = np.random.default_rng(seed), sample.shape
        self.trees, self.depth = trees, max(0, ceil(log2(max(1, n / leaf_rows))))
        inner = (1 << self.depth) - 1
        self.dirs, self.cuts = np.zeros((trees, inner, d)), np.zeros((trees, inner))
        for t in range(trees):
            groups = [np.arange(n)]
            for i in range(inner):
                at = groups[i]
                if len(at):
                    # the line through two rows of the node, so that splits follow the data
                    a, b = sample[rng.choice(at, 2)] if len(at) > 1 else (sample[at[0]], np.zeros(d))
                    way = a - b if np.any(a != b) else rng.standard_normal(d)
                    way = way / max(np.linalg.norm(way), 1e-300)
                    p = sample[at] @ way
                    self.dirs[t, i], self.cuts[t, i] = way, np.median(p)
                    right = p > self.cuts[t, i]
                    groups += [at[~right], at[right]]
                else:
                    groups += [at, at]

    def route(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf of each row in each tree."""
        out = np.empty((len(x), self.trees), np.int32)
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                right = np.einsum("ij,ij->i", x, self.dirs[t, node]) > self.cuts[t, node]
                node = 2 * node + 1 + right
            out[:, t] = node - ((1 << self.depth) - 1)
        return out

    def leaves(self, q: np.ndarray, visits: int) -> list[tuple[int, int]]:
        """The ``visits`` best (tree, leaf), through one queue for all trees."""
        inner = (1 << self.depth) - 1
        margin = np.einsum("tid,d->ti", self.dirs, q) - self.cuts
        queue, out = [(-np.inf, t, 0) for t in range(self.trees)], []
        heapq.heapify(queue)
        while queue and len(out) < visits:
            far, t, node = heapq.heappop(queue)
            while node < inner:
                m = margin[t, node]
                near = 2 * node + 1 + (m > 0)
                heapq.heappush(queue, (max(far, abs(m)), t, 4 * node + 3 - near))
                far, node = max(far, -abs(m)), near
            out.append((t, node - inner))
        return out


def _nearest(x: np.ndarray, q: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the ``keep`` nearest (and ties) and their distances, in double precision."""
    rough = np.einsum("ij,ij->i", x, x) - 2 * (x @ q)
    if len(x) > keep:
        limit = np.partition(rough, keep - 1)[keep - 1]
        at = np.flatnonzero(rough <= limit + 1e-9 * (1 + np.abs(rough).max()))
    else:
        at = np.arange(len(x))
    return at, np.sqrt(((x[at] - q) ** 2).sum(axis=1))


def visits_for(forest: Forest, sample: np.ndarray, k: int, target: float, probes: int, seed: int) -> int:
    """The fewest leaves that reach ``target`` recall on queries drawn from the sample."""
    total = forest.trees << forest.depth
    if not len(sample):
        return total
    rng, where = np.random.default_rng(seed), forest.route(sample)
    needed = []
    for i in rng.choice(len(sample), min(probes, len(sample)), replace=False):
        order = {leaf: n for n, leaf in enumerate(forest.leaves(sample[i], total))}
        at, dist = _nearest(sample, sample[i], k + 1)
        for j in at[np.argsort(dist, kind="stable")][: k + 1]:
            if j != i:
                needed.append(1 + min(order[t, int(where[j, t])] for t in range(forest.trees)))
    return int(np.sort(needed)[min(len(needed) - 1, ceil(target * len(needed)) - 1)]) if needed else total


def search(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, query_every: int = 100,
           trees: int = 6, leaf_rows: int = 128, sample_rows: int = 16384, target_recall: float = 0.97,
           probes: int = 200, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for the rows whose id is divisible by ``query_every``.

    ``score`` is the Euclidean distance of the original vectors in double
    precision; ties go to the smaller id; the query's own id is no candidate.
    The forest is fitted on about ``sample_rows`` distinct vectors drawn by
    hash (its size is bounded by them), every row is indexed. The number of
    leaves a query visits is set where ``target_recall`` is reached for
    ``probes`` queries of the sample.

    A leaf with very many rows is dealt over several tasks, to all of which
    its queries go; equal vectors are one entry.

    Defined cases: null ids, null, empty or zero vectors, and vectors with a
    null or non-finite component take no part, nor do vectors of another
    length than the most common one. Repeated rows count once. Up to
    ``leaf_rows`` distinct vectors the search is exhaustive. No rows: an empty
    result. Only the two named columns are read.
    """
    spark, keep = table.sparkSession, k + 1
    rows = vectors.usable(table, id_col, vec_col, allow_zero=False)
    cls = stored(vectors.classes(rows, keep), "forest-classes")
    width = cls.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if width is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    d, n = width["d"], width["count"]
    cls = cls.where(F.size("vec") == d)
    drawn = cls if n <= sample_rows else cls.where(F.pmod(F.xxhash64("vec"), F.lit(1 << 20)) < int((1 << 20) * sample_rows / n))
    sample = np.array([r["vec"] for r in drawn.select("vec").orderBy("vec").collect()], np.float64).reshape(-1, d)
    forest = Forest(sample, trees, leaf_rows, seed)
    shared = Shared(table, (forest, visits_for(forest, sample, k, target_recall, probes, seed)))

    def matrix(column) -> np.ndarray:
        flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)

    def index(batches):
        own, _ = shared.get()
        for b in batches:
            x = matrix(b.column("vec"))
            leaf = own.route(x)
            for t in range(trees):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(leaf[:, t]), b.column("vec"), b.column("ids")],
                                                 ["tree", "leaf", "vec", "ids"])

    def visit(batches):
        own, visits = shared.get()
        for b in batches:
            for name, q in zip(b.column("query_id").to_pylist(), matrix(b.column("vec"))):
                at = own.leaves(q, visits)
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array([t for t, _ in at], pa.int32()), "leaf": pa.array([x for _, x in at], pa.int32()),
                    "query_id": pa.array([name] * len(at), pa.int64()), "q": pa.array([q] * len(at), pa.list_(pa.float64()))})

    indexed = stored(cls.mapInArrow(index, "tree int, leaf int, vec array<double>, ids array<bigint>"), "forest-index")
    # One row per leaf, as many as the fitted trees have.
    shares = indexed.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / TASK_ROWS).cast("int").alias("shares"))
    asked = rows.where((F.size("vec") == d) & (F.col("id") % query_every == 0)).select(F.col("id").alias("query_id"), "vec").distinct()
    asked = asked.mapInArrow(visit, "tree int, leaf int, query_id bigint, q array<double>").join(F.broadcast(shares), ["tree", "leaf"])
    asked = asked.select("tree", "leaf", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "query_id", "q")
    dealt = indexed.join(F.broadcast(shares), ["tree", "leaf"]).withColumn("share", F.pmod(F.xxhash64("vec"), "shares").cast("int"))

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        x, ids, out = matrix(left["vec"]), left["ids"].combine_chunks(), []
        first = pa.compute.list_element(ids, 0).to_numpy()
        for name, q in zip(right["query_id"].to_pylist(), matrix(right["q"])):
            at, score = _nearest(x, q, keep)
            order = np.lexsort((first[at], score))[:keep]
            out.append(pa.table([np.full(len(order), name), score[order], ids.take(pa.array(at[order]))], schema=schema))
        return pa.concat_tables(out)

    key = ["tree", "leaf", "share"]
    found = dealt.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(rerank, "query_id bigint, score double, ids array<bigint>")
    return vectors.best(found, k, descending=False)
