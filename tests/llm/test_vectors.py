import math

import numpy as np

from tests.conftest import SF_SMALL
from tidemark.llm import forest, queries, topk

ODD = [(1000, None), (1050, []), (1100, [1.0, None]), (1150, [float("nan"), 1.0]), (1200, [float("inf"), 0.0]), (None, [1.0, 1.0])]


def brute(rows, queries_of, score, k, descending):
    out = {}
    for q in {i for i, _ in rows if i % queries_of == 0}:
        best = {}
        for qv in [v for i, v in rows if i == q]:
            for i, v in rows:
                if i != q and len(v) == len(qv):
                    s = score(qv, v)
                    best[i] = max(best.get(i, s), s) if descending else min(best.get(i, s), s)
        out[q] = sorted(((-s if descending else s, i) for i, s in best.items()))[:k]
    return {(q, n + 1, i): (-s if descending else s) for q, found in out.items() for n, (s, i) in enumerate(found)}


def test_topk_cases_and_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk, "LIST_ROWS", 8)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 3) / 256]) for i in range(1, 400)] + [(i, [0.5, 0.5, 0.5]) for i in range(400, 460)]
    rows += [(50, rows[49][1]), (500, [0.0, 0.0, 0.0]), (600, [1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + ODD], "vec_id long, embedding array<double>, score int")
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    got = {(r.query_id, r["rank"], r.vec_id): r.score for r in topk.search(df).collect()}
    assert got == brute(whole, 50, lambda a, b: sum(x * y for x, y in zip(a, b)), 5, True)
    assert topk.search(df.limit(0)).collect() == []
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.search(few).collect()] == [(0, 1, 1, 256 * 512)]


def test_topk_lists_stop_early_and_stay_exact():
    rng = np.random.default_rng(2)
    x = np.floor(256 * rng.standard_normal((500, 8)))
    q = np.floor(256 * rng.standard_normal((9, 8)))
    exact = q @ x.T
    for reached in (-np.inf, np.sort(exact, axis=1)[:, -6]):
        at, row, score, _ = topk.read_lists(x, q, np.broadcast_to(reached, 9).astype(float), 6)
        assert (exact[at, row] == score).all()
        for i in range(9):
            assert set(np.argsort(-exact[i])[:6]) <= set(row[at == i])


def test_topk_lists_are_not_read_whole_where_bounds_close(monkeypatch):
    """Few rows stand out: what lies deeper in the lists is never used, whatever it is."""
    rng = np.random.default_rng(4)
    x = np.floor(20 * rng.random((1000, 6)))
    x[:8] += 500 + 10 * np.arange(8)[:, None]
    q = np.floor(1 + 50 * rng.random((5, 6)))
    exact = q @ x.T
    for steps, few in ((16, 1 / 32), (1000, 1 / 32), (16, 0.0), (16, 1.0)):
        monkeypatch.setattr(topk, "STEPS", steps)
        monkeypatch.setattr(topk, "FEW", few)
        at, row, score, depth = topk.read_lists(x, q, np.full(5, -np.inf), 6)
        assert depth <= (1.0 if few == 0.0 else 0.1) and (exact[at, row] == score).all()
        for i in range(5):
            assert set(np.argsort(-exact[i])[:6]) <= set(row[at == i])
    # mixed signs and zero weights
    q = np.array([[1.0, -1, 0, 3, -2, 0], [0.0] * 6, [-1.0] * 6])
    for few in (0.0, 1 / 32, 1.0):
        monkeypatch.setattr(topk, "FEW", few)
        at, row, score, _ = topk.read_lists(x, q, np.full(3, -np.inf), 6)
        assert ((q @ x.T)[at, row] == score).all() and (np.bincount(at) >= 6).all()
        for i in range(3):
            assert np.sort(score[at == i])[-6:].tolist() == np.sort(x @ q[i])[-6:].tolist()


def test_forest_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    at, x = {i: n for n, (i, _) in enumerate(rows)}, np.array([v for _, v in rows], float)
    got = queries.op4_forest(spark, SF_SMALL).collect()
    hit = 0
    for q in [i for i, _ in rows if i % 100 == 0]:
        dist = np.sqrt(((x - x[at[q]]) ** 2).sum(axis=1))
        want = [rows[n][0] for n in np.lexsort(([i for i, _ in rows], dist)) if rows[n][0] != q][:10]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        assert all(abs(r.score - dist[at[r.vec_id]]) < 1e-12 for r in mine)
        hit += len(set(want) & {r.vec_id for r in mine})
    assert hit >= 0.9 * len(got)


def test_forest_cases(spark, monkeypatch):
    monkeypatch.setattr(forest, "TASK_ROWS", 10)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-4, 5, 3)]) for i in range(1, 120)] + [(i, [9.0, 9.0, 9.0]) for i in range(195, 330)]
    rows = [(i, v) for i, v in rows if any(v)] + [(200, [9.0, 9.0, 9.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + ODD + [(700, [0.0, 0.0, 0.0])]], "vec_id long, embedding array<double>, leaf int")
    got = {(r.query_id, r["rank"], r.vec_id): r.score for r in forest.search(df, leaf_rows=16).collect()}
    want = brute(rows, 100, math.dist, 10, False)
    # copies of one vector are found whole, by id; the rest is approximate
    assert {k: v for k, v in got.items() if k[0] in (200, 300)} == {k: v for k, v in want.items() if k[0] in (200, 300)}
    assert len(set(got) & set(want)) >= 0.9 * len(want)
    assert forest.search(df.limit(0)).collect() == []
    few = spark.createDataFrame([(0, [1.0]), (1, [3.0]), (2, [1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in forest.search(few).orderBy("rank").collect()] == [(0, 1, 2, 0.0), (0, 2, 1, 2.0)]
