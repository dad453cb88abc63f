"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Random Fourier features make a linear model on them approximate one with a
Gaussian kernel on the statistics. The normal equations are sums over rows, so
every partition adds up its own and the sums are added. They are kept per fold:
the total less one fold gives the model that has not seen that fold, whose
scores of it fit the calibration.
"""

from __future__ import annotations

import operator
import zlib
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import folds
from tidemark.llm.store import Shared, stored

_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "stop": b".,;:?", "symbol": b"!#$%&*+<=>@[]^_`{|}~\\/",
    "quote": b"'\"()-", "high": range(128, 256), "control": [*range(0, 9), *range(14, 32), 127],
}
_MEMBER = np.zeros((256, len(_CLASSES)))
for _i, _c in enumerate(_CLASSES.values()):
    _MEMBER[list(_c), _i] = 1
STATISTICS = (*_CLASSES, "chars", "words", "lines", "word_length", "line_words", "distinct_words", "repeats", "distinct_lines",
              "short_words", "long_words", "ends", "packed")


def statistics(text: str | None) -> list[float]:
    """What STATISTICS names, of one whole text; all zero for a text without words."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(STATISTICS)
    data = text.encode("utf-8", "replace")
    share = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _MEMBER / len(data)
    lines = [x for x in text.split("\n") if x.strip()]
    n, lengths = len(words), list(map(len, words))
    return [
        *share.tolist(), np.log1p(len(text)), np.log1p(n), np.log1p(len(lines)), sum(lengths) / n, np.log1p(n / len(lines)),
        len(set(words)) / n, sum(map(operator.eq, words, words[1:])) / n, len(set(lines)) / len(lines),
        sum(k <= 3 for k in lengths) / n, sum(k >= 12 for k in lengths) / n,
        sum(x.rstrip()[-1:] in ".!?" for x in lines) / len(lines), np.log1p(len(zlib.compress(data, 1))) - np.log1p(len(data))]


def document_statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and x array<float>: the statistics of every whole text."""
    src = docs.select(F.col(text_col).cast("string").alias("_text"), *keep)

    def each(batches):
        for b in batches:
            x = [statistics(t) for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(x, pa.list_(pa.float32()))], [*b.schema.names[1:], "x"])

    return src.mapInArrow(each, src.drop("_text").select("*", F.lit(None).cast("array<float>").alias("x")).schema)


#: Training rows that one task adds up.
TASK_ROWS = 65_536


class Features:
    """sqrt(2 / n) cos(Wz + b) of standardised statistics z, and a constant."""

    def __init__(self, mean, std, n: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.std, self.n = np.array(mean), np.array(std), n
        self.w = rng.standard_normal((len(mean), n)) / width
        self.b = rng.uniform(0, 2 * np.pi, n)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -6, 6)
        return np.hstack([np.sqrt(2 / self.n) * np.cos(z @ self.w + self.b), np.ones((len(x), 1))])


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def normal_equations(rows: DataFrame, features: Features, n_rows: int) -> dict[int, np.ndarray]:
    """``rows`` (fold, y, x) -> by fold, Z'Z with Z'y as last column.

    Tasks of about TASK_ROWS of the ``n_rows`` rows add up their rows first, so
    their number grows with the rows and what they send stays small beside
    them; what is returned is bounded by the features' number.
    """
    shared = Shared(rows, features)

    def add(batches):
        f, sums = shared.get(), {}
        for b in batches:
            z, y, fold = f(_matrix(b.column("x"))), b.column("y").to_numpy(zero_copy_only=False), b.column("fold").to_numpy()
            for k in np.unique(fold):
                own = fold == k
                sums[k] = sums.get(k, 0) + z[own].T @ np.column_stack((z[own], y[own]))
        for k, a in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(a), pa.int64()), pa.array(range(len(a)), pa.int32()), pa.array(list(a), pa.list_(pa.float64()))],
                                             ["fold", "i", "a"])

    def total(group: pa.Table) -> pa.Table:
        a = _matrix(group["a"].combine_chunks()).sum(axis=0)
        return pa.table({"fold": group["fold"][:1], "i": group["i"][:1], "a": pa.array([a], pa.list_(pa.float64()))})

    part = rows.select("fold", "y", "x").coalesce(max(1, ceil(n_rows / TASK_ROWS))).mapInArrow(add, "fold bigint, i int, a array<double>")
    got = part.groupBy("fold", "i").applyInArrow(total, "fold bigint, i int, a array<double>").collect()
    out = {}
    for r in sorted(got, key=lambda r: (r["fold"], r["i"])):
        out.setdefault(r["fold"], []).append(r["a"])
    return {k: np.array(a) for k, a in out.items()}


def _ridge(sums: np.ndarray, penalty: float) -> np.ndarray:
    a = sums[:, :-1]
    keep = penalty * np.eye(len(a))
    keep[-1, -1] = 1e-9  # the constant is free
    return np.linalg.solve(a + keep, sums[:, -1])


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          threshold: float = 0.3, keep: tuple[str, ...] = (), n_features: int = 256, width: float = 4.0, penalty: float = 0.3,
          seed: int = 11) -> DataFrame:
    """(id_col, ``keep`` columns, held_out, score, predicted): the calibrated probability of label 1 for every row of ``docs``.

    Learned from all labelled rows outside the held-out fold; a score sees the
    text alone.

    Defined cases: null and empty texts have all statistics zero and are
    scored like any text. Null ids and null labels are not learned from;
    several labels of one id are several training rows, repeated rows of
    ``docs`` are scored alike. With nothing to learn from every score is 0.5.
    Only the named columns are read.
    """
    columns = tuple(dict.fromkeys((id_col, *keep)))
    x = stored(document_statistics(docs, text_col, columns), "quality-statistics")
    known = labels.where(F.col(label_col).isNotNull()).select(id_col, F.col(label_col).cast("double").alias("y"))
    train = x.select(id_col, "x").join(known, id_col).where(~folds.held_out(id_col)).select(folds.fold(id_col).alias("fold"), "y", "x")
    train = stored(train, "quality-train")
    d = len(STATISTICS)
    spread = train.agg(F.count("*").alias("n"), *[f(F.col("x")[i]).alias(f"{f.__name__}{i}") for f in (F.avg, F.stddev_pop) for i in range(d)]).first()
    out = lambda p: p.select(
        *columns, folds.held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
    if not spread["n"]:
        return out(x.withColumn("score", F.lit(0.5)))
    features = Features([spread[f"avg{i}"] for i in range(d)], [spread[f"stddev_pop{i}"] or 1.0 for i in range(d)], n_features, width, seed)
    sums = normal_equations(train, features, spread["n"])
    whole = sum(sums.values())
    final = _ridge(whole, penalty)
    unseen = {k: _ridge(whole - a, penalty) if len(sums) > 1 else final for k, a in sums.items()}

    def raw(rows: DataFrame, weights: dict, own: np.ndarray, kept: tuple[str, ...]) -> DataFrame:
        shared = Shared(rows, (features, weights, own))

        def each(batches):
            f, by_fold, one = shared.get()
            for b in batches:
                z = f(_matrix(b.column("x")))
                w = np.array([by_fold.get(k, one) for k in b.column("fold").to_pylist()]) if "fold" in b.schema.names else one
                value = (z * w).sum(axis=1)
                # on a grid, so that the calibration has a bounded number of steps
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(np.round(np.clip(value, -1, 2), 3))], [*kept, "raw"])

        return rows.mapInArrow(each, rows.select(*kept, F.lit(0.0).alias("raw")).schema)

    seen = raw(train, unseen, final, ("y",)).groupBy("raw").agg(F.avg("y").alias("label"), F.count("*").cast("double").alias("weight"))
    vector = VectorAssembler(inputCols=["raw"], outputCol="features")
    fitted = IsotonicRegression(weightCol="weight").fit(vector.transform(seen))
    steps = fitted.boundaries.toArray(), fitted.predictions.toArray()
    scored = raw(x, {}, final, columns)
    shared = Shared(docs, steps)

    def calibrate(batches):
        at, value = shared.get()
        for b in batches:
            p = np.clip(np.interp(b.column("raw").to_numpy(), at, value), 0, 1)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(p)], [*b.schema.names[:-1], "score"])

    return out(scored.mapInArrow(calibrate, scored.withColumnRenamed("raw", "score").schema))
