"""Toxicity by a classifier chain of linear models.

The categories are predicted one after the other; each model sees the text's
words and the probabilities of the categories before it. For training, those
probabilities come from models that have not seen the row (out of fold), so
that a later model learns how far an earlier one can be trusted on new texts.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import folds
from tidemark.llm.filters import marked
from tidemark.llm.store import Shared, stored

#: Hashes of word features, counts told apart (1, 2, 3 and more), distinct words a task keeps features of.
WIDTH, LEVELS, TABLE = 1 << 17, 3, 100_000
SIZE = WIDTH * LEVELS
#: Features that a product reads at a time; the part of the training rows that is all of them.
READ, WHOLE = 1 << 16, -1
#: Letters of a word's beginnings; a stem with changing ends is found by them.
BEGINNINGS = range(4, 9)
#: A beginning is hashed behind its length, of which this is the hash.
BEGUN = [(n, zlib.crc32(str(n).encode())) for n in BEGINNINGS]


def word_features(word: str) -> list[int]:
    """Hashes of a lower-cased word without outer punctuation, and of its beginnings."""
    w = word.strip(".,;:!?\"'()[]{}*#$%&|-_/\\")
    if w.isascii():  # a letter is a byte
        b = w.encode()
        return [zlib.crc32(b) % WIDTH] + [zlib.crc32(b[:n], begun) % WIDTH for n, begun in BEGUN if len(b) > n] if b else []
    return [zlib.crc32(w.encode()) % WIDTH] + [zlib.crc32(w[:n].encode(), begun) % WIDTH for n, begun in BEGUN if len(w) > n]


class Known(dict):
    """word -> its features, as bytes: a fifth of the memory of lists."""

    def __missing__(self, word: str) -> bytes:
        self[word] = out = array("i", word_features(word)).tobytes()
        return out


class Words:
    """The features of whole texts: each hash that occurs at least once, twice, three times."""

    def __init__(self):
        self.known = Known()
        self.often, self.last = np.zeros(WIDTH, np.int32), np.empty(WIDTH, np.int32)

    def __call__(self, text: str | None) -> np.ndarray:
        known = self.known
        if len(known) > TABLE:
            known.clear()
        words = Counter((text or "").lower().split())
        own = [known[w] for w in words]
        at = np.frombuffer(b"".join(own), np.int32)
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        np.add.at(self.often, at, np.repeat(np.fromiter(words.values(), np.int32, len(own)), sizes))
        places = np.arange(len(at), dtype=np.int32)
        self.last[at] = places
        at = np.sort(at[self.last[at] == places])  # each once
        often = self.often[at]
        self.often[at] = 0
        return np.concatenate([at[often > n] + np.int32(n * WIDTH) for n in range(LEVELS)])


def packed(ix: np.ndarray) -> bytes:
    """Ascending numbers as compressed gaps, a quarter to a third of their size: first all lowest bytes, then all second ones, ..."""
    return zlib.compress(np.diff(ix, prepend=0).astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(gaps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(gaps), np.uint8).reshape(4, -1).T.copy().view("<i4").ravel(), dtype=np.int32)


def _label_rows(docs: DataFrame, labels: DataFrame, id_col: str, categories: dict) -> DataFrame:
    """(key, y0, y1, ...) of all labels outside the held-out fold; ``key`` is the id in the type that it has in both tables together."""
    y = [F.expr(e).cast("double").alias(f"y{i}") for i, e in enumerate(categories.values())]
    known = labels.select(F.col(id_col).alias("id"), *y).dropna()
    kind = docs.select(id_col).union(labels.select(id_col)).schema[id_col].dataType
    return known.where(~folds.held_out("id")).select(F.col("id").cast(kind).alias("key"), *[f"y{i}" for i in range(len(y))])


def _group(groups: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("group"), "key"), F.lit(groups)).cast("int").alias("grp")


def _train_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, categories: dict, task_rows: int, n_folds: int) -> tuple[DataFrame, int]:
    """(grp, key, fold, ix: packed features) of all documents with labels outside the held-out fold, and of few others;
    how many groups of about ``task_rows`` labels they are in."""
    known = _label_rows(docs, labels, id_col, categories)
    groups = max(1, -(-known.count() // task_rows))
    src = docs.where(~folds.held_out(id_col)).select(F.col(id_col).cast(known.schema["key"].dataType).alias("key"), F.col(text_col).cast("string").alias("text"))
    # texts stay where they are; what meets the labels are the features of few other rows than those that have labels
    h = F.xxhash64("key").alias("h")
    src = marked(src.select("*", h), known.select(h)).where("marked").select("key", "text")

    def each(batches):
        words = Words()
        for b in batches:
            ix = pa.array([packed(words(t)) for t in b.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("key"), ix], ["key", "ix"])

    fold = F.pmod(F.xxhash64(F.lit("fold"), "key"), F.lit(n_folds)).cast("int").alias("fold")
    src = src.mapInArrow(each, src.select("key", F.lit(b"").alias("ix")).schema)
    return src.select(_group(groups), "key", fold, "ix"), groups


def _cuts(ends: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Where to cut rows that end at ``ends``, so that there are about READ features at a time; also cut at ``more``."""
    return np.unique(np.concatenate((np.searchsorted(ends[1:], np.arange(READ, ends[-1], READ)) + 1, [0, len(ends) - 1], *more)))


class Rows:
    """Rows as sets of numbered features and a few numbers beside them; products go a bounded number of features at a time."""

    def __init__(self, at: np.ndarray, ends: np.ndarray, beside: np.ndarray, width: int):
        self.at, self.ends, self.beside, self.width = at, ends, beside, width
        self.cuts = _cuts(ends)

    def _reads(self):
        for a, b in zip(self.cuts[:-1], self.cuts[1:]):
            yield a, b, self.at[self.ends[a] : self.ends[b]], self.ends[a : b + 1] - self.ends[a]

    def times(self, w: np.ndarray) -> np.ndarray:
        out = self.beside @ w[self.width :]
        for a, b, at, ends in self._reads():
            if len(at):
                full = np.flatnonzero(np.diff(ends))  # of a row without features reduceat would give the next feature
                out[a + full] += np.add.reduceat(np.take(w, at), ends[full])
        return out

    def summed(self, by_row: np.ndarray) -> np.ndarray:
        out = np.zeros(self.width)
        for a, b, at, ends in self._reads():
            np.add.at(out, at, np.repeat(by_row[a:b], np.diff(ends)))
        return np.concatenate((out, self.beside.T @ by_row))


def _minimum(score, value, slope, x: np.ndarray, max_iter: int, memory: int = 10, tolerance: float = 1e-7) -> np.ndarray:
    """Where a smooth convex ``value(x, z)`` of ``x`` and its linear ``z = score(x)`` is least, ``slope(x, z)`` being its slope.

    Limited-memory quasi-Newton steps, halved until the value falls enough;
    along a step ``z`` moves straight on, so each step needs one score.
    """
    z = score(x)
    now, down = value(x, z), slope(x, z)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(max_iter):
        way, kept = -down, []
        for s, y in reversed(past):
            kept.append(s @ way / (s @ y))
            way = way - kept[-1] * y
        if past:
            s, y = past[-1]
            way = way * (s @ y / (y @ y))
        for (s, y), c in zip(past, reversed(kept)):
            way = way + (c - y @ way / (s @ y)) * s
        fall, step = down @ way, 1.0 if past else 1.0 / max(1.0, np.linalg.norm(down))
        if not fall < 0:
            break
        z_way = score(way)
        while True:
            new, new_z = x + step * way, z + step * z_way
            new_value = value(new, new_z)
            if new_value <= now + 1e-4 * step * fall or step < 1e-12:
                break
            step /= 2
        if not new_value < now:
            break
        new_down, done = slope(new, new_z), now - new_value <= tolerance * max(1.0, abs(now))
        s, y = new - x, new_down - down
        if s @ y > 1e-14:
            past = [*past, (s, y)][-memory:]
        x, z, now, down = new, new_z, new_value, new_down
        if done:
            break
    return x


def logistic(rows: Rows, y: np.ndarray, penalty: float, max_iter: int) -> tuple[np.ndarray, float]:
    """(weights, constant) of least mean log loss and ``penalty`` / 2 times the squared weights; rows of one value get that value."""
    mean, m = float(y.mean()), len(y)
    if mean in (0.0, 1.0):
        return np.zeros(rows.width + rows.beside.shape[1]), 30.0 if mean else -30.0

    def score(x: np.ndarray) -> np.ndarray:
        return rows.times(x[:-1]) + x[-1]

    def value(x: np.ndarray, z: np.ndarray) -> float:
        return (np.logaddexp(0, z) - y * z).mean() + penalty / 2 * (x[:-1] @ x[:-1])

    def slope(x: np.ndarray, z: np.ndarray) -> np.ndarray:
        off = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / m
        return np.append(rows.summed(off) + penalty * x[:-1], off.sum())

    begin = np.zeros(rows.width + rows.beside.shape[1] + 1)
    begin[-1] = np.log(mean / (1 - mean))
    x = _minimum(score, value, slope, begin, max_iter)
    return x[:-1], float(x[-1])


def _probabilities(links: list[tuple[np.ndarray, float]], at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One column per link, each of which sees the ones before it."""
    out = np.zeros((len(ends) - 1, len(links)))
    for k, (w, constant) in enumerate(links):
        z = Rows(at, ends, out[:, :k], SIZE).times(w) + constant
        out[:, k] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    return out


def _fit_link(rows: DataFrame, k: int, parts: list[int], earlier: dict, penalty: float, max_iter: int, min_rows: int,
              groups: int = 1, labels: DataFrame | None = None) -> dict[int, tuple[np.ndarray, float]]:
    """``rows`` (grp, fold, y, ix) -> link ``k`` by part: fitted to the rows of all other folds, or to all rows for part WHOLE.

    ``earlier`` has by fold the links before it that have not seen the fold.
    The rows of one group move once, to one task, which fits all parts to them
    one after the other; a part's model is the mean of those of its groups,
    taken by Spark. One group needs no ``grp``. A task holds the rows of a
    group packed, the numbers of one part's features and few more. With
    ``labels`` (grp, key, y) the rows have ``key`` for y, and meet it there.
    """
    shared = Shared(rows, earlier)

    def each(group: pa.Table) -> pa.Table:
        if not len(group):  # labels of no document
            return pa.table({"part": pa.array([], pa.int32()), "at": pa.array([], pa.int32()), "weight": pa.array([], pa.float64())})
        group = group.sort_by("fold").combine_chunks()  # rows of a fold share their earlier links
        fold, y, by_fold, packs = group["fold"].to_numpy(), group["y"].to_numpy(), shared.get(), group["ix"]
        sets = lambda a, b: [unpacked(x.as_buffer()) for x in packs.slice(a, b - a)]
        present = np.unique(fold).tolist()
        places = {f: np.searchsorted(fold, [f, f + 1]) for f in present}
        seen, sizes = {f: np.zeros(SIZE, np.int32) for f in present}, np.empty(len(y), np.int64)
        for f, (a, b) in places.items():
            for i in range(a, b):
                ix = unpacked(packs[i].as_buffer())
                seen[f][ix] += 1
                sizes[i] = len(ix)
        # Features of few rows say little and would explain single rows away.
        least, total = -(-min_rows // groups), sum(seen.values())
        enough = total >= least
        at, beside = np.empty(int(total[enough].sum()), np.int32), np.full((len(y), k), 0.5)
        cuts = _cuts(np.concatenate(([0], np.cumsum(sizes))), *places.values())
        done, kept = 0, np.empty(len(y), np.int64)
        for a, b in zip(cuts[:-1], cuts[1:]):
            ix, ends = np.concatenate(sets(a, b)), np.concatenate(([0], np.cumsum(sizes[a:b])))
            if fold[a] in by_fold:
                beside[a:b] = _probabilities(by_fold[fold[a]], ix, ends)
            keep = enough[ix]
            kept[a:b] = np.diff(np.concatenate(([0], np.cumsum(keep)))[ends])
            ix = ix[keep]
            at[done : done + len(ix)] = ix
            done += len(ix)
        ends, out = np.concatenate(([0], np.cumsum(kept))), []
        for p in parts:
            # the rows of the other folds; their features are numbered anew, so that the model is no wider than needed
            taken = [places[f] for f in present if f != p]
            if not taken:
                continue
            used = np.flatnonzero(total - seen.get(p, 0) >= least).astype(np.int32)
            number = np.full(SIZE, -1, np.int32)
            number[used] = np.arange(len(used), dtype=np.int32)
            own = np.concatenate([np.take(number, at[ends[a] : ends[b]]) for a, b in taken])
            own_ends = np.concatenate(([0], np.cumsum(np.concatenate([kept[a:b] for a, b in taken]))))
            own_y, own_beside = (np.concatenate([x[a:b] for a, b in taken]) for x in (y, beside))
            own_ends = np.concatenate(([0], np.cumsum(own >= 0)))[own_ends]
            own = own[own >= 0]
            w, constant = logistic(Rows(own, own_ends, own_beside, len(used)), own_y, penalty, max_iter)
            if groups > 1 and abs(constant) == 30.0 and not w.any():  # one value here says less than one value everywhere
                constant = float(np.log((own_y.sum() + 0.5) / (len(own_y) - own_y.sum() + 0.5)))
            where = np.concatenate(([-1], used, SIZE + np.arange(k))).astype(np.int32)
            out.append(pa.table({"part": np.full(len(where), p, np.int32), "at": where, "weight": np.concatenate(([constant], w))}))
        return pa.concat_tables(out)

    def met(own: pa.Table, known: pa.Table) -> pa.Table:
        at = pa.table({"key": own["key"], "at": np.arange(len(own))}).join(known.select(["key", "y"]), "key", join_type="inner", use_threads=False)
        return each(own.take(at["at"]).append_column("y", at["y"]).select(["fold", "y", "ix"]))

    grp, y, model = F.col("grp") if groups > 1 else F.lit(0).alias("grp"), F.col(f"y{k}").alias("y"), "part int, at int, weight double"
    if labels is None:
        models = rows.select(grp, "fold", y, "ix").groupBy("grp").applyInArrow(each, model)
    else:
        models = rows.groupBy("grp").cogroup(labels.select("grp", "key", y).groupBy("grp")).applyInArrow(met, model)
    # no more rows than places of a model, whatever the number of groups
    found = models.groupBy("part", "at").agg(F.sum("weight").alias("weight"), F.count("*").alias("models")).toArrow()
    part, at, weight, n = (found[c].to_numpy() for c in ("part", "at", "weight", "models"))
    out = {}
    for p in np.unique(part).tolist():
        own, weights = part == p, np.zeros(SIZE + k + 1)
        weights[at[own]] = weight[own] / n[own & (at == -1)][0]  # place -1: the constant, once a model
        out[p] = weights[:-1], float(weights[-1])
    return out


def fit(docs: DataFrame, labels: DataFrame, categories: dict, id_col: str = "doc_id", text_col: str = "text",
        task_rows: int = 20_000, n_folds: int = 3, penalty: float = 1e-4, max_iter: int = 40, min_rows: int = 6,
        decide: str | None = None) -> tuple[list[tuple[np.ndarray, float]], float] | None:
    """((weights, constant) of each link, threshold); the last weights of a link are those of the earlier probabilities.

    With ``decide``, ``threshold`` is where the out-of-fold probabilities of
    that category tell its rows from the others best (see ``best_threshold``); else 0.5.

    All labelled rows outside the held-out fold are learned from. One job a
    link: it fits the model of all rows and those of the folds. Beyond
    ``task_rows`` rows they are dealt into groups of about that size, each one
    task's work, and a model is the mean of its groups'
    (parameter averaging). A feature counts from ``min_rows`` rows of its
    model's own on, or its group's share of them. None if there are no labelled rows.
    """
    n = len(categories)
    rows, groups = _train_rows(docs, labels, id_col, text_col, categories, task_rows, n_folds)
    known = _label_rows(docs, labels, id_col, categories).select(_group(groups), "*")
    rows = stored(rows, "toxicity-train")
    links, unseen = [], {f: [] for f in range(n_folds)}
    for k in range(n):
        # without a threshold to find, nothing needs the last link's models of folds
        parts = [WHOLE, *range(n_folds)] if decide or k + 1 < n else [WHOLE]
        found = _fit_link(rows, k, parts, unseen, penalty, max_iter, min_rows, groups, known)
        if not found:
            return None
        links.append(found[WHOLE])
        # a fold that holds all rows leaves none for its own model, which then says 0.5
        unseen = {f: [*unseen[f], found.get(f, (np.zeros(SIZE + k), 0.0))] for f in unseen}
    if decide is None:
        return links, 0.5
    k = list(categories).index(decide)
    shared = Shared(rows, {f: x[: k + 1] for f, x in unseen.items()})

    def each(batches):
        by_fold = shared.get()
        for b in batches:
            fold, packs, p = b.column("fold").to_numpy(), b.column("ix"), np.empty(b.num_rows)
            for f in np.unique(fold):
                own = np.flatnonzero(fold == f)
                for some in np.array_split(own, -(-len(own) // 500)):
                    sets = [unpacked(packs[i].as_buffer()) for i in some.tolist()]
                    p[some] = _probabilities(by_fold[f], np.concatenate(sets), np.concatenate(([0], np.cumsum([len(x) for x in sets]))))[:, k]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(p, pa.float64())], ["key", "p"])

    told = rows.select("key", "fold", "ix").mapInArrow(each, rows.select("key", F.lit(0.0).alias("p")).schema).join(known, "key")
    told = told.select("p", F.col(f"y{k}").alias("y"))
    # at most 100,001 probabilities reach the driver, whatever the number of rows
    p = F.col("p") if groups == 1 else F.round("p", 5)
    told = told.groupBy(p.alias("p")).agg(F.sum("y").alias("y"), F.count("*").alias("n")).toArrow()
    return links, best_threshold(told["p"].to_numpy(), told["y"].to_numpy(), rows=told["n"].to_numpy())


def best_threshold(p: np.ndarray, y: np.ndarray, beta: float = 0.5, rows: np.ndarray | None = None) -> float:
    """Where F-beta of ``p`` >= threshold is largest, between two neighbouring probabilities; 0.5 if ``y`` has one value only.

    With ``rows``, each probability stands for that many rows, ``y`` of which are of the category.
    At 0.5 precision weighs more than recall: a clean row called toxic is the worse mistake of a filter.
    """
    rows = np.ones(len(p)) if rows is None else rows
    if y.sum() in (0, rows.sum()):
        return 0.5
    order = np.argsort(-p, kind="stable")
    p, hits, n = p[order], np.cumsum(y[order]), np.cumsum(rows[order])
    score = (1 + beta**2) * hits / (n + beta**2 * hits[-1])
    score[:-1][p[:-1] == p[1:]] = -1.0  # equal probabilities fall on one side
    at = int(np.argmax(score))
    return float((p[at] + p[at + 1]) / 2 if at + 1 < len(p) else p[at])


def predict(docs: DataFrame, links, names: list[str], text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and p_<name> of each category, for every whole text."""
    src = docs.select(F.col(text_col).cast("string").alias("_text"), *keep)
    n = len(names)
    weights = np.array([np.append(w, np.zeros(SIZE + n - len(w))) for w, _ in links]) if links else np.zeros((n, SIZE + n))
    shared = docs.sparkSession.sparkContext.broadcast((weights, [c for _, c in links] if links else [0.0] * n))

    def each(batches):
        w, constant = shared.value
        words = Words()
        for b in batches:
            p = np.zeros((b.num_rows, n))
            for i, text in enumerate(b.column("_text").to_pylist()):
                ix = words(text)
                own = [np.take(x, ix).sum() for x in w]
                for k in range(n):
                    z = own[k] + constant[k] + w[k, SIZE : SIZE + k] @ p[i, :k]
                    p[i, k] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], *[pa.array(p[:, k]) for k in range(n)]], [*b.schema.names[1:], *[f"p_{x}" for x in names]])

    schema = src.drop("_text").select("*", *[F.lit(None).cast("double").alias(f"p_{x}") for x in names]).schema
    return src.mapInArrow(each, schema)


def classify(docs: DataFrame, labels: DataFrame, categories: dict, decide: str, threshold: float | None = 0.5, id_col: str = "doc_id",
             text_col: str = "text", keep: tuple[str, ...] = (), **training) -> DataFrame:
    """(id_col, ``keep`` columns, held_out, p_<category>..., score, predicted): one row per row of ``docs``.

    ``categories`` are 0/1 expressions over ``labels`` by name, in the chain's order;
    ``score`` is the probability of the category ``decide`` and ``predicted``
    whether it reaches ``threshold``, or if that is None the threshold that is
    best for the training rows, out of fold.

    Defined cases: a null or empty text has no words and gets each model's
    base rate. Null ids and rows with a null label are not learned from;
    repeated rows are scored alike; without labelled rows every probability is
    0.5 and no row is predicted. Only the named columns are read.
    """
    links, best = fit(docs, labels, categories, id_col, text_col, decide=decide if threshold is None else None, **training) or (None, 0.5)
    threshold = best if threshold is None else threshold
    columns = tuple(dict.fromkeys((id_col, *keep)))
    out = predict(docs, links, list(categories), text_col, columns)
    hit = (F.col(f"p_{decide}") >= threshold) if links else F.lit(False)
    return out.select(*columns, folds.held_out(id_col).alias("held_out"), *[f"p_{x}" for x in categories],
                      F.col(f"p_{decide}").alias("score"), hit.cast("int").alias("predicted"))
