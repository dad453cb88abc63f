"""Language identification by word-first backoff.

A word known from the training texts is scored by its log frequency in each
language. An unseen word falls back to its character n-grams, longest first:
the first length of which any gram is known decides, by the mean log
frequency of those grams.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import folds
from tidemark.llm.store import Shared, stored

WORD = re.compile(r"[^\W\d_]+")
#: Distinct text parts a task keeps scores of.
TABLE = 400_000
COUNTS = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("gram", pa.string()), ("count", pa.int64())])


def words_of(text: str) -> list[str]:
    """The runs of letters; numerals like a half or a Roman eight are no letters."""
    found = WORD.findall(text)
    if all(map(str.isalpha, found)):
        return found
    return [w for f in found for w in "".join(c if c.isalpha() else " " for c in f).split()]


def grams(word: str, n: int) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + n] for i in range(len(w) - n + 1)]


def gram_counts(docs: DataFrame, longest: int) -> DataFrame:
    """``docs`` (lang, text) -> (lang, n, gram, count): words as n = 0, then character n-grams."""

    def each(batches):
        for b in batches:
            words = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                words.setdefault(lang, Counter()).update(words_of((text or "").lower()))
            for lang, own in words.items():
                for n in range(longest + 1):
                    many = own if n == 0 else Counter()
                    if n:
                        for w, c in own.items():
                            for g in grams(w, n):
                                many[g] += c
                    size = len(many)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * size, pa.string()), pa.array([n] * size, pa.int32()), pa.array(list(many), pa.string()),
                         pa.array(list(many.values()), pa.int64())], ["lang", "n", "gram", "count"])

    found = docs.select("lang", "text").mapInArrow(each, "lang string, n int, gram string, count bigint")
    return found.groupBy("lang", "n", "gram").agg(F.sum("count").alias("count"))


class Model:
    """Log frequencies by n (0: words): gram -> row of a (grams, languages) matrix."""

    def __init__(self, rows, longest: int):
        rows = pa.Table.from_pylist(rows, COUNTS) if isinstance(rows, list) else rows
        self.langs = sorted(rows["lang"].unique().to_pylist())
        self.longest, self.tables = longest, []
        for n in range(longest + 1):
            own = rows.filter(pc.equal(rows["n"], n)).combine_chunks()
            kinds = own["gram"].unique()
            index = {g: i for i, g in enumerate(kinds.to_pylist())}
            count = np.zeros((len(index), len(self.langs)))
            at = pc.index_in(own["gram"], kinds).to_numpy(), pc.index_in(own["lang"], pa.array(self.langs, pa.string())).to_numpy()
            count[at] = own["count"].to_numpy()
            smooth = np.log((count + 0.5) / (count.sum(axis=0) + 0.5 * (len(index) + 1)))
            self.tables.append((index, smooth))

    def word(self, w: str) -> np.ndarray:
        index, logs = self.tables[0]
        if w in index:
            return logs[index[w]]
        for n in range(self.longest, 0, -1):
            index, logs = self.tables[n]
            known = [index[g] for g in grams(w, n) if g in index]
            if known:
                return logs[known].mean(axis=0)
        return np.zeros(len(self.langs))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = 20_000, longest: int = 4) -> Model:
    """Fit on about ``sample_rows`` labelled rows outside the held-out fold.

    Every word and n-gram of these rows is kept with its count in every
    language; the sample alone bounds the model's size.
    """
    known = docs.where(~folds.held_out(id_col) & F.col(lang_col).isNotNull())
    known = folds.bounded_sample(known.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")), "id", sample_rows)
    counts = stored(gram_counts(known, longest), "langid-counts")
    return Model(counts.select("lang", "n", "gram", "count").toArrow(), longest)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text; ``score`` is the posterior of the
    predicted language under equal priors."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = Shared(docs, model)

    def each(batches):
        model, known = shared.get(), {}
        none = np.zeros(len(model.langs))
        for b in batches:
            langs, scores = [], []
            for text in b.column("text").to_pylist():
                total, letters = none.copy(), False
                parts = Counter((text or "").lower().split())
                if len(known) > TABLE:
                    known.clear()
                for p in parts:
                    if p not in known:
                        words = words_of(p)
                        known[p] = sum((model.word(w) for w in words), none) if words else None
                rows = [(known[p], c) for p, c in parts.items() if known[p] is not None]
                if rows and model.langs:
                    total = np.array([c for _, c in rows], float) @ np.array([r for r, _ in rows])
                    letters = True
                if not letters:
                    langs.append("und"), scores.append(0.0)
                    continue
                best = int(total.argmax())
                langs.append(model.langs[best]), scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["id", "lang_pred", "score"])

    return src.mapInArrow(each, f"id {src.schema['id'].dataType.simpleString()}, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **fit) -> DataFrame:
    """(id_col, held_out, lang_pred, score): one row per input row.

    Defined cases: a null text, or one without letters, is ``und`` with score
    0, and so is every text if nothing could be learned from. A null id is
    never learned from and counts as held out. Ties go to the language first
    in the alphabet. Repeated rows are predicted alike. Only the three named
    columns are read, and the predictions see the text alone.
    """
    out = predict(docs, learn(docs, id_col, text_col, lang_col, **fit), id_col, text_col)
    return out.select(F.col("id").alias(id_col), folds.held_out("id").alias("held_out"), "lang_pred", "score")
