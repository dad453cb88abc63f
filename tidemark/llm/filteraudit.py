"""What each filter of a chain removes, in every order of the filters.

A document's fate in any order follows from the set of filters that it fails.
So the documents are counted once, by part and failing set; from these counts
come the removals of every coalition of filters (a coalition removes what
fails any of its filters), and all else is differences of coalitions:

* the filter f after the filters S removes v(S + f) - v(S);
* the removals of f summed over all orders are n! times its Shapley value.
  The values are the exact solution of a constrained least-squares problem:
  coalition removals are fitted by sums of one number per filter, weighted by
  the Shapley kernel, and the numbers must add up to what all filters remove.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

_SPACE = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """The maximal runs of characters other than the six ASCII spaces."""
    return F.array_remove(F.split(text, _SPACE), "")


def solve(left: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """X with left X = right, by elimination in exact fractions; ``left`` is square and regular."""
    rows = [[*a, *b] for a, b in zip(left, right, strict=True)]
    size = len(rows)
    for k in range(size):
        p = next(r for r in range(k, size) if rows[r][k])
        rows[k], rows[p] = rows[p], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for r in range(size):
            if r != k and rows[r][k]:
                rows[r] = [x - rows[r][k] * y for x, y in zip(rows[r], rows[k], strict=True)]
    return [r[size:] for r in rows]


def shapley_weights(n: int) -> list[list[Fraction]]:
    """For each of n filters, the weight of every coalition's removal in its Shapley value.

    The solution is linear in the removals v, so the normal equations (with a
    multiplier for the constraint that the values add up to v(all)) are solved
    once, with one right side per coalition. Coalitions are bit masks.
    """
    full = (1 << n) - 1
    inner = [s for s in range(1, full)]
    size = {s: s.bit_count() for s in inner}
    kernel = {s: Fraction(n - 1, math.comb(n, size[s]) * size[s] * (n - size[s])) for s in inner}
    has = lambda s, i: s >> i & 1
    left = [[sum((kernel[s] for s in inner if has(s, i) and has(s, j)), Fraction(0)) for j in range(n)] + [Fraction(1)] for i in range(n)]
    left.append([Fraction(1)] * n + [Fraction(0)])
    right = [[kernel[s] if s in kernel and has(s, i) else Fraction(0) for s in range(full + 1)] for i in range(n)]
    right.append([Fraction(s == full) for s in range(full + 1)])
    return solve(left, right)[:n]


def count_failures(rows: DataFrame, fails: Mapping[str, Column], text: Column, repeat: str, id_col: Column, part: Column,
                   labels: DataFrame, label_id: str, marks: Mapping[str, Column]) -> DataFrame:
    """(part, failed, documents, and one count per mark): rows by the set of filters that they fail.

    ``failed`` has bit k for the k-th filter of ``fails``; after them comes
    the filter ``repeat``, failed by rows whose text equals that of any row
    with a smaller id. ``marks`` are conditions on ``labels``; a label of
    repeated ids marks if any of them does.

    Equal texts are found by their SHA-256. All other filters depend on the
    text alone, so the rows of one text differ in part, marks and id only and
    are counted before they meet: one text, part or id that holds much of the
    table is reduced where it is read.
    """
    bits = sum((F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(fails.values())), F.lit(0))
    slim = rows.select(id_col.alias("id"), part.alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), bits.alias("failed"))
    known = labels.where(F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("id")).agg(
        *[F.max(F.coalesce(c, F.lit(False))).alias(f"m_{name}") for name, c in marks.items()])
    names = [f"m_{name}" for name in marks]
    marked = slim.join(known, "id", "left").na.fill(False, names)
    kind = ["digest", "part", "failed", *names]
    per_id = marked.groupBy(*kind, "id").agg(F.count("*").alias("n"))
    groups = per_id.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min("id").alias("low"), F.min_by("n", "id").alias("at_low"))
    first = F.when(F.col("low") == F.min("low").over(W.Window.partitionBy("digest")), F.col("at_low")).otherwise(0)
    split = groups.withColumn("fresh", F.col("unnamed") + F.coalesce(first, F.lit(0)))
    again = F.col("failed") + F.lit(1 << len(fails))
    both = split.select("part", *names, F.explode(F.array(
        F.struct(F.col("failed").alias("failed"), F.col("fresh").alias("n")),
        F.struct(again.alias("failed"), (F.col("n") - F.col("fresh")).alias("n")))).alias("k"))
    return both.groupBy("part", F.col("k.failed").alias("failed")).agg(
        F.sum("k.n").alias("documents"),
        *[F.sum(F.when(F.col(c), F.col("k.n")).otherwise(0)).alias(c[2:]) for c in names])


def coalition_removals(counts: DataFrame, n: int, measures: list[str]) -> DataFrame:
    """(part, total, and per measure the array of its removals by coalition): the 2^n coalitions of each part."""
    coalition = F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1)))
    hit = (F.col("failed").bitwiseAND(F.col("coalition"))) != 0
    table = counts.withColumn("coalition", coalition).groupBy("part", "coalition").agg(
        F.sum("documents").alias("total"), *[F.sum(F.when(hit, F.col(m)).otherwise(0)).alias(m) for m in measures])
    gathered = table.groupBy("part").agg(F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("coalition", *measures))).alias("v"))
    return gathered.select("part", "total", *[F.col(f"v.{m}").alias(m) for m in measures])


def audit(counts: DataFrame, filters: str, marks: list[str]) -> DataFrame:
    """Every part's counts at each step of each order of the filters.

    ``counts`` as ``count_failures`` gives them, ``filters`` one character per
    filter. Returns part, filter_order, step, filter, kept, removed, redundant
    (failing, but removed before), unique_fails (failing this filter only),
    ``<mark>_lost`` (removed here and marked) and shapley (removed by this
    filter, summed over all orders). A part with rows has all n! * n rows.
    """
    n = len(filters)
    weights = [[w * math.factorial(n) for w in ws] for ws in shapley_weights(n)]
    if any(w.denominator != 1 for ws in weights for w in ws):
        raise ArithmeticError("the sum over all orders is not a whole number")
    per_part = coalition_removals(counts, n, ["documents", *marks])
    total = lambda ws: sum((F.col("documents")[s] * int(w) for s, w in enumerate(ws) if w), F.lit(0))
    per_part = per_part.withColumn("shapleys", F.array(*[total(ws).cast("bigint") for ws in weights]))
    orders = ["".join(p) for p in itertools.permutations(filters)]
    steps = per_part.withColumn("filter_order", F.explode(F.lit(orders))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    earlier, bit = F.expr("substring(filter_order, 1, step - 1)"), F.expr(f"instr('{filters}', substring(filter_order, step, 1)) - 1")
    before = sum((F.when(earlier.contains(f), F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(filters)), F.lit(0))
    steps = steps.select("*", F.expr("substring(filter_order, step, 1)").alias("filter"), bit.alias("k"), before.alias("before"))
    steps = steps.withColumn("own", F.expr("shiftleft(1, k)"))
    v = lambda m, s: F.element_at(F.col(m), s + 1)
    here = lambda m: v(m, F.col("before") + F.col("own")) - v(m, F.col("before"))
    everything = F.lit((1 << n) - 1)
    return steps.select(
        "part", "filter_order", "step", "filter",
        (F.col("total") - v("documents", F.col("before") + F.col("own"))).alias("kept"),
        here("documents").alias("removed"),
        (v("documents", F.col("own")) - here("documents")).alias("redundant"),
        (v("documents", everything) - v("documents", everything - F.col("own"))).alias("unique_fails"),
        *[here(m).alias(f"{m}_lost") for m in marks],
        F.element_at("shapleys", F.col("k") + 1).alias("shapley"))


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of five filters over ``docs`` (doc_id, text, lang) with ``labels`` (doc_id, quality, toxic).

    A: under 100 words. B: 100 * distinct words < 80 * words. C: over a tenth
    of the characters are A-Z. D: any of ``#$%&*|``. E: the text of a row with
    a smaller doc_id. Parts are the lang values.

    Defined cases: a null text is empty (it fails A; equal to other empty
    ones), a null lang is the empty string, a row with null doc_id has no
    label, never fails E and makes no other row fail it; rows of one doc_id
    count each and do not make each other fail E; a label row without doc_id
    is ignored; an empty table has no parts and gives no rows. Texts are read
    whole. Only the named columns are read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"), text.alias("text"), words(text).alias("words"))
    n, upper = F.size("words"), F.length("text") - F.length(F.translate("text", _UPPER, ""))
    fails = {"A": n < 100, "B": 100 * F.size(F.array_distinct("words")) < 80 * n,
             "C": 100 * upper > 10 * F.length("text"), "D": F.col("text").rlike(r"[#$%&*|]")}
    counts = count_failures(rows, fails, F.col("text"), "E", F.col("id"), F.col("part"), labels, "doc_id",
                            {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1})
    return audit(counts, "ABCDE", ["good", "toxic"])
