import itertools
import math
import re
from collections import Counter
from fractions import Fraction

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF_SMALL
from tests.oracle_check import rows_of
from tidemark.llm import filteraudit, queries

COLS = ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failed(rows):
    """(doc_id, text, lang) rows -> the set of filters that each fails."""
    ids = {}
    for i, t, _ in rows:
        if i is not None:
            ids[t or ""] = min(i, ids.get(t or "", i))
    out = []
    for i, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > ids[t]}
        out.append({f for f, x in fails.items() if x})
    return out


def plain(rows, labels):
    """Every order walked document by document."""
    good, toxic = ({i for i, *m in labels if i is not None and m[k] == 1} for k in (0, 1))
    docs = [(lang or "", f, i in good, i in toxic) for (i, _, lang), f in zip(rows, failed(rows))]
    out, sums = [], Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for k, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                before = len(left)
                left = [d for d in left if f not in d[1]]
                sums[part, f] += len(gone)
                out.append([part, order, k, f, len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                            sum(d[2] for d in gone), sum(d[3] for d in gone)])
                assert before == len(left) + len(gone)
    return sorted((*r, sums[r[0], r[3]]) for r in out)


def run(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, lang string, part int, failed int")
    marks = spark.createDataFrame([(*r, 0) for r in labels], "doc_id long, quality int, toxic int, id int")
    return filteraudit.audit_documents(docs, marks)


def test_cases_against_plain(spark):
    words = " ".join(f"w{i}" for i in range(100))
    rows = [(1, words, "en"), (2, words, "en"), (3, words, "de"), (2, words, "en"), (4, None, None), (5, "", "en"), (None, "", "en"), (None, words, "en"),
            (6, words + " $", "en"), (7, "ABC " * 120, "en"), (8, "W w " * 60, ""), (9, words.upper(), "de"), (10, "a " * 60000, "de"),
            (11, "\t" + words.replace(" ", "\r\n") + " x\n", "en"), (12, words[:-1] + " é" * 3 + " 100%", "en"), (0, "only here", "fr"), (13, "only here", "en")]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (7, 0, 1), (9, 1, 1), (99, 1, 1), (None, 1, 1), (5, None, None), (13, 1, 0)]
    got = sorted(map(tuple, run(spark, rows, labels).select(*COLS).collect()))
    assert got == plain(rows, labels) and len(got) == 4 * 600
    assert run(spark, [], labels).collect() == []
    assert run(spark, rows[:1], []).count() == 600


@settings(max_examples=30, deadline=None)
@given(st.integers(2, 5).flatmap(lambda n: st.tuples(st.just(n), st.lists(st.integers(0, 50), min_size=2**n, max_size=2**n))))
def test_weights_are_shapley(case):
    """Any removals: the least-squares solution is the average over all orders."""
    n, v = case
    v[0] = 0
    weights = filteraudit.shapley_weights(n)
    for f in range(n):
        total = 0
        for order in itertools.permutations(range(n)):
            before = sum(1 << g for g in order[: order.index(f)])
            total += v[before | 1 << f] - v[before]
        assert sum(w * x for w, x in zip(weights[f], v)) == Fraction(total, math.factorial(n))


def test_query_equals_its_sql(spark):
    out = queries.op13_filteraudit(spark, SF_SMALL)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(queries.ORACLE["op13_filteraudit"])
    assert rows_of(out.columns, [tuple(r) for r in out.collect()]) == rows_of([c[0] for c in want.description], want.fetchall())
