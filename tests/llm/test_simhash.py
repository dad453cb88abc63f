import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tests.llm import plain
from tidemark.llm import queries, simhash


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = plain.simhash_groups([tuple(r) for r in docs])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op2_simhash(spark, SF_SMALL).collect()}
    assert got == want


def test_defined_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(70_000))
    rows = [(3, None, "a"), (2, "", "b"), (5, " \t\n ", "c"), (7, "One two", None), (8, "oNE\ttwo", "d"), (9, "One two", "e"), (9, "One two", "e"),
            (None, "one two", "f"), (None, long, "g"), (11, "ÀÉ b c d", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_groups(df).collect()), key=str)
    print_of = lambda t: f"{plain.simhash(t):016x}"
    want = [(3, "0" * 16, 2), (2, "0" * 16, 2), (5, "0" * 16, 2), (7, print_of("one two"), 7), (8, print_of("one two"), 7), (9, print_of("one two"), 7),
            (9, print_of("one two"), 7), (None, print_of("one two"), 7), (None, print_of(long), None), (11, print_of("ÀÉ b c d"), 11)]
    assert got == sorted(want, key=str)
    assert simhash.simhash_groups(df.limit(0)).collect() == []


@pytest.mark.parametrize("chunk", [64, 4096, 1 << 19])
def test_meet_links_a_tight_ball(monkeypatch, chunk):
    """Whatever the chunk, links connect exactly the fingerprints within reach, about one per member and variant."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    center = rng.integers(0, 1 << 20, 3)
    fps = np.unique(np.array([int(c) ^ sum(1 << int(b) for b in rng.choice(20, rng.integers(0, 4), replace=False)) for c in center for _ in range(25)], np.uint64))
    found = simhash.meet(fps, np.zeros(len(fps), np.int64), 20, 2)
    pairs = {(int(a), int(b)) for us, vs in found for a, b in zip(us, vs)}
    assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
    nodes = [int(f) for f in fps]
    want = [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 4]
    assert plain.groups(nodes, pairs) == plain.groups(nodes, want)


def test_only_even_distances(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)
