import hashlib
from collections import defaultdict

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import rows_of
from tidemark.llm import exactdedup, queries

COLS = ["id", "keep_id", "group_size", "kept"]


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(rows):
    """(id, text) rows -> the sorted rows that COLS should hold."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[fold(t)].append(i)
    out = []
    for ids in groups.values():
        ids.sort(key=lambda i: (i is not None, i))
        out += [(i, ids[-1], len(ids), k == len(ids) - 1) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


ROWS = [(1, "Same text"), (2, "same TEXT"), (3, "other"), (4, None), (5, ""), (6, "É É"), (7, "é é"), (7, "é é"), (None, "Lost"), (None, "lost"),
        (8, "w " * 60000), (9, "W " * 60000), (10, "w " * 60000 + "x"), (2, "same TEXT"), (11, " "), (3, "solo")]


def land(spark, folder, rows, files=3, mode="append"):
    df = spark.createDataFrame([(*r, "x", "f", "m") for r in rows], "doc_id long, text string, digest string, file string, _metadata string")
    df.repartition(files).write.mode(mode).parquet(folder)


def got(df):
    return sorted(map(tuple, df.select(*COLS).collect()), key=repr)


@pytest.mark.parametrize("digest_bytes", [32, 1, 0])
def test_cases_and_clashing_digests(spark, tmp_dir, digest_bytes):
    """With a digest of one byte, or none, most texts share one and only their full text tells them apart."""
    rows = ROWS + [(100 + i, f"Text {i % 70}") for i in range(200)]
    land(spark, f"{tmp_dir}/docs", rows)
    out = exactdedup.deduplicate(spark, f"{tmp_dir}/docs", digest_bytes=digest_bytes, files_per_batch=1)
    assert got(out) == plain(rows)


def test_state_grows_with_what_lands(spark, tmp_dir):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    land(spark, f"{tmp_dir}/docs", ROWS[:9])
    work = exactdedup.ExactDedup(spark, f"{tmp_dir}/docs", f"{tmp_dir}/state")
    work.ingest()
    assert got(work.groups()) == plain(ROWS[:9])
    work.ingest()  # nothing has landed
    assert got(work.groups()) == plain(ROWS[:9])
    land(spark, f"{tmp_dir}/docs", ROWS[9:])
    later = exactdedup.ExactDedup(spark, f"{tmp_dir}/docs", f"{tmp_dir}/state", files_per_batch=1)
    later.ingest()
    assert got(later.groups()) == plain(ROWS)
    # only groups that a batch touched were written again, and the session's store is as it was
    assert later.heads.changes().count() < 2 * len(ROWS)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_empty_table(spark, tmp_dir):
    land(spark, f"{tmp_dir}/docs", [], files=1)
    assert exactdedup.deduplicate(spark, f"{tmp_dir}/docs").collect() == []


def test_no_python_on_the_executors(spark, tmp_dir):
    land(spark, f"{tmp_dir}/docs", ROWS)
    plan = exactdedup.deduplicate(spark, f"{tmp_dir}/docs")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_query_equals_its_sql(spark):
    out = queries.op11_exactdedup(spark, SF_SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    want = con.execute(queries.ORACLE["op11_exactdedup"])
    assert rows_of(out.columns, [tuple(r) for r in out.collect()]) == rows_of([c[0] for c in want.description], want.fetchall())
    first = out.orderBy("doc_id").first()
    text = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where(f"doc_id = {first.doc_id}").first().text
    assert first.text_sha256 == hashlib.sha256(fold(text).encode()).hexdigest()
