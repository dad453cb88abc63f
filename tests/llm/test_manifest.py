import hashlib

import duckdb
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.oracle_check import rows_of
from tidemark.llm import manifest, queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """Hashes -> (top, siblings before and after by level for each node)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = i // 16 * 16
            paths[k].append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 16])))
        at = [i // 16 for i in at]
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def plain(rows):
    """(doc_id, source, text) rows -> (doc_id, leaf, subroot, root, path) in any order."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    trees = []
    for name in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        own = sorted((((r[0] is not None, r[0] or 0), leaf(r), r[0]) for r in groups[name]))
        trees.append((own, *climb([x[1] for x in own])))
    root, upper = climb([t[1] for t in trees])
    return sorted([(x[2], x[1], top, root, p + up) for (own, top, paths), up in zip(trees, upper) for x, p in zip(own, paths)], key=repr)


def got(df):
    return sorted([(r.doc_id, r.leaf, r.subroot, r.root, [tuple(p) for p in r.path]) for r in df.collect()], key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, text string, grp string, h int")
    return manifest.manifest(df, ["doc_id", "source", "text"], group="source", order="doc_id",
                             altered={"text": manifest.lower_ascii(F.col("text"))}, alter=F.col("doc_id") % 2 == 0)


def test_trees_of_every_shape(spark):
    """Groups of 1, 16, 17, 256, 257 and 600 rows, in 20 and more groups, null names and values, repeated rows."""
    rows = [(1000 * g + i, f"s{g}", f"Text {i}") for g, n in enumerate((1, 16, 17, 256, 257, 600)) for i in range(n)]
    rows += [(50_000 + g, f"é{g}", None) for g in range(14)]
    rows += [(7, None, "Null source"), (None, None, "no id"), (8, "", "empty name"), (9, "Z", ""), (9, "Z", ""), (9, "Z", "twice"), (10, "Z", "long " * 50000)]
    out = run(spark, rows)
    assert got(out) == plain(rows)
    for r in out.withColumn("own", manifest.folded(F.col("leaf"), F.col("path"))).withColumn("proof", manifest.proof_hash(F.col("path"))).collect():
        assert r.own == r.root and r.proof == h(*(a + b for a, b in r.path))


def test_altered_rows_are_found(spark):
    rows = [(i, f"s{i % 3}", "UPPER" if i % 4 else "lower") for i in range(100)] + [(200, "s0", None)]
    out = run(spark, rows).withColumn("ok", manifest.folded(F.col("altered"), F.col("path")) == F.col("root"))
    bad = {r.doc_id for r in out.collect() if not r.ok}
    assert bad == {i for i, _, t in rows if i % 2 == 0 and t == "UPPER"}


def test_small_tables(spark):
    one = [(1, "a", "x")]
    assert got(run(spark, one)) == [(1, leaf(one[0]), leaf(one[0]), leaf(one[0]), [])] == plain(one)
    assert run(spark, []).collect() == []


def test_rows_alike_are_spread(spark):
    """A third of the rows being one row does not put them into one sorted piece."""
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, 5).otherwise(F.col("id")).alias("doc_id"), F.lit("a").alias("source"), F.lit("t").alias("text"))
    out = manifest.manifest(rows, ["doc_id", "source", "text"], group="source", order="doc_id")
    assert out.count() == 3000 and out.where(manifest.folded(F.col("leaf"), F.col("path")) == F.col("root")).count() == 3000
    same = spark.range(1000).select(F.lit("=a").alias("grp"), F.col("id").alias("row"))
    assert [r.i for r in manifest.numbered(same, ["row"]).orderBy("row").collect()] == list(range(1000))


def test_query_equals_its_sql(spark):
    out = queries.op12_manifest(spark, SF_SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    want = con.execute(queries.ORACLE["op12_manifest"])
    assert rows_of(out.columns, [tuple(r) for r in out.collect()]) == rows_of([c[0] for c in want.description], want.fetchall())
