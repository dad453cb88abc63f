"""The pipeline against plain versions of its stages, and what an installation without it does."""

import os
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL
from tests.llm import plain
from tests.llm.test_packing import check
from tidemark.llm import linededup, queries
from tidemark.llm.store import stored

ROOT = Path(__file__).resolve().parents[2]


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in queries.op1_toxicity(spark, SF_SMALL).where("predicted = 1").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "line dedup", "near dedup", "packing"]
    step = dict(corpus_pipeline.STAGES)

    one = stored(step["toxicity"](spark, docs, SF_SMALL), "test")
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == set(texts) - toxic
    two = stored(step["quality"](spark, one, SF_SMALL), "test")
    kept = {r.doc_id: r.text for r in two.collect()}
    assert two.columns == docs.columns and set(kept) < set(texts) - toxic
    assert all(kept[i] == texts[i] for i in kept)

    three = stored(step["line dedup"](spark, two, SF_SMALL), "test")
    want = plain.drop_lines(list(kept.items()), 2, 20, linededup.GROW, 1)
    assert three.columns == docs.columns and {r.doc_id: (r.text, r.n_chars) for r in three.collect()} == {i: (t, len(t)) for i, t in want.items()}
    four = stored(step["near dedup"](spark, three, SF_SMALL), "test")
    group = plain.simhash_groups(list(want.items()))
    first = {i for i in want if group[i][1] == i}
    assert four.columns == docs.columns and {r.doc_id: r.text for r in four.collect()} == {i: want[i] for i in first}
    five = step["packing"](spark, four, SF_SMALL).collect()
    assert {r.doc_id for r in five} == first
    check(five, 2048)
    assert corpus_pipeline.run(spark, SF_SMALL).count() == len(five)


def test_odd_rows_pass_all_stages(spark):
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (1, "", "en", "s", 0), (2, "some good words here, as ever.", "en", "s", 1), (2, "some good words here, as ever.", "en", "s", 1)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema)
    for part in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, part, SF_SMALL), "test")
            assert name == "packing" or out.columns == docs.columns
            part = out


def test_documents_may_have_any_other_columns(spark):
    """Names that the classifiers use themselves."""
    odd = ["score", "held_out", "predicted", "p_junk", "p_toxic", "x", "raw", "_text", "n_lines", "fold"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs = docs.select("*", *[F.concat(F.lit(c), "doc_id").alias(c) for c in odd])
    for name, stage in corpus_pipeline.STAGES[:2]:
        docs = stored(stage(spark, docs, SF_SMALL), "test")
        assert docs.where("score <> concat('score', doc_id) or x <> concat('x', doc_id)").count() == 0 and docs.count() > 100
    assert set(odd) < set(docs.columns)


CODE = """
import sys
sys.path.insert(0, {root!r})     # on the driver's path only
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
def seen(_):
    import importlib.util
    return [importlib.util.find_spec("tidemark") is not None]
assert spark.sparkContext.parallelize([0], 1).mapPartitions(seen).collect() == [False]
for name, query in e.queries().items():
    if name.startswith("op"):
        assert query(spark, {data!r}).count() > 0, name
print("all ran")
"""


def test_workers_need_no_package(tmp_path):
    """All numbered queries with the package on the driver's path alone."""
    out = subprocess.run([sys.executable, "-c", CODE.format(root=str(ROOT), data=SF_SMALL)], cwd=tmp_path, capture_output=True, text=True, timeout=900,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable})
    assert "all ran" in out.stdout, out.stderr[-3000:]


def test_rest_works_without_this_part(tmp_path):
    for name in ("tidemark", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", str(ROOT / name), str(tmp_path / name)], check=True)
    (tmp_path / "tidemark" / "llm").rename(tmp_path / "away")
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [n for n in q if n.startswith('op') or n == 'pipeline']; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})
