"""Stage materialisation and the shared folder."""

import pytest

from tidemark.operators.materialize import materialize
from tidemark.session import NoSharedFolder, checkpoint_dir, use_local_folder


def test_materialize_reads_back_from_checkpoint_folder(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    m = materialize(df, "unit")
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan
    files = m.inputFiles()
    base = checkpoint_dir(spark).split(":", 1)[-1].rstrip("/")
    assert files and all(base in f and "/tidemark-stages/unit-" in f for f in files)
    assert sorted(tuple(r) for r in m.collect()) == sorted(tuple(r) for r in df.collect())


def test_checkpoint_folder_is_stable(spark):
    assert checkpoint_dir(spark) == checkpoint_dir(spark)


def test_no_silent_machine_local_folder(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://cluster:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(Conf)
        setCheckpointDir = staticmethod(lambda path: pytest.fail(f"a local folder was set: {path}"))

    class Session:
        sparkContext = Context

    use_local_folder(Session)
    with pytest.raises(NoSharedFolder):
        checkpoint_dir(Session)
