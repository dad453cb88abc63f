"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: zone-less business time, AQE for runtime
# re-planning (coalescing, skew splits, size-checked broadcast), ANSI left on
# so bad input fails loudly unless an operator uses an explicit try_* form.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of a finished stage are removed once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the library's settings.

    On a cluster ``master`` stays ``None`` so spark-submit decides. Locally
    (tests, bench) pass ``local[N]``; shuffle partitions then default to N.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions is None and master and master.startswith("local["):
        n = master[len("local["):-1]
        shuffle_partitions = int(n) if n.isdigit() else os.cpu_count() or 8
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    use_local_folder(spark)
    return spark


class NoSharedFolder(RuntimeError):
    """No folder is named that driver and executors share."""


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised stages.

    A cluster names it in ``spark.checkpoint.dir`` (a shared filesystem such
    as HDFS or an object store). A folder set on the context, e.g. by
    ``use_local_folder`` in tests, is used as it is. Without either this
    fails: stages in a machine-local folder would be lost to other machines.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no SparkContext
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that all machines share") from None
        return named
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        raise NoSharedFolder("set spark.checkpoint.dir to a folder that all machines share")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def use_local_folder(spark: SparkSession) -> None:
    """Give a one-machine session (``local[...]``) without a named folder one
    of its own, for tests and benchmarks; other sessions stay as they are."""
    sc = spark.sparkContext
    if sc.master.startswith("local") and not sc.master.startswith("local-cluster") and not (
            sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
