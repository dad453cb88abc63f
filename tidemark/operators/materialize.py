"""Stage materialisation: cut lineage at stage boundaries.

A stage is written when a query that needs it is built, and its files stay
under the shared folder until that folder's own clean-up: results may be read
at any time after the call returns.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.session import checkpoint_dir


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Compute ``df`` once, store it, and continue from the stored table.

    The table is written as parquet under the session's checkpoint folder
    (``spark.checkpoint.dir``: a shared filesystem on a cluster), then read
    back. Later stages scan the stored files (with column pruning and
    filter pushdown) instead of re-running the lineage, and a lost executor
    costs a re-read, not a recomputation from the raw input. This is where
    the original pipeline keeps a database table between its jobs.

    Unlike an eager ``checkpoint()``, which runs the plan once to count and
    again to write, the plan runs exactly once.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tidemark-stages/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def materialize_by_key(df: DataFrame, name: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``materialize`` as a table bucketed and sorted by ``keys``: the rows move
    once, here, and joins and aggregates on these keys read the stored side where it lies.

    ``buckets`` defaults to the session's shuffle width, below which Spark
    would shuffle both sides anew. The files are under the shared folder, the
    table's name in the session's catalog.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"tidemark_{name}_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/tidemark-stages/{table}"
    (df.repartition(n, *keys).write.mode("errorifexists").format("parquet").option("path", path)
     .bucketBy(n, *keys).sortBy(*keys).saveAsTable(table))
    return spark.table(table)
