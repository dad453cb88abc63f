"""Stage tables in the folder that driver and executors share."""

from __future__ import annotations

import pickle
import uuid
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame

from tidemark.session import checkpoint_dir


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once under the session's checkpoint folder and read it back.

    The lineage ends at the written files, so an executor lost later costs a
    re-read of some files instead of a new run of the stages above. ``options``
    are the writer's.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/llm-stages/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallelism(df: DataFrame) -> int:
    """The session's shuffle width: tasks to aim for when a number must be given."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class Shared:
    """A bounded value for all tasks. It travels by value, with the code of its
    class: a plain broadcast would need the package on every worker."""

    def __init__(self, df: DataFrame, value: Any):
        self.data = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self) -> Any:
        """The value, built anew: once per task."""
        return pickle.loads(self.data.value)
