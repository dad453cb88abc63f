"""Exact de-duplication of landed files by a stream with keyed state that never expires.

Two streams run over what has landed and stop:

1. each new file's rows are hashed once: identifier, digest of the normalised
   text, and the text's place (file and row in it) are appended to a table;
2. that table streams into a state keyed by digest, kept by Spark's RocksDB
   state store on the executors' disks with its changes in the shared folder.
   It holds the group's size and, of its largest identifier, the identifier
   and the place of the text. There is no watermark: a text seen once is known
   for ever. Both steps are combined per task before rows move, so a text that
   makes up much of the input is reduced where it is read.

A digest that was hit is a claim, not a proof: the texts of all its rows are
read again from their places and compared in full. Should different texts
share a digest, its rows are grouped by the texts themselves.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.store import stored
from tidemark.session import checkpoint_dir
from tidemark.sinks.tables import ChangeTable

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # many small stores: no disk is set aside for each one's logs
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())


@contextlib.contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _exactly(path: str) -> str:
    """A pattern for ``path`` alone: file streams take a single file only by a pattern."""
    if any(c in path for c in "*?{}[]"):
        return path
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/{{{name}}}"


class ExactDedup:
    """De-duplication of the Parquet files at ``source`` (file, folder or pattern) with its state in ``folder``.

    ``ingest`` takes in the files that have landed since the last call;
    ``groups`` returns a row per document seen so far. ``folder`` must be
    shared by all machines; a new object with the same one goes on from there.
    ``files_per_batch`` bounds a micro-batch. ``digest_bytes`` shortens the
    SHA-256 that keys the state; results do not depend on it.
    """

    def __init__(self, spark: SparkSession, source: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 files_per_batch: int | None = None, digest_bytes: int = 32):
        self.spark, self.source, self.folder = spark, _exactly(source), folder.rstrip("/")
        self.files_per_batch, self.digest_bytes = files_per_batch, digest_bytes
        # only these two columns are ever read, whatever else the files hold
        found = spark.read.parquet(source).schema
        self.schema = StructType([found[id_col], found[text_col]])
        self.id, self.text = F.col(id_col), F.col(text_col)
        kind = found[id_col].dataType.simpleString()
        self.row = f"id {kind}, digest binary, file string, row bigint"
        head = f"digest binary, size bigint, head struct<id: {kind}, file: string, row: bigint>"
        self.heads = ChangeTable(spark, f"{self.folder}/heads", StructType.fromDDL(head), ["digest"])
        # an empty batch makes the folder, so that reading needs no check
        spark.createDataFrame([], self.row).write.mode("overwrite").parquet(f"{self.folder}/landed/batch=-1")

    def _place(self) -> list[Column]:
        return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]

    def _stream(self, schema, path: str) -> DataFrame:
        reader = self.spark.readStream.schema(schema)
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        return reader.parquet(path)

    def ingest(self) -> None:
        """Take in all files that have landed; files seen before are not read again."""
        digest = F.substring(F.unhex(F.sha2(normalised(self.text), 256)), 1, self.digest_bytes)
        rows = self._stream(self.schema, self.source).select(self.id.alias("id"), digest.alias("digest"), *self._place())

        def append(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.folder}/landed/batch={batch_id}")

        rows.writeStream.foreachBatch(append).option("checkpointLocation", f"{self.folder}/landing").trigger(availableNow=True).start().awaitTermination()
        seen = self._stream(self.row, f"{self.folder}/landed").groupBy("digest").agg(
            F.count("*").alias("size"), F.max(F.struct("id", "file", "row")).alias("head"))

        def change(batch: DataFrame, batch_id: int) -> None:
            self.heads.append(batch, "state", batch_id, _dt.datetime(1970, 1, 1), check_unique=False)

        with _settings(self.spark, _STATE):
            seen.writeStream.outputMode("update").foreachBatch(change).option(
                "checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).start().awaitTermination()

    def landed(self) -> DataFrame:
        """(id, digest, file, row) of every row taken in."""
        return self.spark.read.schema(self.row).parquet(f"{self.folder}/landed").select("id", "digest", "file", "row")

    def groups(self) -> DataFrame:
        """(id, keep_id, group_size, kept, digest): one row per row taken in.

        Of rows with equal normalised texts the one with the largest id is
        kept, of those with that id the one with the last place.
        """
        # stored heads leave both sides of the join plain shuffles, which Spark splits where a digest has many rows
        named = self.landed().join(stored(self.heads.read(), "exact-heads"), "digest")
        own = F.struct("id", "file", "row")
        rows = stored(named.select("id", "digest", "file", "row", F.col("head.id").alias("keep_id"), F.col("size").alias("group_size"),
                                   (own.eqNullSafe(F.col("head"))).alias("kept")), "exact-rows")
        hits = rows.where("group_size > 1").select("id", "digest", "file", "row")
        texts = self.spark.read.schema(self.schema).parquet(self.source).select(*self._place(), self.text.alias("text"))
        bodies = hits.join(texts, ["file", "row"]).withColumn("body", normalised(F.col("text"))).drop("text")
        # the least and greatest of a digest's texts are equal only if all are
        spread = bodies.groupBy("digest").agg(F.min("body").alias("low"), F.max("body").alias("high"))
        mixed = stored(spread.where("low <> high").select("digest"), "exact-mixed")
        out = ["id", "keep_id", "group_size", "kept", "digest"]
        if mixed.isEmpty():
            return rows.select(*out)
        apart = bodies.join(mixed, "digest", "left_semi")
        heads = apart.groupBy("digest", "body").agg(F.count("*").alias("group_size"), F.max(own).alias("head"))
        again = apart.join(heads, ["digest", "body"]).select("*", F.col("head.id").alias("keep_id"), own.eqNullSafe(F.col("head")).alias("kept"))
        return rows.join(mixed, "digest", "left_anti").select(*out).unionByName(again.select(*out))


def deduplicate(spark: SparkSession, source: str, **options) -> DataFrame:
    """``ExactDedup`` over all files at ``source`` with a state of its own.

    Defined cases: a null text is empty and equals other empty ones; null ids
    count as smallest, so a group of null ids only has a null ``keep_id`` and
    one row kept; repeated rows (same id and text) are members each and one
    of them is kept; an empty table gives no rows; texts are read whole; other
    columns of the files, whatever their names, are not read.
    """
    folder = f"{checkpoint_dir(spark).rstrip('/')}/llm-stages/exact-{uuid.uuid4().hex}"
    work = ExactDedup(spark, source, folder, **options)
    work.ingest()
    return work.groups()
