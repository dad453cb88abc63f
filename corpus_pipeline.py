"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared folder and reads it as the next stage's
documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import linededup, packing, quality, queries, simhash, toxicity
from tidemark.llm.store import stored


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic (operator 1)."""
    # names of their own, so that no column of the documents meets one of the classifier's
    own = {c: f"in_{k}" for k, c in enumerate(docs.columns)}
    rows, labels = docs.toDF(*own.values()), _labels(spark, sf_dir).withColumnRenamed("doc_id", own["doc_id"])
    out = toxicity.classify(rows, labels, queries.CATEGORIES, decide="toxic", threshold=queries.TOXIC_FROM,
                            id_col=own["doc_id"], text_col=own["text"], keep=tuple(own.values()))
    return out.where("predicted = 0").select(*[F.col(x).alias(c) for c, x in own.items()])


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3 (operator 8)."""
    # the score needs these columns only, whatever else the documents have
    rows = docs.withColumn("_row", linededup.row_id("doc_id", "text"))
    good = quality.score(rows.select("doc_id", "text", "_row"), _labels(spark, sf_dir), threshold=0.3, keep=("_row",)).where("predicted = 1")
    return rows.join(good.select("_row").distinct(), "_row", "left_semi").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that occur, equal or nearly so, before (operator 9), by the query's own rules."""
    out = linededup.deduplicate(docs, max_edits=2, min_chars=20, grow=linededup.GROW, copy_chars=1)
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-copy group: the one with the smallest id (operator 2)."""
    rows = docs.withColumn("_row", linededup.row_id("doc_id", "text"))
    groups = simhash.simhash_groups(rows.withColumn("_key", F.struct("doc_id", "_row")), id_col="_key", shingle_words=4, max_distance=4)
    first = groups.select(F.col("component_id._row").alias("_row")).distinct()
    return rows.join(first, "_row", "left_semi").dropDuplicates(["_row"]).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of the documents in sequences of 2048 tokens (operator 6)."""
    return packing.pack_documents(docs, queries.vocabulary("word_bpe_49k.json"), capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_copies),
    ("packing", pack),
]

#: SQL cannot express the trained and iterative stages; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
