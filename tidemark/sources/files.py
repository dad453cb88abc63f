"""File and table sources with declared schemas (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators.materialize import materialize
from tidemark.operators.observed import observe


def read_crime(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: header CSV of incidents with the fixed schema.

    Timestamp text in the date column keeps its date part; unparsable
    values become NULL (Spark's CSV reader in PERMISSIVE mode).
    """
    return spark.read.schema(schemas.CRIME).option("header", True).csv(path)


def read_incident_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """SRC-1 with every line accounted for: the typed columns and ``rejected``,
    the text of a line that has not the declared number of fields (else NULL).

    Fields are read as text and cast one by one: a value that does not fit is
    NULL in a good line (an undated incident keeps its place, Q28).
    """
    text = schemas.CRIME.fieldNames()
    lines = T.StructType([T.StructField(c, T.StringType()) for c in (*text, "rejected")])
    rows = (spark.read.schema(lines).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "rejected").csv(list(paths)))
    typed = [(F.substring(f.name, 1, 10) if f.dataType == T.DateType() else F.col(f.name)).try_cast(f.dataType).alias(f.name)
             for f in schemas.CRIME.fields]
    return rows.select(*typed, "rejected")


def land_incidents(spark: SparkSession, *paths: str) -> tuple[DataFrame, DataFrame, Observation]:
    """SRC-1 in one pass over the files: good incidents, rejected lines
    (INCIDENT_NUMBER as far as it was read, line), and how many of each there were.

    The parsed lines are stored once; both results read the stored table.
    """
    lines, seen = observe(read_incident_lines(spark, *paths), "incidents", {
        "lines": F.lit(True), "rejected": F.col("rejected").isNotNull(),
        "no_date": F.col("rejected").isNull() & F.col("OCCURRED_ON_DATE").isNull()})
    stored = materialize(lines, "incidents")
    good = stored.filter(F.col("rejected").isNull()).drop("rejected")
    return good, stored.filter(F.col("rejected").isNotNull()).select("INCIDENT_NUMBER", F.col("rejected").alias("line")), seen


def read_offense_codes(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: header CSV lookup of offense codes."""
    return spark.read.schema(schemas.OFFENSE_CODES).option("header", True).csv(path)


def read_weblog(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4 (batch twin): headerless weblog CSV, four text columns.

    A header line, if present, is read as an ordinary event (Q14); the
    parser tags it instead of dropping it.
    """
    return spark.read.schema(schemas.WEBLOG).option("header", False).csv(path)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON documents as one text column ``value`` (parsed later by
    ``from_json`` with a declared schema, so malformed lines become NULL)."""
    return spark.read.text(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               options: dict[str, str] | None = None) -> DataFrame:
    """SRC-3 / SRC-9: a relational table.

    Parquet by default. For a database pass ``fmt="jdbc"`` plus the usual
    options (``url``, ``dbtable``, ``partitionColumn``, ``lowerBound``,
    ``upperBound``, ``numPartitions``) so the scan is split into parallel
    range reads; filters and column selection are still pushed down.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    return reader.load(path) if path else reader.load()


def periods_frame(spark: SparkSession, periods) -> DataFrame:
    """SRC-10: a small reporting-period dimension built in memory.

    ``periods`` is a list of ``(period_id, label, lo, hi, lo_inclusive)``;
    ``lo`` and ``hi`` may be None for an open bound.
    """
    rows = [(int(p[0]), str(p[1]), p[2], p[3], bool(p[4]) if len(p) > 4 else True) for p in periods]
    return spark.createDataFrame(
        rows, "period_id int, period string, lo date, hi date, lo_inclusive boolean")


def parse_json(df: DataFrame, schema, column: str = "value") -> DataFrame:
    """Parse a JSON text column into the declared struct columns."""
    return df.select(F.from_json(F.col(column), schema).alias("doc")).select("doc.*")
