"""The raw log table ("bronze"): schema, normalisation, readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.config import apply_engine_conf, path_exists, remove_matching
from auditlens.sources.parsed import EXPRESSIONS, FLAGS, MARKER, with_parsed

TS = "EventProcessedUtcTime"

BRONZE_SCHEMA = T.StructType([
    T.StructField("EventProcessedUtcTime", T.TimestampType()),
    T.StructField("message", T.StringType()),
    T.StructField("errorLevel", T.StringType()),
    T.StructField("sqlerrcode", T.StringType()),
    T.StructField("processId", T.LongType()),
    T.StructField("backend_type", T.StringType()),
    T.StructField("LogicalServerName", T.StringType()),
    T.StructField("category", T.StringType()),
])

STRING_COLS = ("message", "errorLevel", "sqlerrcode", "backend_type",
               "LogicalServerName", "category")
BRONZE_COLS = tuple(f.name for f in BRONZE_SCHEMA.fields)
CATEGORY = "PostgreSQLLogs"


def normalize_bronze(df: DataFrame) -> DataFrame:
    """Apply the emptiness rule once: every string column NULL -> ''.

    The event time keeps its type (timestamp or timestamp_ntz); streaming
    callers cast to ``timestamp`` before setting a watermark. A stored
    table's ``event_date`` partition column is kept so time filters can
    prune partitions (see ``timefn.since``).
    """
    cols = []
    for f in BRONZE_SCHEMA.fields:
        if f.name in STRING_COLS:
            cols.append(F.coalesce(F.col(f.name).cast("string"), F.lit("")).alias(f.name))
        elif f.name == "processId":
            cols.append(F.col(f.name).cast("long").alias(f.name))
        else:
            cols.append(F.col(f.name))
    for c in ("event_date", *FLAGS):
        if c in df.columns:
            cols.append(F.col(c))
    return df.select(*cols)


def with_event_date(df: DataFrame) -> DataFrame:
    """Partition column for a stored bronze table: the UTC event date."""
    return df.withColumn("event_date", F.to_date(F.col(TS)))


# Stored beside the raw columns: the partition column and the parsed log.
STORED_EXTRA = ("event_date", *EXPRESSIONS)


def with_flags(df: DataFrame) -> DataFrame:
    """The line-kind flags. Each is exactly the predicate the queries use."""
    return df.withColumns({n: e() for n, e in FLAGS.items()})


def write_bronze(df: DataFrame, path: str, mode: str = "append",
                 max_records_per_file: int = 5_000_000, batch: str | None = None) -> None:
    """Store bronze, parsed (``sources/parsed.py``), as Parquet partitioned by event date.

    Time-window queries then prune whole partitions. Rows are range-
    partitioned on (date, line kind, server, time): one day -- or one server
    holding a third of a day -- is spread over many tasks instead of one;
    pgaudit, connection and error lines land in separate files, so a
    session lookup or an error scan skips the other kinds' row groups via
    the stored flags; and within a kind each file covers a narrow
    server/time range for min/max skipping. Files are capped in rows.

    ``batch`` names the files of one append; an earlier, interrupted attempt
    of the same batch is removed first, so a retried append adds no row twice.
    """
    spark = df.sparkSession
    parse = True
    if path_exists(spark, path) and mode == "append":
        schema = spark.read.parquet(path).schema
        df = df.withColumn(TS, F.col(TS).cast(schema[TS].dataType))
        if MARKER not in schema.fieldNames():
            parse = False                   # an older table keeps its columns
    if batch:
        remove_matching(spark, f"{path}/event_date=*/{batch}-*")
    kind = (F.when(F.col("is_audit"), 0).when(F.col("is_conn"), 1).when(F.col("is_err"), 2)
            .otherwise(3).alias("__kind"))
    # the message fields come after the shuffle, which carries (and samples) the raw columns and flags
    placed = (with_flags(with_event_date(normalize_bronze(df).select(*BRONZE_COLS))).withColumn("__kind", kind)
              .repartitionByRange("event_date", "__kind", "LogicalServerName", TS)
              .sortWithinPartitions("event_date", "__kind", "LogicalServerName", TS).drop("__kind"))
    ((with_parsed(placed) if parse else placed).write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
     .option("mapreduce.output.basename", batch or "part")
     .partitionBy("event_date").parquet(path))


def read_bronze(spark: SparkSession, path: str, normalized: bool = False) -> DataFrame:
    """Read a stored bronze table (Parquet, optionally date-partitioned).

    ``normalized=True`` for tables written by :func:`write_bronze`, which
    stores rows already normalised: columns are then read as they are, so
    equality filters (category, backend type, codes) reach the Parquet scan
    as pushed filters instead of being hidden behind ``coalesce``.
    """
    apply_engine_conf(spark)
    df = spark.read.parquet(path)
    extra = [c for c in STORED_EXTRA if c in df.columns]
    if normalized:
        return df.select(*BRONZE_COLS, *extra)
    return normalize_bronze(df)


def read_bronze_json(spark: SparkSession, path: str) -> DataFrame:
    """Read exported JSON log records with the fixed schema (no inference)."""
    apply_engine_conf(spark)
    return normalize_bronze(spark.read.schema(BRONZE_SCHEMA).json(path))
