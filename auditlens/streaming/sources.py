"""Streaming bronze source (I1): JSON or Parquet log records as a stream.

The reference ingests JSON records from an event hub. Here any file-based
landing folder (or a Kafka topic, when the connector is on the classpath)
becomes a streaming DataFrame with the fixed bronze schema. The event
time is cast to ``timestamp`` because watermarks need it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.config import apply_engine_conf
from auditlens.operators.session_table import write_session_spans
from auditlens.sources.bronze import BRONZE_SCHEMA, TS, normalize_bronze, write_bronze


def _with_event_time(df: DataFrame) -> DataFrame:
    return normalize_bronze(df).withColumn(TS, F.col(TS).cast("timestamp"))


def bronze_stream(spark: SparkSession, path: str, *, fmt: str = "json", schema: T.StructType | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of bronze rows from files landing under ``path``."""
    apply_engine_conf(spark)
    if schema is None:
        schema = BRONZE_SCHEMA if fmt == "json" else spark.read.format(fmt).load(path).schema
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _with_event_time(r.load(path))


def bronze_from_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Stream of bronze rows from JSON values on a Kafka topic (needs the
    spark-sql-kafka package on the classpath)."""
    apply_engine_conf(spark)
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).load())
    rec = raw.select(F.from_json(F.col("value").cast("string"), BRONZE_SCHEMA).alias("r")).select("r.*")
    return _with_event_time(rec)


#: Category of rows that only move the event time on; every query's filter leaves them out.
HEARTBEAT = "Heartbeat"


def write_heartbeat(spark: SparkSession, path: str, at: dt.datetime, *, fmt: str = "json") -> None:
    """Land one row without content, of time ``at``. A source that falls silent holds back its
    last windows; a heartbeat lets the watermark pass them (all filters sit above it)."""
    # a backend of its own, so that no join condition takes the row out below a watermark
    row = [(at, "", "LOG", "00000", -1, "", HEARTBEAT, HEARTBEAT)]
    df = spark.createDataFrame(row, BRONZE_SCHEMA)
    if fmt != "json":
        df = df.withColumn(TS, F.col(TS).cast("timestamp_ntz"))
    df.coalesce(1).write.mode("append").format(fmt).save(path)


def write_bronze_stream(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                        name: str = "stream", sessions: str | None = None):
    """Land the stream in a bronze table, by the batch writer.

    Every micro-batch goes through :func:`write_bronze`, so history and stream
    share one table with flags, clustering and date partitions, and no sink
    log hides the files of either. A micro-batch that is run again replaces
    its own files (``name`` tells streams into one table apart). ``sessions``
    is the path of a session table to keep up with the log.
    """
    def land(batch: DataFrame, epoch: int) -> None:
        write_bronze(batch, path, batch=f"{name}-{epoch:012d}")
        if sessions is not None:
            write_session_spans(batch, sessions, batch=f"{name}-{epoch:012d}")

    w = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(**(trigger or {"processingTime": "5 seconds"}))
    return w.start()
