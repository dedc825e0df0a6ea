"""The stored session table (I4 at ingest): what connection lines say, one narrow row per
backend, hour and distinct session.

``write_session_spans`` reduces the connection lines of a batch or micro-batch with map-side combine and
appends them, partitioned by date; it reads nothing back. Rows of several batches add
up, since every reader takes extremes. ``sessions_at`` gives exactly what ``session_info`` derives from the
log: the lines of a row are alike, so some line of it lies within a lookback if its newest does.
A backend that reconnects a million times in an hour is one row.

The table is an input of detectors (``sessions=sessions_at(...)``) and of the feed
(``anomalies_union(..., spans=...)``), which then read no connection line.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.config import path_exists, remove_matching
from auditlens.functions.text import is_not_empty
from auditlens.functions.timefn import TS, resolve_as_of, seconds, within
from auditlens.operators.sessions import CONN_TERMS_ALL, CONN_TERMS_AUTHORIZED, KEYS
from auditlens.sources.parsed import stored

FIELDS = ("User", "Database", "SourceHost")


#: Times are stored as ``timestamp``, whatever type the log's have (UTC sessions).
SPAN_SCHEMA = T.StructType([
    T.StructField("processId", T.LongType()), T.StructField("LogicalServerName", T.StringType()),
    T.StructField("Hour", T.TimestampType()), T.StructField("Authorized", T.BooleanType()),
    *[T.StructField(f, T.StringType()) for f in FIELDS], T.StructField("FirstSeen", T.TimestampType()),
    T.StructField("LastSeen", T.TimestampType()), T.StructField("Connections", T.LongType()),
    T.StructField("session_date", T.DateType())])


def session_spans(log: DataFrame) -> DataFrame:
    """Backend, Hour, Authorized, User, Database, SourceHost; FirstSeen, LastSeen, Connections, session_date.

    Connection lines that name no user take no part. Lines without a time keep NULL times.
    """
    at = F.col(TS).cast("timestamp")
    conn = log.where(stored(log, "is_conn")).select(
        *KEYS, at.alias("at"), F.date_trunc("hour", at).alias("Hour"),
        stored(log, "is_conn_auth").alias("Authorized"), stored(log, "p_user").alias("User"),
        stored(log, "p_database").alias("Database"), stored(log, "p_host").alias("SourceHost"))
    out = conn.where(is_not_empty("User")).groupBy(*KEYS, "Hour", "Authorized", *FIELDS).agg(
        F.min("at").alias("FirstSeen"), F.max("at").alias("LastSeen"), F.count(F.lit(1)).alias("Connections"))
    return out.withColumn("session_date", F.to_date("Hour"))


def write_session_spans(log: DataFrame, path: str, batch: str | None = None) -> None:
    """Append the sessions of ``log``. ``batch`` names the files: what an interrupted attempt of
    the same batch has left is removed first, so a retried append counts no connection twice."""
    if batch:
        remove_matching(log.sparkSession, f"{path}/session_date=*/{batch}-*")
    (session_spans(log).repartitionByRange("session_date", "LogicalServerName", "processId").write.mode("append")
     .option("mapreduce.output.basename", batch or "part").partitionBy("session_date").parquet(path))


def read_session_spans(spark: SparkSession, path: str) -> DataFrame:
    """The stored table; empty before the first write."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], SPAN_SCHEMA)
    return spark.read.schema(SPAN_SCHEMA).parquet(path)


def _reached(spans: DataFrame, as_of, lookback) -> DataFrame:
    """Rows that reach into the lookback; whole dates before it are not read."""
    out = spans.where(within(spans, as_of, lookback, "LastSeen"))
    if lookback is not None and as_of is not None and not isinstance(as_of, Column):
        out = out.where(F.col("session_date") >= F.lit((as_of - dt.timedelta(seconds=seconds(lookback))).date()))
    return out


def sessions_at(spans: DataFrame, as_of=None, lookback: str | None = "24h", terms=CONN_TERMS_ALL,
                fields=FIELDS) -> DataFrame:
    """``session_info`` from the stored table: one row per backend.

    With a lookback, ``as_of`` is the log's "now"; None is the newest connection, which may be
    older than the newest line.
    """
    if lookback is not None:
        as_of = resolve_as_of(spans, as_of, "LastSeen")
    rows = _reached(spans, as_of, lookback)
    if tuple(terms) == CONN_TERMS_AUTHORIZED:
        rows = rows.where("Authorized")
    elif tuple(terms) != CONN_TERMS_ALL:
        raise ValueError("the table tells authorized connections from all, no other terms")
    return rows.groupBy(*KEYS).agg(*[F.max(f).alias(f) for f in fields])


def feed_sessions_at(spans: DataFrame, as_of, lookback, auth_lookback) -> DataFrame:
    """The feed's lookup from the stored table: a backend's session, and its user by authorized connections."""
    reach = (lookback, auth_lookback)
    rows = _reached(spans, as_of, None if None in reach else max(reach, key=seconds))
    in_any, in_auth = (within(spans, as_of, span, "LastSeen") for span in reach)
    return rows.groupBy(*KEYS).agg(*[F.max(F.when(in_any, F.col(f))).alias(f) for f in FIELDS],
                                   F.max(F.when(in_auth & F.col("Authorized"), F.col("User"))).alias("AuthUser"))
