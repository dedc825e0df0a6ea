"""Incremental maintenance of the metric tables.

The reference appends f(new rows) to each metric table on ingest, so a
bucket that spans two ingest batches yields two partial rows. Here each
table is a windowed aggregation with a watermark in append mode: a bucket
is emitted once, complete, when the watermark passes its end; rows later
than the watermark are dropped (Spark reports the count in the query
progress as ``numRowsDroppedByWatermark``). State lives in the state
store and is checkpointed, so a lost executor replays from the
checkpoint instead of losing buckets.

Distinct users are counted exactly by chaining two windowed aggregations;
``distinct="approx"`` uses HyperLogLog in one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.functions.timefn import TS, above_watermark, duration
from auditlens.operators.metrics import (ACTIVITY_COLS, ERROR_COLS, USER_COLS, activity_aggs, error_aggs,
                                         error_rows, set_or_append, user_aggs)
from auditlens.operators.sessions import join_sessions, session_info
from auditlens.functions import patterns as P
from auditlens.functions.text import contains, extract, is_not_empty
from auditlens.sources.bronze import CATEGORY


def activity_metrics_stream(stream: DataFrame, *, bucket="5m", watermark="10 minutes",
                            distinct: str = "exact") -> DataFrame:
    """Streaming activity metrics.

    ``distinct="exact"`` (default) chains two windowed aggregations: the
    first groups by (server, bucket, user) and counts every metric, the
    second re-buckets on ``window_time`` and sums, so UniqueUsers is the
    number of user groups -- exact, with state bounded by distinct users per
    bucket and no sets kept. ``distinct="approx"`` is one aggregation with
    HyperLogLog.
    """
    df = stream.withWatermark(TS, watermark).where(above_watermark(F.col("category") == CATEGORY))
    hod = F.hour(TS).cast("int").alias("HourOfDay")
    dow = (F.dayofweek(TS) - 1).cast("int").alias("DayOfWeek")
    srv = F.col("LogicalServerName").alias("ServerName")
    if distinct == "approx":
        agg = df.groupBy(srv, F.window(TS, duration(bucket)).alias("w"), hod, dow).agg(*activity_aggs("approx"))
        return agg.withColumn("Timestamp", F.col("w.start")).select(*ACTIVITY_COLS)
    per_user = activity_aggs(users=False)
    user = F.nullif(extract(P.USER_RE, "message"), F.lit("")).alias("u")
    a = df.groupBy(srv, F.window(TS, duration(bucket)).alias("w"), hod, dow, user).agg(*per_user)
    sums = [F.sum(c).cast("long").alias(c) for c in ACTIVITY_COLS[4:] if c != "UniqueUsers"]
    b = a.groupBy("ServerName", F.window(F.window_time("w"), duration(bucket)).alias("w2"), "HourOfDay",
                  "DayOfWeek").agg(*sums, F.count("u").alias("UniqueUsers"))
    return b.withColumn("Timestamp", F.col("w2.start")).select(*ACTIVITY_COLS)


def error_metrics_stream(stream: DataFrame, *, bucket="1m", watermark="10 minutes") -> DataFrame:
    df = error_rows(stream.withWatermark(TS, watermark), wrap=above_watermark)
    agg = df.groupBy(F.col("LogicalServerName").alias("ServerName"),
                     F.window(TS, duration(bucket)).alias("w")).agg(*error_aggs())
    return agg.withColumn("Timestamp", F.col("w.start")).select(*ERROR_COLS)


def user_metrics_stream(stream: DataFrame, sessions: DataFrame, *, bucket="1h",
                        watermark="10 minutes") -> DataFrame:
    """Stream-static join with a session lookup table.

    Spark re-evaluates the static side every micro-batch, so ``sessions``
    should be a stored, small table (e.g. ``sessions_from_table(...)``
    written or checkpointed once per refresh period), not a live
    aggregation over the log."""
    df = stream.withWatermark(TS, watermark).where(
        above_watermark((F.col("category") == CATEGORY) & contains("message", P.AUDIT_MARK)))
    df = join_sessions(df, sessions.where(is_not_empty("User")), "inner")
    agg = df.groupBy(F.col("User").alias("UserName"), F.col("LogicalServerName").alias("ServerName"),
                     F.window(TS, duration(bucket)).alias("w")).agg(*user_aggs())
    return agg.withColumn("Timestamp", F.col("w.start")).select(*USER_COLS)


def start_metric_stream(metrics: DataFrame, path: str, checkpoint: str, *, keys=("ServerName", "Timestamp"),
                        output_mode: str = "append", trigger: dict | None = None):
    """Keep a metric table up to date: each micro-batch replaces the rows of its
    keys (``set_or_append``), so backfill and stream share one table and a
    repeated micro-batch changes nothing. ``output_mode="update"`` (error and
    user metrics) also stores buckets that are still open."""
    def upsert(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            set_or_append(batch.sparkSession, batch, path, keys)

    w = metrics.writeStream.foreachBatch(upsert).outputMode(output_mode).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"processingTime": "1 minute"}))
    return w.start()


def sessions_from_table(bronze_table: DataFrame, as_of=None, lookback="24h") -> DataFrame:
    return session_info(bronze_table, as_of, lookback, fields=("User",))
