"""Stream health: late rows, delays and batch times, counted instead of lost.

Stateful queries drop rows behind their watermark. Spark's own count of them
(``numRowsDroppedByWatermark``) is taken after partial aggregation, so it is a lower bound.
``start_health`` counts exactly, beside those queries, from the same stream: each micro-batch
is reduced to one row per server and appended. The watermark of a batch is the newest
event of all batches before it less the allowed delay, as for a stateful query, which
lets its state go in a batch of its own before new rows come.

``ProgressLog`` keeps what Spark reports of every query (rows in, rows dropped, batch time, state).
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from auditlens.config import committed_batches, path_exists
from auditlens.functions.timefn import TS, duration, seconds

SRV = "LogicalServerName"
HEALTH_SCHEMA = ("Batch long, ServerName string, Rows long, LateRows long, DroppedRows long, MaxDelaySeconds double, "
                 "OldestEvent timestamp, NewestEvent timestamp, Watermark timestamp, ProcessedAt timestamp")
PROGRESS_SCHEMA = ("Query string, RunId string, Batch long, StartedAt string, InputRows long, DroppedRows long, "
                   "StateRows long, BatchMs long, Watermark string")


def _at(micros: int | None) -> Column:
    return F.timestamp_micros(F.lit(micros).cast("long"))


def batch_health(batch: DataFrame, batch_id: int, newest_us: int | None, *, delay="10 minutes", bucket="5m") -> DataFrame:
    """One row per server: Rows, LateRows (behind the watermark), DroppedRows (in a window of ``bucket``
    that had ended by the watermark, so that its aggregation drops them) and MaxDelaySeconds (the
    longest that a late row lies behind the newest event). ``newest_us`` is the newest event of earlier batches, in
    microseconds; None (no such event): nothing is late. Rows without an event time are counted, never late.
    """
    mark = None if newest_us is None else newest_us - seconds(delay) * 1_000_000
    late = F.coalesce(F.col(TS) < _at(mark), F.lit(False))
    closed = F.coalesce(F.col("__end") <= _at(mark), F.lit(False))
    behind = (F.unix_micros(_at(newest_us)) - F.unix_micros(F.col(TS).cast("timestamp"))) / F.lit(1_000_000.0)
    # by arithmetic: a window column would leave out rows without an event time
    step = seconds(duration(bucket)) * 1_000_000
    us = F.unix_micros(F.col(TS).cast("timestamp"))
    df = batch.withColumn("__end", F.timestamp_micros(us - F.pmod(us, F.lit(step)) + F.lit(step)))
    return df.groupBy(F.col(SRV).alias("ServerName")).agg(
        F.count(F.lit(1)).alias("Rows"), F.count_if(late).alias("LateRows"), F.count_if(closed).alias("DroppedRows"),
        F.coalesce(F.max(F.when(late, behind)), F.lit(0.0)).alias("MaxDelaySeconds"),
        F.min(TS).alias("OldestEvent"), F.max(TS).alias("NewestEvent")).select(
        F.lit(batch_id).cast("long").alias("Batch"), "*", _at(mark).alias("Watermark"),
        F.current_timestamp().alias("ProcessedAt"))


def _newest_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The newest event of the batches before ``batch_id``: the last of them has it stored, in one row."""
    marks = f"{path}/newest"
    last = batch_id - 1 if path_exists(spark, f"{marks}/batch={batch_id - 1}/_SUCCESS") else None
    if last is None:            # the first batch, or a health table that has begun later
        last = max((b for b in committed_batches(spark, marks) if b < batch_id), default=None)
    if last is None:
        return None
    return spark.read.schema("newest_us long").parquet(f"{marks}/batch={last}").first()[0]


def start_health(stream: DataFrame, path: str, checkpoint: str, *, delay="10 minutes", bucket="5m",
                 trigger: dict | None = None):
    """Append every micro-batch's health to the table at ``path``.

    A batch that runs again replaces its own folder. The driver gets one number per batch; a
    batch is read once, and its newest event comes from the rows written.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _newest_before(spark, path, batch_id)
        rows = f"{path}/rows/batch={batch_id}"
        batch_health(batch, batch_id, before, delay=delay, bucket=bucket).coalesce(1).write.mode("overwrite").parquet(rows)
        newest = spark.read.schema(HEALTH_SCHEMA).parquet(rows).agg(F.unix_micros(F.max("NewestEvent")).alias("us"))
        newest.select(F.greatest("us", F.lit(before).cast("long")).alias("newest_us")).coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/newest/batch={batch_id}")

    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "1 minute"})).start()


def read_health(spark: SparkSession, path: str) -> DataFrame:
    """The health table; empty before the first batch."""
    if not path_exists(spark, f"{path}/rows"):
        return spark.createDataFrame([], HEALTH_SCHEMA)
    return spark.read.schema(HEALTH_SCHEMA).parquet(f"{path}/rows/batch=*")


def late_summary(health: DataFrame) -> DataFrame:
    """Per server: Batches, Rows, LateRows, DroppedRows, MaxDelaySeconds, NewestEvent and the
    share of rows dropped, in percent."""
    out = health.groupBy("ServerName").agg(
        F.count_distinct("Batch").alias("Batches"), *[F.sum(c).alias(c) for c in ("Rows", "LateRows", "DroppedRows")],
        F.max("MaxDelaySeconds").alias("MaxDelaySeconds"), F.max("NewestEvent").alias("NewestEvent"))
    return out.withColumn("DroppedPercent", F.round(F.try_divide(F.col("DroppedRows") * 100, F.col("Rows")), 2))


class ProgressLog(StreamingQueryListener):
    """Appends the progress of all queries of a session to a Parquet table: every ``every``
    batches, and when a query ends. Add it by ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        self.spark, self.path, self.every = spark, path, every
        self.rows, self.lock = [], threading.Lock()

    def flush(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        ops = p.stateOperators
        row = (p.name, str(p.runId), p.batchId, p.timestamp, p.numInputRows,
               sum(o.numRowsDroppedByWatermark for o in ops), sum(o.numRowsTotal for o in ops),
               p.durationMs.get("triggerExecution"), p.eventTime.get("watermark"))
        with self.lock:
            self.rows.append(row)
            full = len(self.rows) >= self.every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
