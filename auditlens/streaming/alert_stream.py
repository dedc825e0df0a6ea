"""Continuous alert evaluation.

The reference re-runs its alert queries every 2-5 minutes. Here the same
filtered inputs (``alerts.alert_inputs``) feed windowed aggregations with
a watermark; the exfiltration rule, which has no bin in the reference
("last 5 minutes, re-evaluated"), uses a sliding window of 5 minutes
every minute. Finished windows are joined with the rule table and
thresholded. Distinct schemas are counted exactly, by two chained aggregations.

The ML rule (``start_ml_alerts``) scores the closed 5-minute counts against a stored baseline
model; steps without any line count as zero, as in the batch series.

One burst passes the threshold in several windows. Three ways to route it once:
``alert_once_stream`` drops later alerts of a rule, key and burst in the stream
and emits as soon as the first window fires;
``alert_burst_stream`` emits a burst as one row with its span and peak when it is over (a
session window over the alerts); ``start_alert_sink`` stores every alert and marks with
``Fires`` the first of each burst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlens.config import committed_batches, path_exists
from auditlens.functions.text import is_not_empty
from auditlens.functions.timefn import TS, above_watermark, duration, seconds
from auditlens.operators.alerts import _group_key, alert_inputs, alert_rules, ml_candidates
from auditlens.operators.series import score_baseline
from auditlens.sources.bronze import CATEGORY

STREAM_WINDOWS = {"Data Exfil": (None, None), "Destruction": (None, "2m"), "Privilege": (None, "5m"),
                  "Error Spike": (None, "1m"), "Recon (Schema)": (None, "10m"), "Recon (Deep)": (None, "5m")}


def alert_candidates_stream(stream: DataFrame, *, watermark="10 minutes", windows: dict | None = None,
                            exfil_window=("5m", "1m")) -> DataFrame:
    """All rules in ONE stateful aggregation: each rule's rows are put in
    long form (rule, server, key, its own event-time window, value) and the
    union is grouped once, so the state store holds one operator instead of
    one per rule."""
    w = dict(STREAM_WINDOWS)
    w.update(windows or {})
    src = stream.withWatermark(TS, watermark)
    parts = []
    for rule, df, keys, bk, distinct in alert_inputs(src, windows=w, wrap=above_watermark):
        if bk is None:
            win = F.window(TS, duration(exfil_window[0]), duration(exfil_window[1]))
        else:
            win = F.window(TS, duration(bk))
        val = F.lit(None).cast("string") if distinct is None else F.col(distinct).cast("string")
        parts.append(df.select(F.lit(rule).alias("RuleName"), F.col("LogicalServerName").alias("ServerName"),
                               _group_key(keys).alias("GroupKey"), win.alias("win"), val.alias("val"), TS))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    # by value first, so that distinct values are groups and not a sketch; rules that count have one value
    values = rows.groupBy("RuleName", "ServerName", "GroupKey", "win", "val").agg(
        F.count(F.lit(1)).alias("n"), F.max(TS).alias("last"))
    agg = values.groupBy("RuleName", "ServerName", "GroupKey", "win").agg(
        F.sum("n").alias("n"), F.count("val").alias("dn"), F.max("last").alias("TimeGenerated"))
    metric = F.when(F.col("RuleName") == "Recon (Schema)", F.col("dn")).otherwise(F.col("n"))
    return agg.select("RuleName", "ServerName", "GroupKey", F.col("win.start").alias("WindowStart"),
                      metric.cast("double").alias("MetricValue"), "TimeGenerated", "win")


def activity_count_stream(stream: DataFrame, *, step="5m", watermark="10 minutes") -> DataFrame:
    """(ServerName, Timestamp, v): log lines per server and step, closed steps only."""
    df = stream.withWatermark(TS, watermark).where(above_watermark(
        (F.col("category") == CATEGORY) & is_not_empty("LogicalServerName")))
    agg = df.groupBy(F.col("LogicalServerName").alias("ServerName"), F.window(TS, duration(step)).alias("w")).agg(
        F.count(F.lit(1)).alias("v"))
    return agg.select("ServerName", F.col("w.start").alias("Timestamp"), "v")


def dense_steps(rows: DataFrame, last: DataFrame | None, step="5m") -> DataFrame:
    """(ServerName, Timestamp, v) with a zero for every step without lines between a row and the one
    before it, which is a row here or the server's last step in ``last`` (ServerName, last_step)."""
    before = F.lag("Timestamp").over(Window.partitionBy("ServerName").orderBy("Timestamp"))
    rows = rows.withColumn("before", before)
    if last is not None:
        rows = rows.join(last, "ServerName", "left").withColumn("before", F.coalesce("before", "last_step"))
    each = F.expr(f"INTERVAL {seconds(step)} SECONDS")
    steps = F.sequence(F.coalesce(F.col("before") + each, F.col("Timestamp")), F.col("Timestamp"), each)
    rows = rows.withColumn("at", F.explode(steps))
    return rows.select("ServerName", F.col("at").alias("Timestamp"),
                       F.when(F.col("at") == F.col("Timestamp"), F.col("v")).otherwise(F.lit(0)).alias("v"))


def start_ml_alerts(stream: DataFrame, model_path: str, rules: DataFrame, path: str, checkpoint: str, *, step="5m",
                    threshold=1.5, watermark="10 minutes", trigger: dict | None = None):
    """Score the closed steps of every server against the stored baseline model
    (``series.fit_baseline``) and store the alerts of the ML rule under ``path``/alerts.

    The model is read again by every micro-batch, so a new fit takes effect at once. Beside the alerts each
    batch stores the last step of every server, from which the next fills gaps; a batch that
    is run again replaces its own files and looks at earlier ones only.
    """
    def score(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [b for b in committed_batches(spark, f"{path}/last") if b < batch_id]
        last = spark.read.parquet(f"{path}/last/batch={earlier[-1]}") if earlier else None
        points = dense_steps(batch, last, step)
        scored = score_baseline(points, spark.read.parquet(model_path), threshold=threshold, step=step)
        found = scored.where("anomalies <> 0").select(F.col("Timestamp").alias("TimeGenerated"), "ServerName",
                                                      F.round("score", 2).alias("DeviationScore"))
        alert_rules(ml_candidates(found), rules).write.mode("overwrite").parquet(f"{path}/alerts/batch={batch_id}")
        now = batch.groupBy("ServerName").agg(F.max("Timestamp").alias("last_step"))
        if last is not None:
            now = now.unionByName(last).groupBy("ServerName").agg(F.max("last_step").alias("last_step"))
        now.write.mode("overwrite").parquet(f"{path}/last/batch={batch_id}")

    counts = activity_count_stream(stream, step=step, watermark=watermark)
    w = counts.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(score)
    return w.trigger(**(trigger or {"processingTime": "5 minutes"})).start()


def read_ml_alerts(spark, path: str) -> DataFrame:
    """The alerts that :func:`start_ml_alerts` has stored."""
    return spark.read.parquet(f"{path}/alerts").drop("batch")


def alert_stream(stream: DataFrame, rules: DataFrame, **kw) -> DataFrame:
    """Fired alerts of the log rules as a stream (append mode)."""
    return alert_rules(alert_candidates_stream(stream, **kw), rules)


def _fired(stream: DataFrame, rules: DataFrame, **kw) -> DataFrame:
    """Fired alerts with ``at``, the last moment of their window, which carries the watermark."""
    candidates = alert_candidates_stream(stream, **kw)
    return alert_rules(candidates.withColumn("at", F.window_time("win")), rules, keep=("at", "win"))


BURST_COLS = ["RuleName", "QuerySource", "Action", "Frequency", "ServerName", "GroupKey"]


def alert_once_stream(stream: DataFrame, rules: DataFrame, *, quiet: str = "10 minutes", **kw) -> DataFrame:
    """One row per rule, server, key and burst, emitted with the first of its windows. A burst is
    the alerts whose windows end in the same span of ``quiet`` (aligned to the epoch). The
    span is part of the duplicates' key and carries the watermark: its state is dropped when the
    watermark has passed its end. (``dropDuplicatesWithinWatermark`` would forget a key after the
    watermark's delay, however long the burst lasts.)"""
    fired = _fired(stream, rules, **kw).withColumn("burst", F.window("at", duration(quiet)))
    once = fired.select(*BURST_COLS, "burst").dropDuplicates([*BURST_COLS, "burst"])
    return once.select(*BURST_COLS, F.col("burst.start").alias("Burst"))


def alert_burst_stream(stream: DataFrame, rules: DataFrame, *, quiet: str = "10 minutes", **kw) -> DataFrame:
    """One row per burst: alerts of a rule, server and key without a pause longer than ``quiet``,
    with span, number of windows, and the severity at the peak. Emitted when the burst is over."""
    fired = _fired(stream, rules, **kw)
    burst = F.session_window("at", duration(quiet)).alias("burst")
    return fired.groupBy(*BURST_COLS, burst).agg(
        F.min("win.start").alias("BurstStart"), F.max("win.end").alias("BurstEnd"), F.count(F.lit(1)).alias("Windows"),
        F.max("MetricValue").alias("PeakValue"), F.max_by("Severity", "MetricValue").alias("Severity"),
        F.max("TimeGenerated").alias("TimeGenerated")).drop("burst")


def mark_bursts(alerts: DataFrame, stored: DataFrame | None, quiet: str = "10 minutes") -> DataFrame:
    """Adds ``Fires``: no alert of the same rule, server and key began in the
    ``quiet`` span before, neither among ``alerts`` nor in ``stored``."""
    keys = ["RuleName", "ServerName", "GroupKey"]
    begin = F.coalesce("WindowStart", "TimeGenerated")
    span = F.expr(f"INTERVAL {seconds(quiet)} SECONDS")
    before = F.lag(begin).over(Window.partitionBy(*keys).orderBy(begin, "TimeGenerated"))
    if stored is None:
        last = before
    else:
        old = stored.groupBy(*keys).agg(F.max(begin).alias("last_begin"))
        alerts = alerts.join(old, keys, "left")
        last = F.coalesce(before, F.col("last_begin"))
    return alerts.withColumn("Fires", last.isNull() | (begin > last + span)).drop("last_begin")


def start_alert_sink(alerts: DataFrame, path: str, checkpoint: str, *, quiet: str = "10 minutes",
                     trigger: dict | None = None):
    """Append alerts to a Parquet table, the first of each burst marked
    ``Fires``. Each micro-batch is written under its batch id with overwrite,
    and looks at earlier batches only, so a replayed batch replaces its own
    output instead of duplicating it."""
    def write(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        stored = None
        if path_exists(spark, path):
            stored = spark.read.parquet(path).where(F.col("batch") < batch_id)
        mark_bursts(batch, stored, quiet).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    w = alerts.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    w = w.trigger(**(trigger or {"processingTime": "2 minutes"}))
    return w.start()
