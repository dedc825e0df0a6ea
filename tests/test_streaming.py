"""Streaming: results after the watermark equal the batch results; late rows
are dropped; splitting the input into files does not change the result."""

import datetime as dt
import os
import tempfile

from log_rows import T0, audit, conn, row
from pyspark.sql import functions as F

from auditlens.operators.metrics import activity_metrics
from auditlens.sources.bronze import BRONZE_SCHEMA
from auditlens.streaming.metric_stream import activity_metrics_stream
from auditlens.streaming.sources import bronze_stream


def _rows(start, n, pid_mod=3):
    out = []
    for i in range(n):
        ts = start + dt.timedelta(seconds=37 * i)
        if i % 10 == 0:
            out.append(row(ts, conn(f"u{i % pid_mod}"), pid=i % pid_mod))
        else:
            out.append(row(ts, audit(i, "READ", "SELECT", "TABLE", "a.b", "q"), pid=i % pid_mod))
    return out


def _run(spark, folder, name):
    out, ck = os.path.join(folder, name), os.path.join(folder, name + "_ck")
    s = bronze_stream(spark, os.path.join(folder, "in", "*"), fmt="json", max_files_per_trigger=1)
    q = (activity_metrics_stream(s).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    q.awaitTermination()
    return spark.read.parquet(out), q


def test_stream_equals_batch_after_watermark(spark):
    folder = tempfile.mkdtemp(prefix="al-stream-")
    part1, part2 = _rows(T0, 200), _rows(T0 + dt.timedelta(seconds=37 * 200), 200)
    for k, part in enumerate((part1, part2)):
        spark.createDataFrame(part, BRONZE_SCHEMA).coalesce(1).write.json(os.path.join(folder, "in", f"f{k}"))
    got, q = _run(spark, folder, "out")
    assert len(q.recentProgress) >= 2
    batch = activity_metrics(spark.createDataFrame(part1 + part2, BRONZE_SCHEMA))
    wm = max(r[0] for r in part1 + part2) - dt.timedelta(minutes=10)
    batch = batch.where(F.col("Timestamp") + F.expr("INTERVAL 5 MINUTES") <= F.lit(wm))
    cols = sorted(batch.columns)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))


def test_late_rows_are_dropped(spark):
    # Late rows are judged against the previous batch's watermark (Spark's
    # late-event watermark), so the late file is the third micro-batch.
    folder = tempfile.mkdtemp(prefix="al-late-")
    on_time = _rows(T0, 240)
    late = [row(T0 - dt.timedelta(hours=2), audit(1, "READ", "SELECT", "TABLE", "a.b", "q"), pid=1)]
    for k, part in enumerate((on_time[:120], on_time[120:], late)):
        spark.createDataFrame(part, BRONZE_SCHEMA).coalesce(1).write.json(os.path.join(folder, "in", f"f{k}"))
    got, q = _run(spark, folder, "out")
    assert got.where(F.col("Timestamp") < F.lit(T0)).count() == 0
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  for op in p.get("stateOperators", []))
    assert dropped >= 1


def test_watermark_follows_whole_log_not_just_errors(spark):
    """Errors stop early but other log lines keep coming: the error-metric
    windows must still be emitted (the filter stays above the watermark)."""
    from auditlens.streaming.metric_stream import error_metrics_stream
    folder = tempfile.mkdtemp(prefix="al-err-")
    errs = [row(T0 + dt.timedelta(seconds=10 * i), "boom", level="ERROR", code="XX000") for i in range(5)]
    later = [row(T0 + dt.timedelta(minutes=30 + i), conn("a"), pid=1) for i in range(5)]
    spark.createDataFrame(errs + later, BRONZE_SCHEMA).coalesce(1).write.json(os.path.join(folder, "in", "f0"))
    out, ck = os.path.join(folder, "out"), os.path.join(folder, "ck")
    s = bronze_stream(spark, os.path.join(folder, "in", "*"), fmt="json")
    q = (error_metrics_stream(s).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    q.awaitTermination()
    got = spark.read.parquet(out).collect()
    assert [(r.ErrorRate, r.ErrorTypes) for r in got] == [(5, "Other")]


def test_streaming_error_spike_with_session_user(spark, mk):
    from auditlens.operators.sessions import session_info
    from auditlens.streaming.detector_stream import error_spike_stream
    folder = tempfile.mkdtemp(prefix="al-d3-")
    rows = [row(T0 - dt.timedelta(minutes=5), conn("carol"), pid=7)]
    rows += [row(T0 + dt.timedelta(seconds=2 * i), f'relation "t{i}" does not exist', level="ERROR", code="42P01",
                 pid=7) for i in range(23)]
    rows += [row(T0 + dt.timedelta(minutes=20), conn("dave"), pid=8)]          # advances the watermark
    spark.createDataFrame(rows, BRONZE_SCHEMA).coalesce(1).write.json(os.path.join(folder, "in", "f0"))
    sessions = session_info(mk(rows), lookback=None)
    s = bronze_stream(spark, os.path.join(folder, "in", "*"), fmt="json")
    out, ck = os.path.join(folder, "out"), os.path.join(folder, "ck")
    q = (error_spike_stream(s, sessions).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    q.awaitTermination()
    got = [(r.ErrorCount, r.Severity, r.User, r.ErrorCodes) for r in spark.read.parquet(out).collect()]
    assert got == [(23, "CRITICAL", "carol", ["42P01"])]


def _run_detector_stream(spark, folder, df_stream):
    out, ck = os.path.join(folder, "out"), os.path.join(folder, "ck")
    q = (df_stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", ck).trigger(availableNow=True).start(out))
    q.awaitTermination()
    return spark.read.parquet(out).collect()


def test_streaming_exfiltration_sliding_window(spark, mk):
    from auditlens.operators.sessions import session_info
    from auditlens.streaming.detector_stream import exfiltration_stream
    folder = tempfile.mkdtemp(prefix="al-d1-")
    rows = [row(T0 - dt.timedelta(minutes=5), conn("alice"), pid=5)]
    rows += [row(T0 + dt.timedelta(seconds=1.5 * i), audit(i, "READ", "SELECT", "TABLE", "a.b", "q"), pid=5)
             for i in range(20)]
    rows += [row(T0 + dt.timedelta(minutes=30), conn("zed"), pid=6)]          # advances the watermark
    spark.createDataFrame(rows, BRONZE_SCHEMA).coalesce(1).write.json(os.path.join(folder, "in", "f0"))
    s = bronze_stream(spark, os.path.join(folder, "in", "*"), fmt="json")
    got = _run_detector_stream(spark, folder, exfiltration_stream(s, session_info(mk(rows), lookback=None)))
    # 20 reads within 30 s fall into the 5 overlapping 5-minute windows that cover them
    assert sorted((r.SelectCount, r.Severity, r.User) for r in got) == [(20, "MEDIUM", "alice")] * 5


def test_streaming_deep_schema_enum(spark, mk):
    from auditlens.operators.sessions import CONN_TERMS_AUTHORIZED, session_info
    from auditlens.streaming.detector_stream import deep_schema_enum_stream
    folder = tempfile.mkdtemp(prefix="al-d6-")
    cats = ["pg_catalog.pg_tables", "pg_catalog.pg_class", "pg_catalog.pg_attribute", "pg_catalog.pg_proc",
            "pg_catalog.pg_type", "information_schema.tables", "information_schema.columns"]
    rows = [row(T0 - dt.timedelta(minutes=5), conn("eve"), pid=9)]
    rows += [row(T0 + dt.timedelta(seconds=10 * i), audit(i, "READ", "SELECT", "", "", f"SELECT * FROM {cats[i % 7]}"),
                 pid=9) for i in range(20)]
    rows += [row(T0 + dt.timedelta(minutes=30), conn("zed"), pid=6)]
    spark.createDataFrame(rows, BRONZE_SCHEMA).coalesce(1).write.json(os.path.join(folder, "in", "f0"))
    s = bronze_stream(spark, os.path.join(folder, "in", "*"), fmt="json")
    sessions = session_info(mk(rows), lookback=None, terms=CONN_TERMS_AUTHORIZED, fields=("User",))
    got = _run_detector_stream(spark, folder, deep_schema_enum_stream(s, sessions))
    assert [(r.SystemTableQueries, r.UniqueSystemTables, r.Severity, r.User) for r in got] == [(20, 7, "HIGH", "eve")]


def test_streaming_brute_force(spark):
    from auditlens.streaming.detector_stream import brute_force_stream
    folder = tempfile.mkdtemp(prefix="al-d7-")
    rows = [row(T0 + dt.timedelta(seconds=3 * i), 'password authentication failed for user "bob" host=10.0.0.9',
                level="FATAL", code="28P01", pid=100 + i, backend="") for i in range(20)]
    rows += [row(T0 + dt.timedelta(hours=2), conn("zed"), pid=6)]            # advances the watermark
    spark.createDataFrame(rows, BRONZE_SCHEMA).coalesce(1).write.json(os.path.join(folder, "in", "f0"))
    s = bronze_stream(spark, os.path.join(folder, "in", "*"), fmt="json")
    got = _run_detector_stream(spark, folder, brute_force_stream(s))
    assert [(r.SourceHost, r.FailedAttempts, r.Severity) for r in got] == [("10.0.0.9", 20, "HIGH")]
