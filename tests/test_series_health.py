"""Series as arrays, late-row accounting, the progress log."""

from __future__ import annotations

import datetime as dt
import math

from log_rows import T0, audit, conn, row
from pyspark.sql import functions as F

from auditlens.operators import dashboards as Q
from auditlens.operators import detectors as D
from auditlens.operators import series as SR
from auditlens.sources.bronze import BRONZE_COLS
from auditlens.streaming.health import ProgressLog, batch_health, late_summary, read_health, start_health
from auditlens.streaming.sources import bronze_stream

M1 = dt.timedelta(minutes=1)
US0 = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)


def metrics(spark, servers=2, n=60):
    rows = [(T0 + i * 5 * M1, f"s{s}", 500 if i == 50 else 20 + (i * 7 + s) % 5) for s in range(servers) for i in range(n)
            if i % 9 != 4]
    return spark.createDataFrame(rows, "Timestamp timestamp, ServerName string, ActivityCount long")


def test_arrays_expand_to_the_long_form(spark):
    long = SR.make_series(metrics(spark), lookback=None)
    packed = SR.pack_series(long, ("idx", "v"))
    assert packed.count() == 2 and {len(r.v) for r in packed.collect()} == {60}
    back = SR.expand_series(packed, ["Timestamp", "idx", "v"])
    assert sorted(map(tuple, back.select(*long.columns).collect())) == sorted(map(tuple, long.collect()))


def test_decomposed_arrays_equal_the_long_decomposition(spark):
    long = SR.make_series(metrics(spark), lookback=None)
    want = SR.decompose(long).select("ServerName", "Timestamp", "v", "anomalies", "score", "baseline")
    arrays = SR.decompose_packed(SR.pack_series(long))
    got = SR.expand_series(arrays, ["Timestamp", "v", "anomalies", "score", "baseline"]).select(*want.columns)
    got, want = sorted(map(tuple, got.collect())), sorted(map(tuple, want.collect()))
    assert [g[:4] for g in got] == [w[:4] for w in want] and any(g[3] == 1 for g in got)
    assert all(math.isclose(a, b, abs_tol=1e-9) for g, w in zip(got, want) for a, b in zip(g[4:], w[4:]))


def test_expansion_is_parallel_and_keeps_nulls(spark):
    df = spark.createDataFrame([("a", [1, 2, 3], ["x", None]), ("b", [], []), ("c", None, ["z"]), ("d", None, None)],
                               "k string, n array<long>, t array<string>")
    out = SR.expand_series(df, ["n", "t"], types={"n": "double"})
    assert out.columns == ["k", "n", "t"] and dict(out.dtypes)["n"] == "double"
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("a", 1.0, "x"), ("a", 2.0, None), ("a", 3.0, None), ("c", None, "z")], key=str)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_an_empty_series_packs_to_nothing(spark):
    none = metrics(spark).where(F.lit(False))
    assert SR.pack_series(SR.make_series(none, lookback=None)).count() == 0


def test_late_rows_by_hand(mk):
    # newest before: T0 + 30 min; delay 10 min: the watermark is T0 + 20 min
    log = mk([row(T0 + m * M1, "x") for m in (3, 14, 15, 19, 20, 40)] + [row(None, "x"), row(T0 + 50 * M1, "x", server="srv2")])
    got = {r.ServerName: r for r in batch_health(log, 5, US0 + 30 * 60 * 1_000_000).collect()}
    r = got["srv1"]
    # windows of 5 min that end at 20 at the latest: lines of 3, 14, 15 and 19
    assert (r.Batch, r.Rows, r.LateRows, r.DroppedRows, r.MaxDelaySeconds) == (5, 7, 4, 4, 27 * 60.0)
    assert (got["srv2"].LateRows, got["srv2"].MaxDelaySeconds) == (0, 0.0)
    r = {r.ServerName: r for r in batch_health(log, 0, None).collect()}["srv1"]
    assert (r.Rows, r.LateRows, r.DroppedRows, r.Watermark) == (7, 0, 0, None)


def test_a_late_row_in_an_open_window_is_not_dropped(mk):
    r = batch_health(mk([row(T0 + 21 * M1, "x"), row(T0 + 24 * M1, "x")]), 1, US0 + 32 * 60 * 1_000_000).first()
    assert (r.LateRows, r.DroppedRows) == (1, 0)        # watermark at 22, the window ends at 25


def test_a_replay_counts_what_a_stateful_query_drops(spark, mk, tmp_path):
    """Three landings; the health table's dropped rows are those missing from a windowed count."""
    hub, health, ck = (str(tmp_path / n) for n in ("hub", "health", "ck"))
    out, out_ck, progress = (str(tmp_path / n) for n in ("out", "out_ck", "progress"))
    listener = ProgressLog(spark, progress, every=2)
    spark.streams.addListener(listener)
    minutes = [range(0, 60), [1, 2, 49, 51, 70], [3, 52, 61, 400]]
    try:
        for part in minutes:
            mk([row(T0 + m * M1, "x", pid=m) for m in part]).select(*BRONZE_COLS).write.mode("append").parquet(hub)
            stream = bronze_stream(spark, hub, fmt="parquet")
            start_health(stream, health, ck, trigger={"availableNow": True}).awaitTermination()
            counts = stream.withWatermark("EventProcessedUtcTime", "10 minutes").groupBy(
                F.window("EventProcessedUtcTime", "5 minutes")).count()
            q = counts.writeStream.format("parquet").option("checkpointLocation", out_ck).trigger(availableNow=True).start(out)
            q.awaitTermination()
    finally:
        spark.streams.removeListener(listener)
        listener.flush()
    rows = {r.Batch: (r.Rows, r.LateRows, r.DroppedRows, r.MaxDelaySeconds) for r in read_health(spark, health).collect()}
    # watermarks: none, T0 + 49, T0 + 60
    assert rows == {0: (60, 0, 0, 0.0), 1: (5, 2, 2, 58 * 60.0), 2: (4, 2, 2, 67 * 60.0)}
    s = late_summary(read_health(spark, health)).first()
    assert (s.Batches, s.Rows, s.DroppedRows, s.DroppedPercent) == (3, 69, 4, 5.8)
    kept = spark.read.parquet(out).agg(F.sum("count")).first()[0]
    assert kept == 69 - s.DroppedRows - 1               # all but the last row, whose window is open
    log = spark.read.parquet(progress)
    assert log.agg(F.sum("DroppedRows")).first()[0] >= 1 and log.agg(F.sum("InputRows")).first()[0] == 2 * 69


def test_health_of_a_repeated_batch_and_of_nothing(spark, tmp_path):
    assert read_health(spark, str(tmp_path / "none")).count() == 0
    assert late_summary(read_health(spark, str(tmp_path / "none"))).count() == 0


def test_reads_by_the_user_in_the_message(mk):
    log = mk([row(T0 + i * M1, audit(i, "READ", "SELECT", query="select 1 user=eve")) for i in range(16)]
             + [row(T0 + i * M1, audit(i, "READ", "SELECT")) for i in range(15)] + [row(T0, conn("zed"))])
    assert [tuple(r) for r in D.exfiltration_by_message_user(log, lookback=None).collect()] == [("eve", 16, "CRITICAL")]


def test_database_names_of_failed_logins_are_bounded(mk):
    log = mk([row(T0 + i * M1, f'password authentication failed for user "b" user=b host=h1 database=d{i:03}', "FATAL", "28P01")
              for i in range(150)])
    r = Q.auth_failures(log, lookback=None).first()
    assert r.FailedAttempts == 150 and r.Databases == [f"d{i:03}" for i in range(100)]
