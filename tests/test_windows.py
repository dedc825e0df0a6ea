"""Time windows: every public function with its own defaults, with "now", with a
datetime; and the repairs of stored tables."""

from __future__ import annotations

import datetime as dt
import inspect

import pytest
from log_rows import T0, audit, conn, row
from pyspark.sql import functions as F

from auditlens.functions import timefn
from auditlens.operators import alerts as A
from auditlens.operators import dashboards as Q
from auditlens.operators import detectors as D
from auditlens.operators import metrics as M
from auditlens.operators import series as SR
from auditlens.operators.sessions import session_info
from auditlens.sources.bronze import read_bronze, write_bronze

ON_LOG = [Q.activity_by_server, Q.audit_distribution, Q.top_tables, Q.audit_timeline, Q.errors_by_category,
          Q.activity_by_backend, Q.top_users, Q.top_hosts, Q.user_db_heatmap, Q.auth_failures, Q.top_error_codes,
          Q.data_freshness, Q.audit_coverage, Q.backend_distribution, Q.error_code_diagnostics, Q.privilege_ops_by_user,
          Q.errors_per_minute, Q.connection_sample, Q.active_users_today, Q.current_activity, D.exfiltration,
          D.destructive_ops, D.error_spike, D.privilege_escalation, D.cross_schema_recon, D.deep_schema_enum,
          D.brute_force, D.brute_force_by_code, D.error_spike_5m, D.exfiltration_by_user, D.quick_exfil,
          D.quick_destructive, D.quick_errors, D.quick_privilege, A.anomalies_union, A.anomalies_all,
          A.alert_candidates, M.activity_metrics, M.error_metrics, M.user_metrics, session_info]
ON_METRICS = [Q.metrics_stats, Q.metrics_status, Q.history_depth, D.privilege_offhours, SR.make_series,
              SR.series_anomalies, SR.baseline_deviation, SR.baseline_deviation_pct]


@pytest.fixture(scope="module")
def log(mk):
    return mk([row(T0 - dt.timedelta(days=2), conn(user="old"), pid=1), row(T0, conn(), pid=1)]
              + [row(T0 + dt.timedelta(seconds=i), audit(i, "READ", "SELECT"), pid=1) for i in range(1, 21)]).cache()


@pytest.mark.parametrize("fn", ON_LOG + ON_METRICS, ids=lambda f: f.__name__)
def test_defaults_now_and_a_datetime(log, fn):
    data = M.activity_metrics(log) if fn in ON_METRICS else log
    fn(data).collect()
    if "as_of" in inspect.signature(fn).parameters:
        fn(data, as_of="now").collect()
        fn(data, as_of=T0).collect()


def test_replay_keeps_the_last_window(log):
    assert Q.current_activity(log).first().TotalEvents == 21
    assert Q.current_activity(log, lookback="3d").first().TotalEvents == 22
    assert Q.current_activity(log, as_of="now").count() == 0
    assert Q.current_activity(log, as_of=T0).first().TotalEvents == 21  # no upper bound, as with ago()


def test_an_empty_log(mk):
    none = mk([]).limit(0)
    assert Q.current_activity(none).count() == 0
    assert timefn.resolve_as_of(none) is None


def test_bad_as_of(log):
    with pytest.raises(ValueError):
        Q.current_activity(log, as_of="yesterday")


def test_rows_without_flags_are_read(spark, mk, tmp_path):
    path = str(tmp_path / "log")
    rows = mk([row(T0 + dt.timedelta(seconds=i), audit(i, "READ", "SELECT")) for i in range(20)])
    write_bronze(rows, path)
    rows.withColumn("event_date", F.to_date("EventProcessedUtcTime")).write.mode("append").partitionBy(
        "event_date").parquet(path)
    stored = read_bronze(spark, path, normalized=True)
    assert stored.count() == 40
    assert Q.audit_distribution(stored).first().Count == 40
    plan = Q.audit_distribution(stored)._jdf.queryExecution().toString()
    assert "is_audit" in plan.split("PushedFilters: [")[1].split("]")[0]  # still skips row groups


def test_a_repeated_batch_replaces_its_files(spark, mk, tmp_path):
    path = str(tmp_path / "log")
    rows = mk([row(T0 + dt.timedelta(seconds=i), "x") for i in range(7)])
    write_bronze(rows, path)
    for _ in range(2):
        write_bronze(rows, path, batch="stream-000000000003")
    write_bronze(rows, path, batch="stream-000000000004")
    assert read_bronze(spark, path).count() == 21


def test_history_and_stream_share_a_table(spark, mk, tmp_path):
    from auditlens.streaming.sources import bronze_stream, write_bronze_stream
    path, hub, ck = (str(tmp_path / n) for n in ("log", "hub", "ck"))
    rows = mk([row(T0 + dt.timedelta(seconds=i), conn(user=f"u{i}")) for i in range(20)])
    write_bronze(rows, path)
    rows.coalesce(1).write.json(hub)
    for _ in range(2):  # the second start finds nothing new
        write_bronze_stream(bronze_stream(spark, hub), path, ck, trigger={"availableNow": True}).awaitTermination()
    stored = read_bronze(spark, path, normalized=True)
    assert stored.count() == 40 and stored.where("is_conn").count() == 40


def test_half_filled_buckets_are_corrected(spark, mk, tmp_path):
    path = str(tmp_path / "activity")
    rows = mk([row(T0 + dt.timedelta(seconds=i), "x") for i in range(40)])
    M.activity_backfill(spark, rows.limit(10), path)
    for _ in range(2):
        got = M.activity_backfill(spark, rows, path)
        assert [r.ActivityCount for r in got.collect()] == [40]


def test_a_backfill_starts_with_a_whole_bucket(spark, mk, tmp_path):
    rows = mk([row(T0 + dt.timedelta(minutes=i), "x") for i in range(60)])
    got = M.activity_backfill(spark, rows, str(tmp_path / "a"), lookback="13m")
    assert {r.ActivityCount for r in got.collect()} == {5}


def test_backfill_then_stream_in_one_table(spark, mk, tmp_path):
    from auditlens.streaming.metric_stream import error_metrics_stream, start_metric_stream
    from auditlens.streaming.sources import bronze_stream
    path, hub, ck = (str(tmp_path / n) for n in ("m", "hub", "ck"))
    rows = mk([row(T0 + dt.timedelta(seconds=20 * i), "boom", level="ERROR", code="42P01") for i in range(30)])
    M.error_backfill(spark, rows.where(F.col("EventProcessedUtcTime") < F.lit(T0 + dt.timedelta(minutes=2))), path)
    rows.where(F.col("EventProcessedUtcTime") >= F.lit(T0 + dt.timedelta(minutes=2))).write.json(hub)
    stream = error_metrics_stream(bronze_stream(spark, hub))
    start_metric_stream(stream, path, ck, output_mode="update", trigger={"availableNow": True}).awaitTermination()
    stored = spark.read.parquet(path).drop("metric_date")
    want = M.error_metrics(rows)
    assert sorted(map(str, stored.collect())) == sorted(map(str, want.collect()))  # the open bucket too


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    from auditlens import config

    class Context:
        master, getCheckpointDir = "spark://host:7077", staticmethod(lambda: None)

        class getConf:  # noqa: N801
            get = staticmethod(lambda *a: None)

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda *a: None)
    with pytest.raises(RuntimeError):
        config.shared_dir(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        config.shared_dir(Session())


def test_a_burst_fires_once(spark, mk, tmp_path):
    from auditlens.streaming.alert_stream import alert_stream, start_alert_sink
    from auditlens.streaming.sources import bronze_stream
    path, hub, ck = (str(tmp_path / n) for n in ("alerts", "hub", "ck"))
    reads = [row(T0 + dt.timedelta(seconds=i), audit(i, "READ", "SELECT"), pid=1) for i in range(20)]
    again = [row(T0 + dt.timedelta(hours=2, seconds=i), audit(i, "READ", "SELECT"), pid=1) for i in range(20)]
    for part in (reads, again, [row(T0 + dt.timedelta(hours=5), "x")]):
        mk(part).coalesce(1).write.mode("append").json(hub)
        stream = alert_stream(bronze_stream(spark, hub), A.rules_df(spark))
        start_alert_sink(stream, path, ck, trigger={"availableNow": True}).awaitTermination()
    stored = spark.read.parquet(path).where("RuleName = 'Data Exfil'")
    assert stored.count() == 10 and stored.where("Fires").count() == 2
    assert stored.where("Fires").select("WindowStart").distinct().count() == 2
