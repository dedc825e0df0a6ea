"""Additive sketches, spells of activity, alerts with conditions and SQL table functions."""

from __future__ import annotations

import datetime as dt

import pytest
from log_rows import T0, audit, conn, row
from pyspark.sql import functions as F

from auditlens.operators import alerts as A
from auditlens.operators import metrics as M
from auditlens.operators.sessions import backend_sessions
from auditlens.plans.views import register_functions

M1 = dt.timedelta(minutes=1)


def test_sketches_add_up_within_their_error(spark, mk):
    n = 30_000
    log = spark.range(n).select(
        (F.lit(T0) + F.make_dt_interval(mins=(F.col("id") % 600).cast("int"))).alias("EventProcessedUtcTime"),
        F.concat(F.lit("x user=u"), F.col("id") % 12_000, F.lit(" host=h"), F.col("id") % 7).alias("message"),
        F.lit("LOG").alias("errorLevel"), F.lit("00000").alias("sqlerrcode"), F.lit(1).cast("long").alias("processId"),
        F.lit("client backend").alias("backend_type"),
        F.concat(F.lit("srv"), F.col("id") % 2).alias("LogicalServerName"), F.lit("PostgreSQLLogs").alias("category"))
    rows = M.activity_sketches(log)
    assert rows.count() == 240
    for by, users, total in ((("ServerName",), 6_000, n // 2), ((), 12_000, n)):
        for r in M.roll_up(rows, "1d", by=by).collect():
            assert r.ActivityCount == total and r.Errors == 0
            assert abs(r.UniqueUsers - users) <= 0.03 * users and r.UniqueHosts == 7


def test_lines_without_users_roll_up_to_none(mk):
    log = mk([row(T0, "boom", "ERROR"), row(T0 + M1, audit(1, "READ", "SELECT")), row(T0, conn(), category="Other")])
    r = M.roll_up(M.activity_sketches(log)).collect()
    assert [(x.ActivityCount, x.AuditLogs, x.Errors, x.UniqueUsers, x.UniqueHosts) for x in r] == [(2, 1, 1, 0, 0)]
    assert M.roll_up(M.activity_sketches(mk([]))).count() == 0


def test_sketch_backfill_twice_is_the_same(spark, mk, tmp_path):
    log = mk([row(T0 + i * M1, conn(f"u{i % 3}")) for i in range(20)])
    path = str(tmp_path / "sketches")
    for _ in range(2):
        table = M.sketch_backfill(spark, log, path, lookback=None)
    assert [(r.ActivityCount, r.UniqueUsers) for r in M.roll_up(table, "1d").collect()] == [(20, 3)]


def test_spells_end_with_a_pause_longer_than_the_gap(mk):
    at = [0, 10, 40, 71, 200]                 # a pause of exactly the gap, then one of a minute more
    log = mk([row(T0 + m * M1, conn() if m == 10 else audit(1, "READ", "SELECT"), pid=1) for m in at]
             + [row(T0, "x", pid=None), row(T0, "x", "ERROR", pid=None), row(None, "x", pid=1),
                row(T0 + M1, "y", pid=1, server="srv2")])
    got = sorted((str(r.processId), r.LogicalServerName, (r.SessionStart - T0) // M1, (r.LastEvent - T0) // M1, r.Events,
                  r.AuditLogs, r.Errors, r.User) for r in backend_sessions(log, lookback=None, gap="30m").collect())
    assert got == [("1", "srv1", 0, 40, 3, 2, 0, "alice"), ("1", "srv1", 71, 71, 1, 1, 0, ""),
                   ("1", "srv1", 200, 200, 1, 1, 0, ""), ("1", "srv2", 1, 1, 1, 0, 0, ""),
                   ("None", "srv1", 0, 0, 2, 0, 1, "")]
    assert backend_sessions(mk([]), lookback=None).count() == 0


def test_a_hot_backend_sends_bins_not_lines(spark, mk):
    """Lines are counted per bin before the first exchange; the second holds bins."""
    log = mk([row(T0 + i * dt.timedelta(seconds=1), "x", pid=1) for i in range(3000)])
    df = backend_sessions(log, lookback=None)
    assert [(r.Events, r.LastEvent - r.SessionStart) for r in df.collect()] == [(3000, dt.timedelta(seconds=2999))]
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    window = next(i for i, x in enumerate(plan) if "Window [" in x)
    assert sum("Aggregate(" in x and "keys=[processId" in x or "Aggregate(key=[processId" in x for x in plan[window:]) >= 2


ROWS = [("Potential Data Exfiltration", "CRITICAL", 60.0), ("Potential Data Exfiltration", "HIGH", 40.0),
        ("Mass Destructive Operations", "HIGH", 12.0), ("Mass Destructive Operations", "MEDIUM", 6.0),
        ("Privilege Escalation", None, 9.0), ("ML Baseline Deviation", "CRITICAL", 3.0),
        ("ML Baseline Deviation", "CRITICAL", 3.01), ("ML Baseline Deviation", "CRITICAL", None)]


def test_alerts_fire_where_all_their_conditions_hold(spark):
    rows = spark.createDataFrame(ROWS, "AnomalyType string, Severity string, Score double")
    got = sorted((r.AlertName, r.Score, r.Action) for r in A.condition_alerts(rows).collect())
    assert got == [("Data Exfiltration", 60.0, "Email + Teams"), ("Destructive Operations", 12.0, "Email + Teams + SMS"),
                   ("ML Anomaly Detection", 3.01, "Email + Teams")]
    both = [("any", "q", None, (("Score", ">=", 40.0),), "x", "1m"), ("one", "q", None, (("Severity", "==", "HIGH"),), "x", "1m")]
    assert sorted((r.AlertName, r.Score) for r in A.condition_alerts(rows, both).collect()) == [
        ("any", 40.0), ("any", 60.0), ("one", 12.0), ("one", 40.0)]
    with pytest.raises(ValueError, match="a condition tests with"):
        A.rule_condition(None, (("Score", "~", 1),))


def test_baseline_deviations_become_scored_rows(spark):
    feed = spark.createDataFrame([(T0, "Privilege Escalation", "HIGH", "s", "u", 4)],
                                 "TimeGenerated timestamp, AnomalyType string, Severity string, ServerName string, "
                                 "User string, MetricValue long")
    ml = spark.createDataFrame([(T0, "s", -3.2, -3.2), (T0, "s", 2.5, 2.5), (T0, "s", 1.6, 1.6)],
                               "TimeGenerated timestamp, ServerName string, score double, DeviationScore double")
    got = [(r.AnomalyType[:2], r.Severity, r.Score) for r in A.scored_rows(feed, ml).orderBy("Score").collect()]
    assert got == [("ML", "MEDIUM", 1.6), ("ML", "HIGH", 2.5), ("ML", "CRITICAL", 3.2), ("Pr", "HIGH", 4.0)]


def test_table_functions_take_a_lookback_in_sql(spark, mk):
    log = mk([row(T0 - dt.timedelta(hours=h), conn(f"u{h}"), pid=h) for h in (0, 1, 2, 30)]
             + [row(T0, "boom", "ERROR", "XX000"), row(T0 - dt.timedelta(hours=5), "boom", "ERROR", "XX000")])
    names = register_functions(spark, log, as_of=T0)
    assert [spark.sql(f"SELECT * FROM recent_logs({h})").count() for h in (0, 1, 6, 48)] == [2, 3, 5, 6]
    assert spark.sql("SELECT sum(ErrorRate) FROM recent_errors(1)").first()[0] == 1
    assert spark.sql("SELECT l.message FROM recent_logs(1) l JOIN recent_activity(1) a "
                     "ON l.LogicalServerName = a.ServerName WHERE l.errorLevel = 'ERROR'").count() >= 1
    for n in names:
        assert spark.sql(f"SELECT * FROM {n}(24)").columns
    register_functions(spark, mk([]))
    assert spark.sql("SELECT * FROM recent_logs(24)").count() == 0


def test_a_table_function_prunes_the_stored_log(spark, mk, tmp_path):
    from auditlens.sources.bronze import read_bronze, write_bronze
    path = str(tmp_path / "bronze")
    write_bronze(mk([row(T0 - dt.timedelta(days=d), "x") for d in range(5)]), path)
    register_functions(spark, read_bronze(spark, path, normalized=True))
    df = spark.sql("SELECT message FROM recent_logs(24)")
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "GreaterThanOrEqual(EventProcessedUtcTime" in plan
