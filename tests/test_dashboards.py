"""Dashboard and health tiles on literal rows (thresholds, tiers, 'now')."""

import datetime as dt

from log_rows import T0, audit, conn, row

from auditlens.operators import dashboards as Q
from auditlens.operators.metrics import activity_metrics


def sec(n):
    return dt.timedelta(seconds=n)


def test_data_freshness_fresh_and_stale(mk):
    b = mk([row(T0 - sec(3600 * 30), conn("a")), row(T0, conn("a"))])
    fresh = Q.data_freshness(b, as_of=T0 + sec(120)).first()
    assert (fresh.Status, fresh.LatencyMinutes, fresh.TotalEvents, fresh.TimeRange) == ("Fresh data", 2, 2, 1)
    stale = Q.data_freshness(b, as_of=T0 + sec(600)).first()
    assert (stale.Status, stale.LatencyMinutes) == ("Stale data", 10)


def test_metrics_status_healthy_and_delayed(mk):
    rows = [row(T0 + sec(i), audit(i, "READ", "SELECT", "TABLE", "a.b", "q"), server="srv1") for i in range(3)]
    rows += [row(T0 - sec(3600), audit(9, "READ", "SELECT", "TABLE", "a.b", "q"), server="srv2")]
    m = activity_metrics(mk(rows))
    got = {r.ServerName: (r.Status, r.DelayMinutes) for r in Q.metrics_status(m, as_of=T0 + sec(300)).collect()}
    assert got == {"srv1": ("Healthy", 5), "srv2": ("Delayed", 65)}


def test_top_hosts_risk_tiers(mk):
    rows = []
    for host, n, errs in (("10.0.0.1", 10, 3), ("10.0.0.2", 10, 1), ("10.0.0.3", 20, 0)):
        for i in range(n):
            lvl = "FATAL" if i < errs else "LOG"
            rows.append(row(T0 + sec(i), f"connection received: host={host} user=u{i % 3}", level=lvl))
    got = {r.ClientHost: (r.TotalConnections, r.UniqueUsers, r.ErrorRate, r.Risk, r.UsersDisplay)
           for r in Q.top_hosts(mk(rows), lookback=None).collect()}
    assert got["10.0.0.1"] == (10, 3, 30.0, "HIGH", "u0, u1, u2")
    assert got["10.0.0.2"][2:4] == (10.0, "MEDIUM")
    assert got["10.0.0.3"][2:4] == (0.0, "LOW")


def test_auth_failures_threat_levels(mk):
    rows = []
    for host, n in (("10.0.0.1", 21), ("10.0.0.2", 11), ("10.0.0.3", 6), ("10.0.0.4", 2)):
        rows += [row(T0 + sec(i), f'password authentication failed for user "bob" host={host}', level="FATAL",
                     code="28P01") for i in range(n)]
    got = [(r.ClientHost, r.FailedAttempts, r.ThreatLevel) for r in Q.auth_failures(mk(rows), lookback=None).collect()]
    assert got == [("10.0.0.1", 21, "CRITICAL"), ("10.0.0.2", 11, "HIGH"), ("10.0.0.3", 6, "MEDIUM"),
                   ("10.0.0.4", 2, "LOW")]


def test_hourly_profile_has_cube_subtotals(mk):
    rows = [row(T0 + sec(3600 * h), audit(h, "READ", "SELECT", "TABLE", "a.b", "q")) for h in range(3)]
    prof = Q.hourly_profile(activity_metrics(mk(rows))).collect()
    grand = [r for r in prof if r.HourOfDay is None and r.DayOfWeek is None]
    assert len(grand) == 1 and grand[0].Buckets == 3
    assert len([r for r in prof if r.HourOfDay is not None and r.DayOfWeek is not None]) == 3


def test_audit_timeline_operation_types(mk):
    rows = [row(T0, audit(1, "READ", "SELECT", "TABLE", "a.b", "q")),
            row(T0, audit(2, "WRITE", "UPDATE", "TABLE", "a.b", "q")),
            row(T0, audit(3, "MISC", "SET", "", "", "SET x")),
            row(T0, audit(4, "DDL", "CREATE TABLE", "TABLE", "a.c", "q"))]
    full = {r.OperationType: r.Count for r in Q.audit_timeline(mk(rows), lookback=None).collect()}
    assert full == {"SELECT": 1, "WRITE": 1, "MISC": 1, "DDL": 1}
    six = {r.OperationType: r.Count for r in Q.audit_timeline(mk(rows), lookback=None, include_misc=False).collect()}
    assert six == {"SELECT": 1, "WRITE": 1, "OTHER": 1, "DDL": 1}
