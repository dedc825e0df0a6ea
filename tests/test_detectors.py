"""Detector scenarios (FIXTURES.md section 3): the injected attack patterns at
and around their thresholds, with the reference's default windows."""

import datetime as dt

import pytest
from log_rows import T0, audit, conn, row

from auditlens.operators import alerts as A
from auditlens.operators import detectors as D


def sec(n):
    return dt.timedelta(seconds=n)


def reads(n, pid=100, start=T0, step=1.5, server="srv1"):
    return [row(start + sec(i * step), audit(i, "READ", "SELECT", "TABLE", "sales.customer",
                                             f"select * from sales.customer where id = {i}"), pid=pid, server=server)
            for i in range(n)]


@pytest.mark.parametrize("n,expected", [(15, None), (16, "MEDIUM"), (20, "MEDIUM"), (31, "HIGH"), (51, "CRITICAL")])
def test_exfiltration_tiers(mk, n, expected):
    rows = [row(T0 - sec(60), conn("alice"), pid=100)] + reads(n, step=30 / n)
    out = D.exfiltration(mk(rows)).collect()
    if expected is None:
        assert out == []
    else:
        assert len(out) == 1
        r = out[0]
        assert (r.SelectCount, r.Severity, r.User, r.Database, r.SourceHost) == (n, expected, "alice", "shop", "10.0.0.7")
        assert r.TablesAccessed == "TABLE"  # the reference's capture is the object type field
        assert r.SampleQueries == ""        # no ',,,' form in these lines


def test_exfiltration_excludes_azuresu_and_other_backends(mk):
    rows = [row(T0 - sec(60), conn("azuresu"), pid=100)] + reads(20)
    assert D.exfiltration(mk(rows)).count() == 0
    rows = [row(r[0], r[1], backend="autovacuum") for r in reads(20)]
    assert D.exfiltration(mk(rows)).count() == 0


@pytest.mark.parametrize("n,expected", [(5, None), (10, "MEDIUM"), (11, "HIGH"), (21, "CRITICAL")])
def test_destructive_tiers(mk, n, expected):
    rows = [row(T0 - sec(300), conn("bob"), pid=200)]
    rows += [row(T0 + sec(i * 100 / n), audit(i, "WRITE", "UPDATE", "TABLE", "public.t", "UPDATE public.t SET a = 1"),
                 pid=200) for i in range(n)]
    out = D.destructive_ops(mk(rows)).collect()
    if expected is None:
        assert out == []
    else:
        assert [(r.OperationCount, r.Severity, r.User) for r in out] == [(n, expected, "bob")]
        assert out[0].Operations == ["UPDATE"]


def test_destructive_unknown_user_is_excluded(mk):
    rows = [row(T0 + sec(i), audit(i, "WRITE", "DELETE", "TABLE", "public.t", "DELETE FROM public.t"), pid=201)
            for i in range(12)]
    assert D.destructive_ops(mk(rows)).count() == 0


def test_error_spike_critical(mk):
    rows = [row(T0 + sec(i * 2), f'relation "t{i}" does not exist', level="ERROR",
                code="42P01" if i % 2 else "42703", pid=300) for i in range(23)]
    out = D.error_spike(mk(rows)).collect()
    assert [(r.ErrorCount, r.Severity) for r in out] == [(23, "CRITICAL")]
    assert out[0].ErrorCodes == ["42703", "42P01"]
    assert out[0].ErrorTypes == ["Permission Error"]
    assert len(out[0].SampleErrors) == 3


def test_error_spike_at_threshold(mk):
    rows = [row(T0 + sec(i), "boom", level="ERROR", code="XX000") for i in range(3)]
    assert D.error_spike(mk(rows)).count() == 0
    rows += [row(T0 + sec(10), "boom", level="ERROR", code="XX000")]
    assert D.error_spike(mk(rows)).first().Severity == "MEDIUM"


def test_privilege_escalation_counts_all_role_ops(mk):
    rows = [row(T0 - sec(60), conn("carol"), pid=400)]
    stmts = ["CREATE ROLE"] * 4 + ["GRANT"] * 7 + ["REVOKE"] * 2
    rows += [row(T0 + sec(i * 10), audit(i, "ROLE", s, "", "", f"{s} r{i}"), pid=400) for i, s in enumerate(stmts)]
    # a system user's grant is ignored; GRANTED is not GRANT
    rows += [row(T0 - sec(60), conn("azuresu"), pid=401),
             row(T0 + sec(5), audit(99, "ROLE", "GRANT", "", "", "GRANT x TO y"), pid=401),
             row(T0 + sec(6), "permission GRANTED for role", pid=400)]
    out = D.privilege_escalation(mk(rows)).collect()
    assert [(r.PrivilegeOpsCount, r.Severity, r.User) for r in out] == [(13, "CRITICAL", "carol")]
    assert out[0].Operations == ["CREATE ROLE", "GRANT", "REVOKE"]


@pytest.mark.parametrize("schemas,expected", [
    (["sales", "production", "person", "humanresources"], None),
    (["sales", "production", "person", "humanresources", "purchasing"], "MEDIUM"),
])
def test_cross_schema_recon(mk, schemas, expected):
    rows = [row(T0 - sec(60), conn("dave"), pid=500)]
    for i, s in enumerate(schemas + schemas[:3]):
        rows.append(row(T0 + sec(i * 20), audit(i, "READ", "SELECT", "TABLE", f"{s}.t{i}", f"select * from {s}.t{i}"),
                        pid=500))
    rows.append(row(T0 + sec(5), audit(50, "READ", "SELECT", "TABLE", "pg_catalog.pg_class", "q"), pid=500))
    out = D.cross_schema_recon(mk(rows)).collect()
    if expected is None:
        assert out == []
    else:
        assert [(r.SchemasAccessed, r.Severity) for r in out] == [(5, expected)]
        assert "pg_catalog" not in out[0].SchemaList


def test_deep_schema_enum(mk):
    watched = ["pg_catalog.pg_tables", "pg_catalog.pg_class", "pg_catalog.pg_attribute", "pg_catalog.pg_proc",
               "pg_catalog.pg_type", "information_schema.tables", "information_schema.columns"]
    other = ["pg_namespace", "pg_user", "pg_database", "pg_tablespace", "pg_extension"]
    rows = [row(T0 - sec(60), conn("eve"), pid=600)]
    qs = [f"SELECT * FROM {watched[i % len(watched)]}" for i in range(20)] + [f"SELECT * FROM {o}" for o in other]
    rows += [row(T0 + sec(i * 10), audit(i, "READ", "SELECT", "", "", q), pid=600) for i, q in enumerate(qs)]
    out = D.deep_schema_enum(mk(rows)).collect()
    assert [(r.SystemTableQueries, r.Severity, r.UniqueSystemTables) for r in out] == [(20, "HIGH", 7)]
    assert out[0].RiskLevel.startswith("HIGH")


def test_brute_force(mk):
    rows = [row(T0 + sec(3 * i), 'password authentication failed for user "bob" host=10.0.0.9', level="FATAL",
                code="28P01", pid=700 + i, backend="") for i in range(20)]
    out = D.brute_force(mk(rows)).collect()
    assert [(r.FailedAttempts, r.Severity, r.SourceHost, r.ServerName) for r in out] == [(20, "HIGH", "10.0.0.9", "Multiple")]
    by_code = D.brute_force_by_code(mk(rows)).collect()
    assert [(r.ClientHost, r.FailedAttempts, r.Severity, r.ErrorCodes) for r in by_code] == [("10.0.0.9", 20, "HIGH", "28P01")]


def quiet_traffic():
    rows = [row(T0 - sec(120), conn(f"user{p}"), pid=p) for p in range(10)]
    for m in range(10):                      # 3 SELECTs a minute, spread over sessions
        for k in range(3):
            pid = (m * 3 + k) % 10
            rows.append(row(T0 + sec(60 * m + 20 * k),
                            audit(m * 3 + k, "READ", "SELECT", "TABLE", "sales.customer", "q"), pid=pid))
        if m % 2 == 0:                       # one write every 2 minutes
            rows.append(row(T0 + sec(60 * m + 30), audit(100 + m, "WRITE", "UPDATE", "TABLE", "public.t", "u"),
                            pid=m % 10))
        if m % 5 == 0:                       # one error every 5 minutes
            rows.append(row(T0 + sec(60 * m + 45), "syntax error", level="ERROR", code="42601", pid=m % 10))
    return rows


def test_quiet_traffic_raises_nothing(mk):
    assert A.anomalies_union(mk(quiet_traffic())).count() == 0


def test_null_message_and_backend_rows_are_tolerated(mk):
    rows = quiet_traffic() + [(T0 + sec(1), None, "LOG", None, None, None, "srv1", "PostgreSQLLogs")]
    assert A.anomalies_union(mk(rows)).count() == 0


def test_anomalies_all_orders_newest_first(mk):
    rows = [row(T0 - sec(60), conn("alice"), pid=100)] + reads(20)
    rows += [row(T0 + sec(40 + i), "boom", level="ERROR", code="XX000", pid=9) for i in range(5)]
    out = A.anomalies_all(mk(rows)).collect()
    assert [r.AnomalyType for r in out] == ["Critical Error Spike", "Potential Data Exfiltration"]
    assert out[1].MetricName == "SelectCount" and out[1].MetricValue == 20


def test_alert_rules_thresholds(spark, mk):
    rows = [row(T0 + sec(i), "boom", level="ERROR", code="XX000") for i in range(9)]
    cands = A.alert_candidates(mk(rows))
    out = A.alert_rules(cands, A.rules_df(spark)).collect()
    assert [(r.RuleName, r.MetricValue, r.Severity, r.Action) for r in out] == [("Error Spike", 9.0, "HIGH", "Email")]
