"""The parsed log, and the feed and alert rules that read it in one scan."""

from __future__ import annotations

import datetime as dt

import pytest
from log_rows import T0, audit, conn, row
from pyspark.sql import functions as F

from auditlens.operators import alerts as A
from auditlens.operators import detectors as D
from auditlens.operators.feed import anomalies_union, anomaly_details
from auditlens.sources.bronze import BRONZE_COLS, BRONZE_SCHEMA, normalize_bronze, read_bronze, write_bronze
from auditlens.sources.parsed import EXPRESSIONS, KINDS, is_parsed, stored

NOW = T0 + dt.timedelta(minutes=2)


def lines():
    s = dt.timedelta(seconds=1)
    out = [row(T0 - dt.timedelta(hours=1), conn("alice"), pid=1), row(T0 - dt.timedelta(hours=30), conn("zoe"), pid=1),
           row(T0, "connection received: host=10.0.0.9 user=rita port=1", pid=2),
           row(T0, conn("azuresu"), pid=3)]
    for pid in (1, 2, 3, 4):
        out += [row(T0 + i * s, audit(i, "READ", "SELECT", "TABLE", f"s{i % 6}.t", f"select {i}"), pid=pid)
                for i in range(18)]
        out += [row(T0 + i * s, audit(i, "WRITE", "DELETE", "TABLE", "s1.t", f"delete {i}"), pid=pid) for i in range(7)]
        out += [row(T0 + i * s, audit(i, "READ", "SELECT", "", "", "select * from pg_class"), pid=pid)
                for i in range(12)]
    out += [row(T0 + i * s, f"password authentication failed {i} host=10.9.9.9", "FATAL", "28P01", pid=9)
            for i in range(8)]
    out += [row(T0, "grant to nobody: GRANT x user=mallory", pid=8), row(T0, "GRANTED user=eve", pid=8),
            row(T0, "GRANT all", pid=1), row(T0 - dt.timedelta(hours=20), "REVOKE user=mallory", pid=8),
            row(None, audit(1, "READ", "SELECT", "TABLE", "s9.t"), pid=1), row(None, "boom", "ERROR", "XX000", pid=1),
            row(T0, "", None, None, None, None, None, None),
            row(T0, audit(1, "READ", "SELECT", "TABLE", "s1.t"), pid=1, category="Other"),
            row(T0, audit(1, "WRITE", "DELETE", "TABLE", "s1.t", "delete as user=bob,"), pid=5)]
    return out


@pytest.fixture(scope="module")
def logs(spark, tmp_path_factory):
    raw = normalize_bronze(spark.createDataFrame(lines(), BRONZE_SCHEMA))
    path = str(tmp_path_factory.mktemp("log") / "bronze")
    write_bronze(raw, path)
    return {"raw": raw, "parsed": read_bronze(spark, path, normalized=True)}


def test_stored_columns_are_those_of_the_expressions(logs):
    parsed = logs["parsed"]
    assert is_parsed(parsed) and not is_parsed(logs["raw"])
    again = parsed.select(*BRONZE_COLS).withColumns({n: e() for n, e in EXPRESSIONS.items()})
    pick = [*BRONZE_COLS, *EXPRESSIONS]
    assert parsed.select(*pick).exceptAll(again.select(*pick)).count() == 0
    assert parsed.where(" or ".join(f"{n} is null" for n in EXPRESSIONS)).count() == 0
    assert all(parsed.where(n).count() for n in KINDS if n != "t_activity_ddl")


def test_an_older_table_keeps_its_columns(spark, tmp_path):
    """Appends to a table written before its log was parsed leave the columns out."""
    path = str(tmp_path / "old")
    rows = normalize_bronze(spark.createDataFrame(lines(), BRONZE_SCHEMA))
    rows.withColumn("event_date", F.to_date("EventProcessedUtcTime")).write.partitionBy("event_date").parquet(path)
    write_bronze(rows, path)
    log = read_bronze(spark, path, normalized=True)
    assert not is_parsed(log)
    assert D.brute_force(log, lookback=None).first().FailedAttempts == 16


DETECTORS = {"Potential Data Exfiltration": (D.exfiltration, "SelectCount"),
             "Mass Destructive Operations": (D.destructive_ops, "OperationCount"),
             "Critical Error Spike": (D.error_spike, "ErrorCount"),
             "Privilege Escalation": (D.privilege_escalation, "PrivilegeOpsCount"),
             "Cross-Schema Reconnaissance": (D.cross_schema_recon, "SchemasAccessed"),
             "Deep Schema Enumeration": (D.deep_schema_enum, "SystemTableQueries"),
             "Brute Force Authentication": (D.brute_force, "FailedAttempts")}


@pytest.mark.parametrize("log", ["raw", "parsed"])
@pytest.mark.parametrize("whole", [False, True])
def test_the_feed_has_the_rows_of_the_single_detectors(logs, log, whole):
    """With the reference's windows, and over the whole history."""
    kw = {"lookback": None, "session_lookback": None} if whole else {}
    params = {k: dict(kw) for k in A.UNION_KINDS}
    cols = ["TimeGenerated", "AnomalyType", "Severity", "ServerName", "MetricValue", "TimeWindow"]
    feed = anomalies_union(logs[log], as_of=NOW, params=params)
    got = sorted(tuple(r) for r in feed.select(*cols, F.coalesce("User", F.lit("")).alias("u")).collect())
    want = []
    for kind, (fn, metric) in DETECTORS.items():
        here = {k: v for k, v in kw.items() if k == "lookback" or fn is not D.brute_force}
        rows = fn(logs["raw"], as_of=NOW, **here).collect()
        assert whole or rows, kind
        want += [(r.TimeGenerated, r.AnomalyType, r.Severity, r.ServerName, r[metric], r.TimeWindow,
                  r.User if "User" in r else "") for r in rows]
    assert got == sorted(want)


def test_details_are_a_map_with_whole_sets(logs):
    row_ = (anomalies_union(logs["parsed"], as_of=NOW).where("MetricName = 'SchemasAccessed' and User = 'alice'").first())
    assert row_.Details == {"SchemaList": "s0, s1, s2, s3, s4, s5", "TablesAccessed": "6", "TimeWindow": row_.TimeWindow}
    long = anomaly_details(anomalies_union(logs["parsed"], as_of=NOW))
    assert {r.DetailValue for r in long.where("Detail = 'SchemaList'").collect()} == {"s0, s1, s2, s3, s4, s5"}


def scans(df) -> int:
    df.collect()
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_feed_and_rules_scan_the_log_once_and_its_connections_once(logs):
    assert scans(anomalies_union(logs["parsed"], as_of=NOW)) == 2
    assert scans(A.alert_candidates(logs["parsed"], as_of=NOW)) == 1


def test_parsed_queries_read_flags_instead_of_messages(logs):
    from auditlens.operators.dashboards import privilege_ops_by_user
    plan = privilege_ops_by_user(logs["parsed"], lookback=None)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    assert "EqualTo(t_privilege_activity,true)" in scan and "message" not in scan


def test_alert_candidates_equal_the_rules_one_by_one(logs):
    """Each rule's rows, filtered and grouped on their own, as the streams do."""
    for log in logs.values():
        got = {tuple(r) for r in A.alert_candidates(log, as_of=NOW).collect()}
        want = set()
        from auditlens.functions.timefn import TS, bin_ts
        for rule, df, keys, bucket, distinct in A.alert_inputs(log, as_of=NOW):
            start = bin_ts(TS, bucket) if bucket else F.lit(None).cast(df.schema[TS].dataType)
            n = F.count_distinct(distinct) if distinct else F.count(F.lit(1))
            agg = df.withColumn("w", start).groupBy(*keys, "w").agg(n.cast("double").alias("n"), F.max(TS).alias("t"))
            want |= {(rule, r.LogicalServerName, "|".join("" if r[k] is None else str(r[k]) for k in keys), r.w, r.n, r.t)
                     for r in agg.collect()}
        assert got == want and len({r[0] for r in got}) == 6


def test_stored_falls_back_without_a_frame():
    assert "regexp_extract" in str(stored(None, "p_user"))
