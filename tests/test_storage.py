"""Stored bronze: date partitions, pruning and pushdown reach the scan."""

import datetime as dt
import tempfile

from log_rows import T0, audit, row

from auditlens.functions.timefn import since
from auditlens.sources.bronze import BRONZE_SCHEMA, read_bronze, write_bronze


def test_lookback_prunes_date_partitions_and_pushes_time_filter(spark):
    rows = [row(T0 - dt.timedelta(days=d, minutes=m), audit(d * 100 + m, "READ", "SELECT", "TABLE", "a.b", "q"))
            for d in range(5) for m in range(3)]
    path = tempfile.mkdtemp(prefix="al-bronze-") + "/bronze"
    write_bronze(spark.createDataFrame(rows, BRONZE_SCHEMA), path, mode="overwrite")
    b = read_bronze(spark, path)
    assert "event_date" in b.columns
    recent = since(b, T0, "24h").select("EventProcessedUtcTime", "message")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and ">= 2026-01-04" in plan
    assert "GreaterThanOrEqual(EventProcessedUtcTime" in plan
    assert "ReadSchema: struct<EventProcessedUtcTime:timestamp,message:string>" in plan
    assert recent.count() == 4   # 3 rows of day 0 + the one exactly 24 h back


def test_backfill_is_idempotent_and_date_partitioned(spark, mk):
    from auditlens.config import shared_dir
    from auditlens.operators.metrics import activity_backfill

    rows = [row(T0 + dt.timedelta(minutes=7 * i), audit(i, "READ", "SELECT", "TABLE", "a.b", "q")) for i in range(40)]
    b = mk(rows)
    path = shared_dir(spark, "test_backfill")
    first = activity_backfill(spark, b, path, lookback=None).count()
    again = activity_backfill(spark, b, path, lookback=None)
    assert again.count() == first and "metric_date" in again.columns
    recent = since(again, T0 + dt.timedelta(hours=5), "1h", ts="Timestamp")
    assert "PartitionFilters: [isnotnull(metric_date" in recent._jdf.queryExecution().executedPlan().toString()


def test_session_asof_follows_pid_reuse(spark, mk):
    from log_rows import conn

    from auditlens.operators.sessions import session_asof, session_info

    rows = [row(T0, conn("alice"), pid=42),
            row(T0 + dt.timedelta(minutes=5), audit(1, "READ", "SELECT", "TABLE", "a.b", "q"), pid=42),
            row(T0 + dt.timedelta(days=2), conn("bob"), pid=42),            # the pid is reused by bob
            row(T0 + dt.timedelta(days=2, minutes=1), audit(2, "READ", "SELECT", "TABLE", "a.b", "q"), pid=42),
            row(T0 - dt.timedelta(minutes=1), audit(0, "READ", "SELECT", "TABLE", "a.b", "q"), pid=42)]
    b = mk(rows)
    ev = b.where("message LIKE 'AUDIT%'").select("EventProcessedUtcTime", "LogicalServerName", "processId")
    got = sorted((r.EventProcessedUtcTime, r.AsOfUser) for r in session_asof(ev, b).collect())
    assert [u for _, u in got] == [None, "alice", "bob"]
    # the 24 h lookup of the reference picks one user for the pid (max)
    assert session_info(b, lookback=None).first().User == "bob"


def test_sql_views(spark, mk):
    from log_rows import conn

    from auditlens.plans.views import register_views

    rows = [row(T0 - dt.timedelta(minutes=1), conn("alice"), pid=100)]
    rows += [row(T0 + dt.timedelta(seconds=i), audit(i, "READ", "SELECT", "TABLE", "a.b", "q"), pid=100)
             for i in range(20)]
    register_views(spark, mk(rows))
    got = spark.sql("SELECT sum(ActivityCount) AS n, sum(SelectOps) AS s FROM activity_metrics").first()
    assert (got.n, got.s) == (21, 20)
    an = spark.sql("SELECT AnomalyType, MetricValue FROM anomalies").collect()
    assert [(r.AnomalyType, r.MetricValue) for r in an] == [("Potential Data Exfiltration", 20)]
    assert spark.sql("SELECT QueryCount FROM user_metrics").first().QueryCount == 20


def test_line_kind_flags_are_stored_and_pushed(spark):
    from log_rows import conn

    from auditlens.operators.detectors import error_spike
    from auditlens.operators.sessions import session_info

    rows = [row(T0, conn("a"), pid=1), row(T0, audit(1, "READ", "SELECT", "TABLE", "a.b", "q"), pid=1),
            row(T0, "boom", level="ERROR", code="XX000", pid=1)]
    path = tempfile.mkdtemp(prefix="al-flags-") + "/bronze"
    write_bronze(spark.createDataFrame(rows, BRONZE_SCHEMA), path, mode="overwrite")
    b = read_bronze(spark, path, normalized=True)
    got = {r.message[:5]: (r.is_audit, r.is_conn, r.is_err) for r in b.collect()}
    assert got == {"conne": (False, True, False), "AUDIT": (True, False, False), "boom": (False, False, True)}
    for df, f in ((session_info(b, lookback=None), "is_conn"), (error_spike(b, lookback=None), "is_err")):
        assert f"EqualTo({f},true)" in df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_backend_is_split_by_the_skew_join(spark, tmp_path):
    """A backend with a third of the rows: the session join shows a skew split."""
    from pyspark.sql import functions as F

    from auditlens.operators.sessions import KEYS, session_enrich

    n = 60_000
    pid = F.when(F.col("id") % 3 == 0, 7).otherwise(100 + F.col("id") % 400)
    ev = spark.range(n).select(pid.cast("long").alias("processId"), F.lit("srv1").alias("LogicalServerName"),
                               F.sha2(F.col("id").cast("string"), 512).alias("message"),
                               *[F.lit("").alias(c) for c in ("DirectUser", "DirectDatabase", "DirectHost")])
    ev.write.parquet(str(tmp_path / "ev"))
    ev = spark.read.parquet(str(tmp_path / "ev"))
    sessions = ev.groupBy(*KEYS).agg(F.max(F.lit("u")).alias("User"), F.max(F.lit("d")).alias("Database"),
                                     F.max(F.lit("h")).alias("SourceHost"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = session_enrich(ev, sessions).select("message", "FinalUser")
        out.write.format("noop").mode("overwrite").save()
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == n and {r.FinalUser for r in rows} == {"u"}
    assert "SortMergeJoin(skew=true)" in plan


def test_backfill_of_nothing_makes_an_empty_table(spark, mk, tmp_path):
    """A quiet period first, then lines, then another quiet one."""
    from log_rows import T0, conn, row
    from auditlens.operators.metrics import activity_backfill
    path = str(tmp_path / "activity")
    empty = activity_backfill(spark, mk([]), path, lookback=None)
    assert empty.count() == 0 and "ActivityCount" in empty.columns
    assert activity_backfill(spark, mk([row(T0, conn())]), path, lookback=None).count() == 1
    assert activity_backfill(spark, mk([]), path, lookback=None).count() == 1
