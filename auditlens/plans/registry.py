"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

Each entry reads the driver's tables under ``sf_dir`` (the raw log is
derived from ``events``) and runs one operator over the whole history with
the ``profile.HUNT`` parameters. Array columns are rendered as ", "-joined
text (the reference's ``strcat_array``) so results compare as plain values.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.config import shared_dir
from auditlens.functions.timefn import TS
from auditlens.operators import alerts as A
from auditlens.operators import dashboards as Q
from auditlens.operators import detectors as D
from auditlens.operators import metrics as M
from auditlens.operators import series as SR
from auditlens.operators.sessions import backend_sessions, backend_sessions_stream
from auditlens.plans.profile import HUNT, HUNT_RULES
from auditlens.sources.events_adapter import load_bronze
from auditlens.sources.parsed import stored


def display(df: DataFrame) -> DataFrame:
    """Arrays -> ', '-joined strings, everything else unchanged."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            cols.append(F.coalesce(F.array_join(F.col(f.name), ", "), F.lit("")).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _detector(fn, key):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return display(fn(load_bronze(spark, sf_dir), **HUNT[key]))
    run.__name__ = key
    return run


_DETECTORS = {
    "exfiltration": D.exfiltration,
    "destructive_ops": D.destructive_ops,
    "error_spike": D.error_spike,
    "privilege_escalation": D.privilege_escalation,
    "cross_schema_recon": D.cross_schema_recon,
    "deep_schema_enum": D.deep_schema_enum,
    "brute_force": D.brute_force,
    "brute_force_by_code": D.brute_force_by_code,
    "error_spike_5m": D.error_spike_5m,
    "exfiltration_by_user": D.exfiltration_by_user,
    "quick_exfil": D.quick_exfil,
    "quick_destructive": D.quick_destructive,
    "quick_errors": D.quick_errors,
    "quick_privilege": D.quick_privilege,
}


def _on_bronze(fn, **kw):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return display(fn(load_bronze(spark, sf_dir), **kw))
    return run


def _on_metrics(fn, **kw):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return display(fn(M.activity_metrics(load_bronze(spark, sf_dir)), **kw))
    return run


def _activity_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "activity_metrics")
    stored = M.activity_backfill(spark, load_bronze(spark, sf_dir), path, lookback=None)
    return stored.drop("metric_date")


_DASHBOARDS = {
    "activity_by_server": (Q.activity_by_server, {}),
    "audit_distribution": (Q.audit_distribution, {}),
    "top_tables": (Q.top_tables, {}),
    "audit_timeline": (Q.audit_timeline, {}),
    "errors_by_category": (Q.errors_by_category, {}),
    "activity_by_backend": (Q.activity_by_backend, {}),
    "top_users": (Q.top_users, {}),
    "top_hosts": (Q.top_hosts, {}),
    "user_db_heatmap": (Q.user_db_heatmap, {}),
    "auth_failures": (Q.auth_failures, {}),
    "top_error_codes": (Q.top_error_codes, {}),
    "audit_coverage": (Q.audit_coverage, {}),
    "backend_distribution": (Q.backend_distribution, {}),
    "error_code_diagnostics": (Q.error_code_diagnostics, {}),
    "privilege_ops_by_user": (Q.privilege_ops_by_user, {}),
    "errors_per_minute": (Q.errors_per_minute, {}),
    "connection_sample": (Q.connection_sample, {}),
    "current_activity": (Q.current_activity, {}),
}


HUNT_UNION = {k: HUNT[k] for k in A.UNION_KINDS}
HUNT_ALERT_WINDOWS = {r: (None, None if r == "Data Exfil" else "1d") for r in A.ALERT_WINDOWS}


def _anomalies_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.anomalies_all(load_bronze(spark, sf_dir), params=HUNT_UNION)


def _security_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = load_bronze(spark, sf_dir)
    return A.security_kpis(A.anomalies_union(bronze, params=HUNT_UNION), bronze, lookback=None)


def _alert_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = load_bronze(spark, sf_dir)
    cands = A.alert_candidates(bronze, windows=HUNT_ALERT_WINDOWS)
    ml = A.ml_candidates(SR.series_anomalies(M.activity_metrics(bronze), lookback=None, report=None))
    return A.alert_rules(cands.unionByName(ml), A.rules_df(spark))


def _anomaly_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D12's rows in long form, one per entry of the Details map."""
    from auditlens.operators.feed import anomaly_details
    return anomaly_details(A.anomalies_union(load_bronze(spark, sf_dir), params=HUNT_UNION))


def _condition_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts by severity and score, on the feed and the baseline deviations."""
    bronze = load_bronze(spark, sf_dir)
    ml = SR.series_anomalies(M.activity_metrics(bronze), lookback=None, report=None)
    return A.condition_alerts(A.scored_rows(A.anomalies_union(bronze, params=HUNT_UNION), ml))


def _activity_rollup(bucket: str):
    """Totals of longer buckets from the stored 5-minute rows with sketches."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = M.sketch_backfill(spark, load_bronze(spark, sf_dir), shared_dir(spark, "sketches"), lookback=None)
        return M.roll_up(table, bucket)
    return run


def _backend_sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spells of activity as a stream: a spell is emitted when the watermark passes its end."""
    out = _replay(spark, sf_dir, "backend_sessions", lambda s: backend_sessions_stream(s, gap="1d"))
    return _ntz(out, "SessionStart", "LastEvent")


def _recent_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL table function with a lookback, called from SQL: errors of the last week by server."""
    from auditlens.plans.views import register_functions
    register_functions(spark, load_bronze(spark, sf_dir), anomaly_params=HUNT_UNION)
    return spark.sql("SELECT ServerName, count(*) AS Minutes, sum(ErrorRate) AS Errors, max(Timestamp) AS LastMinute "
                     "FROM recent_errors(168) GROUP BY ServerName")


def _run_stream(df: DataFrame, spark: SparkSession, name: str, out: str | None = None, ck: str | None = None) -> DataFrame:
    """Run a streaming query over everything available, return its output table."""
    out, ck = out or shared_dir(spark, name), ck or shared_dir(spark, name + "_ck")
    q = (df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ck)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    return spark.read.parquet(out)


#: Where the log is cut into what a replay lands first and later, and how far
#: past its end the closing heartbeat lies.
REPLAY_CUT, REPLAY_REST = "2024-01-15 10:02:00", dt.timedelta(days=8)


def _landings(spark: SparkSession, sf_dir: str, name: str):
    """A landing folder, filled in two steps: the older part of the log, then the rest and
    a heartbeat that closes the last windows. Yields the folder after each step."""
    from auditlens.sources.bronze import BRONZE_COLS
    from auditlens.streaming.sources import write_heartbeat
    hub, log = shared_dir(spark, name + "_hub"), load_bronze(spark, sf_dir).select(*BRONZE_COLS)
    older = F.col(TS) < F.lit(REPLAY_CUT).cast("timestamp_ntz")
    log.where(older).write.parquet(hub)
    yield hub
    log.where(~older).write.mode("append").parquet(hub)
    newest = log.agg(F.max(TS)).first()[0]
    if newest is not None:
        write_heartbeat(spark, hub, newest + REPLAY_REST, fmt="parquet")
    yield hub


def _replay(spark: SparkSession, sf_dir: str, name: str, query) -> DataFrame:
    """The output of an append-mode ``query(stream)`` over the log, landed in two steps: the
    query is stopped in between and goes on from its checkpoint."""
    from auditlens.streaming.sources import bronze_stream
    out, ck = shared_dir(spark, name), shared_dir(spark, name + "_ck")
    for hub in _landings(spark, sf_dir, name):
        result = _run_stream(query(bronze_stream(spark, hub, fmt="parquet")), spark, name, out, ck)
    return result


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _metric_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from auditlens.streaming.metric_stream import activity_metrics_stream
    return _ntz(_replay(spark, sf_dir, "metric_stream", activity_metrics_stream), "Timestamp")


def _error_metric_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from auditlens.streaming.metric_stream import error_metrics_stream
    return _ntz(_replay(spark, sf_dir, "error_metric_stream", error_metrics_stream), "Timestamp")


def _user_metric_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-static join: the session lookup comes from the stored bronze
    table, the AUDIT rows from the stream."""
    from auditlens.operators.sessions import session_info
    from auditlens.streaming.metric_stream import user_metrics_stream
    # the static side of a stream-static join is re-read every micro-batch:
    # materialise the (small) lookup once instead of re-aggregating the log
    shared_dir(spark)
    sessions = session_info(load_bronze(spark, sf_dir), lookback=None, fields=("User",)).checkpoint(eager=True)
    return _ntz(_replay(spark, sf_dir, "user_metric_stream", lambda s: user_metrics_stream(s, sessions)), "Timestamp")


def _detector_state(kind: str):
    """A detector kept up to date by a stream: the older part of the log, then the rest, as
    micro-batches into its mergeable state; windows of the history-hunt profile (a day, or the
    whole history), sessions of any time, all columns, open windows included."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from auditlens.streaming.detector_state import detector_table, start_detector_state
        from auditlens.streaming.sources import bronze_stream
        state, ck = shared_dir(spark, kind + "_state"), shared_dir(spark, kind + "_ck")
        for hub in _landings(spark, sf_dir, kind):
            start_detector_state(bronze_stream(spark, hub, fmt="parquet"), state, ck, (kind,), buckets={kind: "1d"},
                                 fold_every=None, trigger={"availableNow": True}).awaitTermination()
        windowed = HUNT[kind].get("bucket") is not None
        return display(_ntz(detector_table(spark, state, kind, session_lookback=None, windowed=windowed), "TimeGenerated"))
    run.__name__ = kind + "_stream"
    return run


def _session_stream(kind: str):
    """D2 and D4 over lines that find their session in the stream itself: the newest
    connection of the 24 hours before, by a stream-stream join."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from auditlens.streaming import detector_stream as DS
        fn = {"destructive_ops": DS.destructive_ops_live, "privilege_escalation": DS.privilege_escalation_live}[kind]
        out = _replay(spark, sf_dir, kind + "_live", lambda s: fn(s, bucket="1d"))
        return display(_ntz(out, "TimeGenerated"))
    run.__name__ = kind + "_live"
    return run


def _session_enrich_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I5 in a stream: every AUDIT line with the newest connection of the 24 hours before."""
    from auditlens.functions.text import contains
    from auditlens.functions.timefn import above_watermark
    from auditlens.operators.parse import conn_parse
    from auditlens.streaming.session_stream import connection_stream, session_enrich_stream

    def lines(stream: DataFrame) -> DataFrame:
        audit = stream.withWatermark(TS, "10 minutes").where(above_watermark(contains("message", "AUDIT:")))
        out = session_enrich_stream(conn_parse(audit), connection_stream(stream))
        return out.select(TS, "LogicalServerName", "processId", "FinalUser", "FinalDatabase", "FinalHost")

    return _ntz(_replay(spark, sf_dir, "session_enrich_stream", lines), TS)


def _quick_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = {"exfil": HUNT["quick_exfil"], "destructive": HUNT["quick_destructive"],
              "errors": HUNT["quick_errors"], "privilege": HUNT["quick_privilege"]}
    return D.quick_all(load_bronze(spark, sf_dir), **params)


STREAM_DAY = {r: (None, "1d") for r in A.ALERT_WINDOWS}


def _alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log rules as one stream, the ML rule as another against a stored model."""
    from auditlens.streaming import alert_stream as AS
    from auditlens.streaming.sources import bronze_stream
    model, ml, ml_ck, out, ck = (shared_dir(spark, n) for n in (
        "baseline_model", "ml_alerts", "ml_ck", "alert_stream", "alert_stream_ck"))
    SR.fit_baseline(M.activity_metrics(load_bronze(spark, sf_dir)), lookback=None).write.parquet(model)
    rules = A.rules_df(spark, HUNT_RULES)
    for hub in _landings(spark, sf_dir, "alert_stream"):
        stream = bronze_stream(spark, hub, fmt="parquet")
        AS.start_ml_alerts(stream, model, rules, ml, ml_ck, trigger={"availableNow": True}).awaitTermination()
        log = _run_stream(AS.alert_stream(stream, rules, windows=STREAM_DAY), spark, "alert_stream", out, ck)
    return _ntz(log.unionByName(AS.read_ml_alerts(spark, ml)), "WindowStart", "TimeGenerated")


def _baseline_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8's stored model, one row per server."""
    model = SR.fit_baseline(M.activity_metrics(load_bronze(spark, sf_dir)), lookback=None)
    rounded = [(F.round(c, 9) + F.lit(0.0)).alias(c) for c in ("slope", "icpt", "q10", "q90")]   # no -0.0
    return model.select("ServerName", "origin", "period", "n", *rounded, F.size("slots").cast("long").alias("n_slots"))


def _activity_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``make-series`` as it stands: one row per server, times and counts as arrays."""
    packed = SR.pack_series(SR.make_series(M.activity_metrics(load_bronze(spark, sf_dir)), lookback=None))
    return display(packed.select("ServerName", F.size("v").cast("long").alias("Points"),
                                 F.element_at("Timestamp", 1).alias("FirstPoint"),
                                 F.element_at("Timestamp", -1).alias("LastPoint"),
                                 F.col("v").cast("array<string>").alias("ActivityCounts")))


def _series_expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series as arrays, decomposed, then expanded in parallel: every point with its baseline and flag."""
    packed = SR.pack_series(SR.make_series(M.activity_metrics(load_bronze(spark, sf_dir)), lookback=None))
    arrays = SR.decompose_packed(packed)
    points = SR.expand_series(arrays, ["Timestamp", "v", "anomalies", "score", "baseline"], types={"anomalies": "double"})
    return points.select("ServerName", "Timestamp", F.col("v").alias("ActivityCount"), "anomalies",
                         *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("score", "baseline")])


def _stream_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows, counted: every seventh backend's older lines land only with the second step."""
    from auditlens.sources.bronze import BRONZE_COLS
    from auditlens.streaming.health import read_health, start_health
    from auditlens.streaming.sources import bronze_stream
    hub, path, ck = (shared_dir(spark, n) for n in ("health_hub", "stream_health", "health_ck"))
    log = load_bronze(spark, sf_dir).select(*BRONZE_COLS)
    first = (F.col(TS) < F.lit(REPLAY_CUT).cast("timestamp_ntz")) & (F.col("processId") % 7 != 0)
    for part in (log.where(first), log.where(~F.coalesce(first, F.lit(False)))):
        part.write.mode("append").parquet(hub)
        start_health(bronze_stream(spark, hub, fmt="parquet"), path, ck, trigger={"availableNow": True}).awaitTermination()
    return _ntz(read_health(spark, path).drop("ProcessedAt"), "OldestEvent", "NewestEvent", "Watermark")


def _alert_once_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per rule, key and burst, as soon as its first window fires."""
    from auditlens.streaming.alert_stream import alert_once_stream
    return _ntz(_replay(spark, sf_dir, "alert_once", lambda s: alert_once_stream(
        s, A.rules_df(spark), quiet="7d", windows=STREAM_DAY)), "Burst")


def _alert_burst_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every burst as one row, with its span and peak, when it is over."""
    from auditlens.streaming.alert_stream import alert_burst_stream
    return _ntz(_replay(spark, sf_dir, "alert_burst", lambda s: alert_burst_stream(
        s, A.rules_df(spark), quiet="2d", windows=STREAM_DAY)), "BurstStart", "BurstEnd", "TimeGenerated")


def _bronze_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log records exported as JSON (the hub format) read back with the
    fixed schema, no inference."""
    from auditlens.sources.bronze import read_bronze_json
    from auditlens.sources.events_adapter import bronze_from_events, load_events
    path = shared_dir(spark, "hub_json")
    (bronze_from_events(load_events(spark, sf_dir)).write.mode("overwrite")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path))
    out = read_bronze_json(spark, path)
    return out.withColumn("EventProcessedUtcTime", F.col("EventProcessedUtcTime").cast("timestamp_ntz"))


def _ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that holds history (batch) and stream together: the older
    part of the log is written at once, the rest lands as a stream of JSON."""
    from auditlens.sources.bronze import BRONZE_COLS, read_bronze, write_bronze
    from auditlens.sources.events_adapter import bronze_from_events, load_events
    from auditlens.streaming.sources import bronze_stream, write_bronze_stream
    log = bronze_from_events(load_events(spark, sf_dir))
    new = F.col("EventProcessedUtcTime") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    path, hub, ck = (shared_dir(spark, n) for n in ("live_log", "live_hub", "live_ck"))
    write_bronze(log.where(~new), path)
    log.where(new).write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(hub)
    stream = bronze_stream(spark, hub, max_files_per_trigger=2)
    write_bronze_stream(stream, path, ck, trigger={"availableNow": True}).awaitTermination()
    return read_bronze(spark, path, normalized=True).select(*BRONZE_COLS)


def _session_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session table as ingest keeps it: the older part of the log as a batch, the rest as a stream."""
    from auditlens.operators.session_table import read_session_spans, write_session_spans
    from auditlens.sources.bronze import BRONZE_COLS
    from auditlens.streaming.sources import bronze_stream, write_bronze_stream
    log = load_bronze(spark, sf_dir)
    older = F.col(TS) < F.lit(REPLAY_CUT).cast("timestamp_ntz")
    hub, live, spans, ck = (shared_dir(spark, n) for n in ("spans_hub", "spans_log", "session_spans", "spans_ck"))
    write_session_spans(log.where(older), spans)
    log.where(~F.coalesce(older, F.lit(False))).select(*BRONZE_COLS).write.parquet(hub)
    write_bronze_stream(bronze_stream(spark, hub, fmt="parquet"), live, ck, trigger={"availableNow": True},
                        sessions=spans).awaitTermination()
    return read_session_spans(spark, spans)


def _session_table(lookback: str | None):
    """I4 from the stored table; "now" is the newest line of the log."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from auditlens.functions.timefn import resolve_as_of
        from auditlens.operators.session_table import sessions_at
        as_of = resolve_as_of(load_bronze(spark, sf_dir)) if lookback else None
        return sessions_at(_session_spans(spark, sf_dir), as_of, lookback)
    return run


def _anomalies_stored_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed with its sessions from the stored table."""
    from auditlens.operators.feed import anomaly_details
    return anomaly_details(A.anomalies_union(load_bronze(spark, sf_dir), params=HUNT_UNION,
                                             spans=_session_spans(spark, sf_dir)))


def _backfill_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I7 run twice: the first time the log ends inside a bucket."""
    path, log = shared_dir(spark, "activity_metrics"), load_bronze(spark, sf_dir)
    early = F.col("EventProcessedUtcTime") < F.lit("2024-01-15 10:02:00").cast("timestamp_ntz")
    M.activity_backfill(spark, log.where(early), path, lookback=None)
    return M.activity_backfill(spark, log, path, lookback=None).drop("metric_date")


def _backfill(fn, name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, load_bronze(spark, sf_dir), shared_dir(spark, name), lookback=None).drop("metric_date")
    return run


def _audit_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    from auditlens.operators.parse import audit_fields
    b = load_bronze(spark, sf_dir)
    b = b.where(stored(b, "is_audit"))
    return b.select("EventProcessedUtcTime", "LogicalServerName", "processId",
                    *[c.alias(n) for n, c in audit_fields(df=b).items()])


def _conn_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    from auditlens.operators.parse import conn_fields
    b = load_bronze(spark, sf_dir)
    b = b.where(stored(b, "is_conn"))
    return b.select("EventProcessedUtcTime", "LogicalServerName", "processId",
                    *[c.alias(n) for n, c in conn_fields(df=b).items()])


def _session_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    from auditlens.operators.sessions import session_info
    return session_info(load_bronze(spark, sf_dir), lookback=None)


def _session_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    from auditlens.operators.parse import conn_parse
    from auditlens.operators.sessions import session_enrich, session_info
    b = load_bronze(spark, sf_dir)
    ev = conn_parse(b.where(stored(b, "is_audit")))
    out = session_enrich(ev, session_info(b, lookback=None))
    return out.select("EventProcessedUtcTime", "LogicalServerName", "processId",
                      "FinalUser", "FinalDatabase", "FinalHost")


def _session_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    from auditlens.operators.sessions import session_asof
    b = load_bronze(spark, sf_dir)
    ev = b.where(stored(b, "is_audit")).select("EventProcessedUtcTime", "LogicalServerName", "processId")
    return session_asof(ev, b)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {k: _detector(fn, k) for k, fn in _DETECTORS.items()}
    out.update({"bronze": _bronze_json, "audit_parse": _audit_parse, "conn_parse": _conn_parse,
                "session_info": _session_info, "session_enrich": _session_enrich,
                "session_asof": _session_asof})
    out["metric_stream"] = _metric_stream
    out["error_metric_stream"] = _error_metric_stream
    for k in ("exfiltration", "destructive_ops", "error_spike", "privilege_escalation", "cross_schema_recon",
              "deep_schema_enum", "brute_force"):
        out[k + "_stream"] = _detector_state(k)
    for k in ("destructive_ops", "privilege_escalation"):
        out[k + "_live"] = _session_stream(k)
    out["session_enrich_stream"] = _session_enrich_stream
    out["user_metric_stream"] = _user_metric_stream
    out["quick_all"] = _quick_all
    out["auth_error_diagnostics"] = _on_bronze(Q.error_code_diagnostics, lookback=None, auth_only=True)
    out["audit_timeline_6way"] = _on_bronze(Q.audit_timeline, lookback=None, include_misc=False)
    out["cross_schema_recon_literal"] = _on_bronze(D.cross_schema_recon, literal=True,
                                                   **HUNT["cross_schema_recon"])
    out["alert_stream"] = _alert_stream
    out["baseline_model"] = _baseline_model
    out["alert_once_stream"] = _alert_once_stream
    out["alert_burst_stream"] = _alert_burst_stream
    out["activity_series"] = _activity_series
    out["series_expanded"] = _series_expanded
    out["stream_health"] = _stream_health
    out["session_table"] = _session_table(None)
    out["session_table_window"] = _session_table("24h")
    out["anomaly_details_stored"] = _anomalies_stored_sessions
    out["exfiltration_by_message_user"] = _on_bronze(D.exfiltration_by_message_user, lookback=None)
    out["ingest_stream"] = _ingest_stream
    out["backfill_resumed"] = _backfill_resumed
    out["error_backfill"] = _backfill(M.error_backfill, "error_metrics")
    out["user_backfill"] = _backfill(M.user_backfill, "user_metrics")
    out["ddl_offhours"] = _on_metrics(D.privilege_offhours, lookback=None, ops="DDLOps")
    out["anomalies_all"] = _anomalies_all
    out["security_kpis"] = _security_kpis
    out["anomaly_details"] = _anomaly_details
    out["condition_alerts"] = _condition_alerts
    out["activity_rollup_hour"] = _activity_rollup("1h")
    out["activity_rollup_day"] = _activity_rollup("1d")
    out["backend_sessions"] = _on_bronze(backend_sessions, lookback=None, gap="1d")
    out["backend_sessions_stream"] = _backend_sessions_stream
    out["recent_errors_sql"] = _recent_errors
    out["alert_rules"] = _alert_rules
    out.update({
        "activity_metrics": _on_bronze(M.activity_metrics),
        "activity_backfill": _activity_backfill,
        "error_metrics": _on_bronze(M.error_metrics),
        "user_metrics": _on_bronze(M.user_metrics, session_lookback=None),
        "privilege_offhours": _on_metrics(D.privilege_offhours, lookback=None),
        "baseline_deviation": _on_metrics(SR.baseline_deviation, lookback=None, report=None),
        "baseline_deviation_pct": _on_metrics(SR.baseline_deviation_pct, lookback=None, report=None),
        "metrics_latest": _on_metrics(Q.metrics_latest),
        "metrics_stats": _on_metrics(Q.metrics_stats, lookback=None),
        "metrics_status": _on_metrics(Q.metrics_status),
        "history_depth": _on_metrics(Q.history_depth, lookback=None),
        "hourly_profile": _on_metrics(Q.hourly_profile),
        "data_freshness": _on_bronze(Q.data_freshness),
        "active_users_today": _on_bronze(Q.active_users_today),
    })
    for k, (fn, kw) in _DASHBOARDS.items():
        out[k] = _on_bronze(fn, lookback=None, **kw)
    from auditlens.plans import windowed
    return out | windowed.queries()
