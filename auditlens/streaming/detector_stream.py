"""Streaming detectors (D1-D7 in Structured Streaming; D1-D6 session-enriched).

Each detector reuses the batch detector's row preparation (filters, field
extraction, session join) on the stream -- with its filters kept above the
watermark -- then aggregates per event-time window and emits each finished
window once (append mode). The session lookup is a stored, small table
joined stream-static (see ``metric_stream.sessions_from_table``).
Small-domain sets (categories, codes, statements, levels) are kept; the
batch detectors' sample lists are not, because a bounded top-n per window
has no streaming aggregate with bounded state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions import patterns as P
from auditlens.functions.text import severity
from auditlens.functions.timefn import TS, above_watermark, duration, iso_datetime_text
from auditlens.operators.detectors import destructive_rows, error_spike_rows, privilege_rows
from auditlens.operators.sets import small_set

SRV = "LogicalServerName"


def _window_text(first: str, last: str) -> Column:
    return F.concat(iso_datetime_text(first), F.lit(" to "), iso_datetime_text(last))


def _users(full: bool = True):
    out = [F.max("FinalUser").alias("User")]
    if full:
        out += [F.max("FinalDatabase").alias("Database"), F.max("FinalHost").alias("SourceHost")]
    return out


def error_spike_stream(stream: DataFrame, sessions: DataFrame, *, bucket="1m", watermark="10 minutes",
                       threshold=3, high=8, critical=15) -> DataFrame:
    """D3: critical error spikes per server, backend and window."""
    df = error_spike_rows(stream.withWatermark(TS, watermark), sessions=sessions, wrap=above_watermark)
    agg = df.groupBy(SRV, "backend_type", F.window(TS, duration(bucket)).alias("w")).agg(
        F.count(F.lit(1)).alias("ErrorCount"), small_set("ErrorCategory").alias("ErrorTypes"),
        small_set("sqlerrcode").alias("ErrorCodes"), F.min(TS).alias("FirstError"), F.max(TS).alias("LastError"),
        *_users())
    agg = agg.where(F.col("ErrorCount") > threshold)
    return agg.select(
        F.col("LastError").alias("TimeGenerated"), F.lit("Critical Error Spike").alias("AnomalyType"),
        severity("ErrorCount", high, critical).alias("Severity"),
        F.col(SRV).alias("ServerName"), "User", "Database", "SourceHost",
        F.col("backend_type").alias("BackendType"), "ErrorCount", "ErrorTypes", "ErrorCodes",
        _window_text("FirstError", "LastError").alias("TimeWindow"))


def destructive_ops_stream(stream: DataFrame, sessions: DataFrame, *, bucket="2m", watermark="10 minutes",
                           threshold=5, high=10, critical=20) -> DataFrame:
    """Destructive bursts per server, backend and window."""
    df = destructive_rows(stream.withWatermark(TS, watermark), sessions=sessions, wrap=above_watermark)
    return _destructive(df, F.window(TS, duration(bucket)), threshold, high, critical)


def _destructive(df: DataFrame, window: Column, threshold, high, critical) -> DataFrame:
    agg = df.groupBy(SRV, "backend_type", window.alias("w")).agg(
        F.count(F.lit(1)).alias("OperationCount"), small_set("AuditStatement").alias("Operations"),
        small_set("TableAffected").alias("TablesAffected"), F.min(TS).alias("FirstOccurrence"),
        F.max(TS).alias("LastOccurrence"), *_users())
    agg = agg.where((F.col("OperationCount") > threshold) & (F.col("backend_type") == P.CLIENT_BACKEND))
    return agg.select(
        F.col("LastOccurrence").alias("TimeGenerated"), F.lit("Mass Destructive Operations").alias("AnomalyType"),
        severity("OperationCount", high, critical).alias("Severity"),
        F.col(SRV).alias("ServerName"), "User", "Database", "SourceHost",
        F.col("backend_type").alias("BackendType"), "OperationCount", "Operations", "TablesAffected",
        _window_text("FirstOccurrence", "LastOccurrence").alias("TimeWindow"))


def privilege_escalation_stream(stream: DataFrame, sessions: DataFrame, *, bucket="1h", watermark="10 minutes",
                                threshold=0, high=3, critical=5) -> DataFrame:
    """Role and grant changes per server and window."""
    df = privilege_rows(stream.withWatermark(TS, watermark), sessions=sessions, wrap=above_watermark)
    return _privilege(df, F.window(TS, duration(bucket)), threshold, high, critical)


def _privilege(df: DataFrame, window: Column, threshold, high, critical) -> DataFrame:
    agg = df.groupBy(SRV, window.alias("w")).agg(
        F.count(F.lit(1)).alias("PrivilegeOpsCount"), small_set("PrivilegeOp").alias("Operations"),
        small_set("LogType").alias("LogTypes"), F.min(TS).alias("FirstOp"), F.max(TS).alias("LastOp"),
        *_users(full=False))
    agg = agg.where(F.col("PrivilegeOpsCount") > threshold)
    return agg.select(
        F.col("LastOp").alias("TimeGenerated"), F.lit("Privilege Escalation").alias("AnomalyType"),
        severity("PrivilegeOpsCount", high, critical).alias("Severity"),
        F.col(SRV).alias("ServerName"), "User", "PrivilegeOpsCount", "Operations", "LogTypes",
        _window_text("FirstOp", "LastOp").alias("TimeWindow"))


def exfiltration_stream(stream: DataFrame, sessions: DataFrame, *, window=("5m", "1m"), watermark="10 minutes",
                        threshold=15, high=30, critical=50) -> DataFrame:
    """Reads per backend session over a sliding window ("last 5 minutes,
    re-evaluated every minute"); ``window=(size, None)`` is tumbling."""
    from auditlens.functions.timefn import hms
    from auditlens.operators.detectors import exfiltration_rows
    df = exfiltration_rows(stream.withWatermark(TS, watermark), sessions=sessions, wrap=above_watermark)
    size, slide = window
    win = F.window(TS, duration(size), duration(slide)) if slide else F.window(TS, duration(size))
    agg = df.groupBy(SRV, "backend_type", "processId", win.alias("w")).agg(
        F.count(F.lit(1)).alias("SelectCount"), F.min(TS).alias("FirstSeen"), F.max(TS).alias("LastSeen"),
        *_users())
    agg = agg.where(F.col("SelectCount") > threshold)
    return agg.select(
        F.col("LastSeen").alias("TimeGenerated"), F.lit("Potential Data Exfiltration").alias("AnomalyType"),
        severity("SelectCount", high, critical).alias("Severity"),
        F.col(SRV).alias("ServerName"), "User", "Database", "SourceHost",
        F.col("backend_type").alias("BackendType"), F.col("processId").alias("ProcessID"), "SelectCount",
        F.concat(hms("FirstSeen"), F.lit(" - "), hms("LastSeen")).alias("TimeWindow"))


def cross_schema_recon_stream(stream: DataFrame, sessions: DataFrame, *, bucket="10m", watermark="10 minutes",
                              threshold=4, high=5, critical=8, literal=False) -> DataFrame:
    """D5, exact: distinct counts are sizes of catalog-bounded sets."""
    from auditlens.operators.detectors import cross_schema_aggs, cross_schema_output, cross_schema_rows
    df = cross_schema_rows(stream.withWatermark(TS, watermark), sessions=sessions, literal=literal,
                           wrap=above_watermark)
    agg = df.groupBy(SRV, "processId", F.window(TS, duration(bucket)).alias("w")).agg(
        *cross_schema_aggs(streaming=True))
    return cross_schema_output(agg, threshold, high, critical)


def deep_schema_enum_stream(stream: DataFrame, sessions: DataFrame, *, bucket="5m", watermark="10 minutes",
                            threshold=10, high=15, critical=30, multi_table=5) -> DataFrame:
    """D6, exact (the set of system-table labels has 12 members)."""
    from auditlens.operators.detectors import deep_enum_aggs, deep_enum_output, deep_enum_rows
    df = deep_enum_rows(stream.withWatermark(TS, watermark), sessions=sessions, wrap=above_watermark)
    agg = df.groupBy(SRV, "processId", F.window(TS, duration(bucket)).alias("w")).agg(
        *deep_enum_aggs(streaming=True))
    return deep_enum_output(agg, threshold, high, critical, multi_table)


def brute_force_stream(stream: DataFrame, *, bucket="1h", watermark="10 minutes",
                       threshold=5, high=10, critical=20) -> DataFrame:
    """Failed authentications per client host and window. The per-host
    user/database lists are left out: an attack can spray any number of
    user names, so they would be unbounded state."""
    from auditlens.functions.timefn import hms
    from auditlens.operators.detectors import brute_force_rows
    df = brute_force_rows(stream.withWatermark(TS, watermark), wrap=above_watermark)
    agg = df.groupBy("ClientHost", F.window(TS, duration(bucket)).alias("w")).agg(
        F.count(F.lit(1)).alias("FailedAttempts"), F.min(TS).alias("FirstAttempt"),
        F.max(TS).alias("LastAttempt"))
    agg = agg.where(F.col("FailedAttempts") > threshold)
    return agg.select(
        F.col("LastAttempt").alias("TimeGenerated"), F.lit("Brute Force Authentication").alias("AnomalyType"),
        severity("FailedAttempts", high, critical).alias("Severity"), F.lit("Multiple").alias("ServerName"),
        F.col("ClientHost").alias("SourceHost"), "FailedAttempts",
        F.concat(hms("FirstAttempt"), F.lit(" - "), hms("LastAttempt")).alias("TimeWindow"))


def _live_lines(lines: DataFrame, stream: DataFrame, watermark: str, session_lookback: str, fields) -> DataFrame:
    from auditlens.streaming.session_stream import connection_stream, session_enrich_stream
    connections = connection_stream(stream, watermark=watermark, fields=fields)
    return session_enrich_stream(lines, connections, lookback=session_lookback, fields=fields)


def destructive_ops_live(stream: DataFrame, *, bucket="2m", watermark="10 minutes", session_lookback="24h",
                         threshold=5, high=10, critical=20) -> DataFrame:
    """D2 with sessions from the stream itself (stream-stream join)."""
    from auditlens.operators.detectors import destructive_lines, known_user
    from auditlens.streaming.session_stream import window_of
    lines = destructive_lines(stream.withWatermark(TS, watermark), wrap=above_watermark)
    df = _live_lines(lines, stream, watermark, session_lookback, ("User", "Database", "SourceHost")).where(known_user())
    return _destructive(df, window_of(bucket), threshold, high, critical)


def privilege_escalation_live(stream: DataFrame, *, bucket="1h", watermark="10 minutes", session_lookback="24h",
                              threshold=0, high=3, critical=5) -> DataFrame:
    """D4 with sessions from the stream itself (stream-stream join)."""
    from auditlens.operators.detectors import known_user, privilege_lines
    from auditlens.streaming.session_stream import window_of
    lines = privilege_lines(stream.withWatermark(TS, watermark), wrap=above_watermark)
    df = _live_lines(lines, stream, watermark, session_lookback, ("User",)).where(known_user())
    return _privilege(df, window_of(bucket), threshold, high, critical)
