"""Security detectors over the raw log.

Every detector has the same plan shape: time filter -> cheap predicates ->
field extraction -> session lookup -> group -> ``count > threshold`` ->
severity -> projection. Windows, lookbacks and thresholds are keyword
parameters whose defaults are the reference's values.

Conventions
* ``as_of`` is "now" (a datetime or Column); when a lookback is given and
  ``as_of`` is None the newest event time is used (replays).
* ``lookback=None`` scans the whole history; ``bucket=None`` (where the
  reference has a bin) groups the whole lookback as one window.
* ``any()`` is ``max``; ``make_set(x, n)`` is the n smallest distinct
  non-empty values, computed in the same pass as the other aggregates
  (``sets.aggregate_with_sets``); small-domain sets use ``collect_set``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions import patterns as P
from auditlens.functions.text import (contains, extract, first_non_empty, has_any,
                                      is_empty, is_not_empty, label_case, severity, trim_chars)
from auditlens.functions.timefn import TS, bin_ts, hms, iso_datetime_text, resolve_as_of, since
from auditlens.operators.parse import conn_fields, query_text, schema_of
from auditlens.operators.sessions import CONN_TERMS_AUTHORIZED, join_sessions, session_enrich, session_info
from auditlens.operators.sets import aggregate_with_sets, join_set, small_set
from auditlens.sources.bronze import CATEGORY
from auditlens.sources.parsed import flag, stored

SRV = "LogicalServerName"


def _as_of(bronze: DataFrame, as_of, *lookbacks):
    """Resolved once for all lookbacks of a detector."""
    return resolve_as_of(bronze, as_of) if any(lb is not None for lb in lookbacks) else as_of


def _window_text(first: str, last: str) -> Column:
    return F.concat(iso_datetime_text(first), F.lit(" to "), iso_datetime_text(last))


def _hms_window(first: str, last: str) -> Column:
    return F.concat(hms(first), F.lit(" - "), hms(last))


def _bucketed(df: DataFrame, bucket) -> tuple[DataFrame, list[str]]:
    if bucket is None:
        return df, []
    return df.withColumn("Bucket", bin_ts(TS, bucket)), ["Bucket"]


def _is_category(df: DataFrame) -> Column:
    return F.col("category") == CATEGORY


def _client() -> Column:
    return F.col("backend_type") == P.CLIENT_BACKEND


# --------------------------------------------------------------------- D1
def exfiltration_match(df: DataFrame) -> Column:
    """Whether a log line counts for D1, its session left aside."""
    return (stored(df, "is_audit") & _is_category(df) & stored(df, "t_exfil") & _client()
            & ((stored(df, "p_class") == "READ") | (stored(df, "p_statement") == "SELECT")))


def exfiltration_lines(bronze: DataFrame, *, as_of=None, lookback=None, wrap=None) -> DataFrame:
    """D1's log lines, before their session is known."""
    df = since(bronze, as_of, lookback).where(_keeper(wrap)(exfiltration_match(bronze)))
    return df.withColumns({
        "AuditOperation": stored(bronze, "p_class"),
        "AuditStatement": stored(bronze, "p_statement"),
        "TableName": stored(bronze, "p_object_type"),
        "QueryText": query_text(),
        **conn_fields(df=bronze)})


def not_superuser() -> Column:
    return F.col("FinalUser") != P.SUPERUSER


def known_user() -> Column:
    return ~F.col("FinalUser").isin(*P.SYSTEM_USERS, P.UNKNOWN)


def exfiltration_rows(bronze: DataFrame, *, as_of=None, lookback=None, session_lookback=None,
                      sessions: DataFrame | None = None, wrap=None) -> DataFrame:
    """D1's enriched input rows (shared by the batch and streaming detector)."""
    df = exfiltration_lines(bronze, as_of=as_of, lookback=lookback, wrap=wrap)
    if sessions is None:
        sessions = session_info(bronze, as_of, session_lookback)
    return session_enrich(df, sessions).where(_keeper(wrap)(not_superuser()))


def exfiltration(bronze: DataFrame, *, as_of=None, lookback="5m", bucket=None,
                 threshold=15, high=30, critical=50, session_lookback="24h",
                 sessions: DataFrame | None = None) -> DataFrame:
    """Mass data exfiltration: many reads by one backend session."""
    as_of = _as_of(bronze, as_of, lookback, session_lookback if sessions is None else None)
    df = exfiltration_rows(bronze, as_of=as_of, lookback=lookback, session_lookback=session_lookback,
                           sessions=sessions)
    df, bkey = _bucketed(df, bucket)
    # the reference also groups by "server-pid", a function of these keys
    keys = [SRV, "backend_type", "processId", *bkey]
    agg = aggregate_with_sets(df, keys, [
        ("SelectCount", "count", None), ("FirstSeen", "min", TS), ("LastSeen", "max", TS),
        ("User", "max", "FinalUser"), ("Database", "max", "FinalDatabase"), ("SourceHost", "max", "FinalHost")],
        [("TablesAccessed", "TableName", 10), ("SampleQueries", "QueryText", 3)])
    return exfiltration_output(agg, threshold, high, critical)


def exfiltration_output(agg: DataFrame, threshold=15, high=30, critical=50) -> DataFrame:
    agg = agg.where(F.col("SelectCount") > threshold)
    return agg.select(
        F.col("LastSeen").alias("TimeGenerated"),
        F.lit("Potential Data Exfiltration").alias("AnomalyType"),
        severity("SelectCount", high, critical).alias("Severity"),
        F.col(SRV).alias("ServerName"), "User", "Database", "SourceHost",
        F.col("backend_type").alias("BackendType"), F.col("processId").alias("ProcessID"),
        "SelectCount",
        _hms_window("FirstSeen", "LastSeen").alias("TimeWindow"),
        join_set("TablesAccessed", ", ").alias("TablesAccessed"),
        join_set("SampleQueries", " ||| ").alias("SampleQueries"))


# --------------------------------------------------------------------- D2
def _keeper(wrap):
    return wrap if wrap is not None else (lambda c: c)


def destructive_match(df: DataFrame) -> Column:
    """Whether a log line counts for D2, its session left aside."""
    statement = trim_chars(" ", stored(df, "p_statement"))
    return (stored(df, "is_audit") & _is_category(df) & stored(df, "t_destructive_pre") & stored(df, "t_destructive")
            & ((stored(df, "p_class") == "WRITE") | has_any(statement, P.DESTRUCTIVE_TERMS)))


def destructive_lines(bronze: DataFrame, *, as_of=None, lookback=None, wrap=None) -> DataFrame:
    """D2's log lines, before their session is known."""
    df = since(bronze, as_of, lookback).where(_keeper(wrap)(destructive_match(bronze)))
    return df.withColumns({
        "AuditOperation": stored(bronze, "p_class"),
        "AuditStatement": trim_chars(" ", stored(bronze, "p_statement")),
        "TableAffected": stored(bronze, "p_object_type"),
        "QueryText": query_text(),
        **conn_fields(df=bronze)})


def destructive_rows(bronze: DataFrame, *, as_of=None, lookback=None, session_lookback=None,
                     sessions: DataFrame | None = None, wrap=None) -> DataFrame:
    """D2's enriched input rows (shared by the batch and streaming detector;
    a stream passes ``wrap=above_watermark``)."""
    df = destructive_lines(bronze, as_of=as_of, lookback=lookback, wrap=wrap)
    if sessions is None:
        sessions = session_info(bronze, as_of, session_lookback)
    return session_enrich(df, sessions).where(_keeper(wrap)(known_user()))


def destructive_ops(bronze: DataFrame, *, as_of=None, lookback="10m", bucket="2m",
                    threshold=5, high=10, critical=20, session_lookback="24h",
                    sessions: DataFrame | None = None) -> DataFrame:
    """Mass destructive operations (DELETE/UPDATE/TRUNCATE/DROP bursts)."""
    as_of = _as_of(bronze, as_of, lookback, session_lookback if sessions is None else None)
    df = destructive_rows(bronze, as_of=as_of, lookback=lookback, session_lookback=session_lookback,
                          sessions=sessions)
    df, bkey = _bucketed(df, bucket)
    keys = [SRV, "backend_type", *bkey]
    agg = aggregate_with_sets(df, keys, [
        ("OperationCount", "count", None), ("Operations", "small_set", "AuditStatement"),
        ("TablesAffected", "small_set", "TableAffected"),
        ("FirstOccurrence", "min", TS), ("LastOccurrence", "max", TS),
        ("User", "max", "FinalUser"), ("Database", "max", "FinalDatabase"), ("SourceHost", "max", "FinalHost")],
        [("SampleMessages", "QueryText", 3)])
    return destructive_output(agg, threshold, high, critical)


def destructive_output(agg: DataFrame, threshold=5, high=10, critical=20) -> DataFrame:
    agg = agg.where((F.col("OperationCount") > threshold) & (F.col("backend_type") == P.CLIENT_BACKEND))
    return agg.select(
        F.col("LastOccurrence").alias("TimeGenerated"),
        F.lit("Mass Destructive Operations").alias("AnomalyType"),
        severity("OperationCount", high, critical).alias("Severity"),
        F.col(SRV).alias("ServerName"), "User", "Database", "SourceHost",
        F.col("backend_type").alias("BackendType"), "OperationCount", "Operations", "TablesAffected",
        _window_text("FirstOccurrence", "LastOccurrence").alias("TimeWindow"), "SampleMessages")


# --------------------------------------------------------------------- D3
def error_match(df: DataFrame) -> Column:
    """Whether a log line counts for D3."""
    return stored(df, "is_err") & _is_category(df)


def error_spike_lines(bronze: DataFrame, *, as_of=None, lookback=None, wrap=None) -> DataFrame:
    """D3's log lines, before their session is known."""
    df = since(bronze, as_of, lookback).where(_keeper(wrap)(error_match(bronze)))
    return df.withColumns({
        "ErrorCategory": label_case(P.ERROR_SPIKE_CATEGORIES, P.ERROR_SPIKE_DEFAULT),
        **conn_fields(df=bronze)})


def error_spike_rows(bronze: DataFrame, *, as_of=None, lookback=None, session_lookback=None,
                     sessions: DataFrame | None = None, wrap=None) -> DataFrame:
    """D3's enriched input rows (shared by the batch and streaming detector)."""
    df = error_spike_lines(bronze, as_of=as_of, lookback=lookback, wrap=wrap)
    if sessions is None:
        sessions = session_info(bronze, as_of, session_lookback)
    return session_enrich(df, sessions)


def error_spike(bronze: DataFrame, *, as_of=None, lookback="15m", bucket="1m",
                threshold=3, high=8, critical=15, session_lookback="24h",
                sessions: DataFrame | None = None, ordered: bool = True) -> DataFrame:
    """Critical error spike per server, backend and minute, newest causes first."""
    as_of = _as_of(bronze, as_of, lookback, session_lookback if sessions is None else None)
    df = error_spike_rows(bronze, as_of=as_of, lookback=lookback, session_lookback=session_lookback,
                          sessions=sessions)
    df, bkey = _bucketed(df, bucket)
    keys = [SRV, "backend_type", *bkey]
    agg = aggregate_with_sets(df, keys, [
        ("ErrorCount", "count", None), ("ErrorTypes", "small_set", "ErrorCategory"),
        ("ErrorCodes", "small_set", "sqlerrcode"), ("FirstError", "min", TS), ("LastError", "max", TS),
        ("User", "max", "FinalUser"), ("Database", "max", "FinalDatabase"), ("SourceHost", "max", "FinalHost")],
        [("SampleErrors", "message", 3)])
    out = error_spike_output(agg, threshold, high, critical)
    if ordered:
        out = out.orderBy(F.desc("ErrorCount"), F.desc("TimeGenerated"), "ServerName", "BackendType")
    return out


def error_spike_output(agg: DataFrame, threshold=3, high=8, critical=15) -> DataFrame:
    agg = agg.where(F.col("ErrorCount") > threshold)
    return agg.select(
        F.col("LastError").alias("TimeGenerated"),
        F.lit("Critical Error Spike").alias("AnomalyType"),
        severity("ErrorCount", high, critical).alias("Severity"),
        F.col(SRV).alias("ServerName"), "User", "Database", "SourceHost",
        F.col("backend_type").alias("BackendType"), "ErrorCount", "ErrorTypes", "ErrorCodes",
        _window_text("FirstError", "LastError").alias("TimeWindow"), "SampleErrors")


# --------------------------------------------------------------------- D4
def privilege_match(df: DataFrame) -> Column:
    """Whether a log line counts for D4, its session left aside."""
    return (stored(df, "t_privilege") & _is_category(df)
            & ~contains("message", P.SYSTEM_USERS[1]) & ~contains("message", P.SUPERUSER)
            & (_client() | is_empty("backend_type")))


def privilege_sample() -> Column:
    return F.substring("message", 1, 200)


def privilege_lines(bronze: DataFrame, *, as_of=None, lookback=None, wrap=None) -> DataFrame:
    """D4's log lines, before their session is known."""
    df = since(bronze, as_of, lookback).where(_keeper(wrap)(privilege_match(bronze)))
    return df.withColumns({
        "PrivilegeOp": label_case(P.PRIVILEGE_OPS, P.PRIVILEGE_OPS_DEFAULT),
        "QueryText": privilege_sample(),
        "DirectUser": stored(bronze, "p_user"),
        "LogType": F.col("errorLevel")})


def privilege_rows(bronze: DataFrame, *, as_of=None, lookback=None, session_lookback=None,
                   sessions: DataFrame | None = None, wrap=None) -> DataFrame:
    """D4's enriched input rows (shared by the batch and streaming detector)."""
    df = privilege_lines(bronze, as_of=as_of, lookback=lookback, wrap=wrap)
    if sessions is None:
        sessions = session_info(bronze, as_of, session_lookback, fields=("User",))
    df = session_enrich(df, sessions.select("processId", SRV, "User"), fields=("User",))
    return df.where(_keeper(wrap)(known_user()))


def privilege_escalation(bronze: DataFrame, *, as_of=None, lookback="24h", bucket="1h",
                         threshold=0, high=3, critical=5, session_lookback="24h",
                         sessions: DataFrame | None = None) -> DataFrame:
    """Any GRANT/REVOKE/role change by a non-system user, per server and hour."""
    as_of = _as_of(bronze, as_of, lookback, session_lookback if sessions is None else None)
    df = privilege_rows(bronze, as_of=as_of, lookback=lookback, session_lookback=session_lookback,
                        sessions=sessions)
    df, bkey = _bucketed(df, bucket)
    keys = [SRV, *bkey]
    agg = aggregate_with_sets(df, keys, [
        ("PrivilegeOpsCount", "count", None), ("Operations", "small_set", "PrivilegeOp"),
        ("LogTypes", "small_set", "LogType"), ("FirstOp", "min", TS), ("LastOp", "max", TS),
        ("User", "max", "FinalUser")],
        [("SampleQueries", "QueryText", 3)])
    return privilege_output(agg, threshold, high, critical)


def privilege_output(agg: DataFrame, threshold=0, high=3, critical=5) -> DataFrame:
    agg = agg.where(F.col("PrivilegeOpsCount") > threshold)
    return agg.select(
        F.col("LastOp").alias("TimeGenerated"),
        F.lit("Privilege Escalation").alias("AnomalyType"),
        severity("PrivilegeOpsCount", high, critical).alias("Severity"),
        F.col(SRV).alias("ServerName"), "User", "PrivilegeOpsCount", "Operations", "LogTypes",
        _window_text("FirstOp", "LastOp").alias("TimeWindow"), "SampleQueries")


# --------------------------------------------------------------------- D5
def cross_schema_recon(bronze: DataFrame, *, as_of=None, lookback="15m", bucket="10m",
                       threshold=4, high=5, critical=8, session_lookback="24h",
                       literal: bool = False, sessions: DataFrame | None = None) -> DataFrame:
    """One backend touching many schemas in a short window.

    ``literal=False`` (default) takes the schema from the audited object
    name (6th pgaudit field) so catalog schemas are really excluded;
    ``literal=True`` keeps the reference's captures (schema regex on the
    5th field onward, object type as the table).
    """
    as_of = _as_of(bronze, as_of, lookback, session_lookback if sessions is None else None)
    df = cross_schema_rows(bronze, as_of=as_of, lookback=lookback, session_lookback=session_lookback,
                           literal=literal, sessions=sessions)
    df, bkey = _bucketed(df, bucket)
    keys = [SRV, "processId", *bkey]
    agg = df.groupBy(*keys).agg(*cross_schema_aggs())
    return cross_schema_output(agg, threshold, high, critical)


def cross_schema_match(df: DataFrame) -> Column:
    """Whether a log line counts for D5: it names an object of a schema that is no catalog."""
    return (stored(df, "is_audit") & _is_category(df) & _client()
            & ~schema_of(stored(df, "p_object")).isin(*P.CATALOG_SCHEMAS, ""))


def cross_schema_lines(bronze: DataFrame, *, as_of=None, lookback=None, literal: bool = False,
                       wrap=None) -> DataFrame:
    """D5's log lines, before their session is known."""
    w, user = _keeper(wrap), stored(bronze, "p_user").alias("DirectUser")
    df = since(bronze, as_of, lookback)
    if not literal:
        obj = stored(bronze, "p_object")
        return df.where(w(cross_schema_match(bronze))).withColumns({
            "TableAccessed": obj, "SchemaAccessed": schema_of(obj), "SchemaName": schema_of(obj), "DirectUser": user})
    df = df.where(w(stored(bronze, "is_audit") & _is_category(bronze) & _client())).withColumns({
        "SchemaAccessed": extract(P.AUDIT_SCHEMA_RE, "message"),
        "TableAccessed": stored(bronze, "p_object_type"), "DirectUser": user})
    df = df.where(w(is_not_empty("SchemaAccessed") | is_not_empty("TableAccessed")))
    df = df.withColumn("SchemaName", F.when(is_not_empty("SchemaAccessed"), F.col("SchemaAccessed"))
                       .otherwise(schema_of("TableAccessed")))
    return df.where(w(is_not_empty("SchemaName") & ~F.col("SchemaName").isin(*P.CATALOG_SCHEMAS, "")))


def cross_schema_rows(bronze: DataFrame, *, as_of=None, lookback=None, session_lookback=None,
                      literal: bool = False, sessions: DataFrame | None = None, wrap=None) -> DataFrame:
    """D5's enriched input rows (shared by the batch and streaming detector)."""
    df = cross_schema_lines(bronze, as_of=as_of, lookback=lookback, literal=literal, wrap=wrap)
    if sessions is None:
        sessions = session_info(bronze, as_of, session_lookback, terms=CONN_TERMS_AUTHORIZED,
                                fields=("User",))
    df = session_enrich(df, sessions.select("processId", SRV, "User"), fields=("User",))
    return df.where(_keeper(wrap)(not_superuser()))


def cross_schema_aggs(streaming: bool = False):
    """Distinct counts are sizes of the (catalog-bounded) sets in a stream,
    where exact distinct aggregation is not available; same value."""
    def dcount(c):
        return F.size(F.collect_set(c)).cast("long") if streaming else F.count_distinct(c)
    return [dcount("SchemaName").alias("SchemasAccessed"), small_set("SchemaName").alias("SchemaList"),
            dcount("TableAccessed").alias("TablesAccessed"),
            F.min(TS).alias("FirstAccess"), F.max(TS).alias("LastAccess"), F.max("FinalUser").alias("User")]


def cross_schema_output(agg: DataFrame, threshold=4, high=5, critical=8) -> DataFrame:
    agg = agg.where(F.col("SchemasAccessed") > threshold)
    return agg.select(
        F.col("LastAccess").alias("TimeGenerated"),
        F.lit("Cross-Schema Reconnaissance").alias("AnomalyType"),
        severity("SchemasAccessed", high, critical).alias("Severity"),
        F.col(SRV).alias("ServerName"), "User", "SchemasAccessed",
        join_set("SchemaList", ", ").alias("SchemaList"), "TablesAccessed",
        _window_text("FirstAccess", "LastAccess").alias("TimeWindow"))


# --------------------------------------------------------------------- D6
def catalog_query_text() -> Column:
    return first_non_empty(query_text(), extract(P.STATEMENT_TEXT_RE, "message"), "message")


def deep_schema_enum(bronze: DataFrame, *, as_of=None, lookback="10m", bucket="5m",
                     threshold=10, high=15, critical=30, multi_table=5, session_lookback="24h",
                     sessions: DataFrame | None = None) -> DataFrame:
    """Bursts of system-catalog queries from one backend."""
    as_of = _as_of(bronze, as_of, lookback, session_lookback if sessions is None else None)
    df = deep_enum_rows(bronze, as_of=as_of, lookback=lookback, session_lookback=session_lookback,
                        sessions=sessions)
    df, bkey = _bucketed(df, bucket)
    keys = [SRV, "processId", *bkey]
    agg = df.groupBy(*keys).agg(*deep_enum_aggs())
    return deep_enum_output(agg, threshold, high, critical, multi_table)


def deep_enum_match(df: DataFrame) -> Column:
    """Whether a log line counts for D6, its session left aside."""
    return stored(df, "is_audit") & _is_category(df) & _client() & stored(df, "t_catalog")


def deep_enum_lines(bronze: DataFrame, *, as_of=None, lookback=None, wrap=None) -> DataFrame:
    """D6's log lines, before their session is known."""
    df = since(bronze, as_of, lookback).where(_keeper(wrap)(deep_enum_match(bronze)))
    df = df.withColumn("QueryText", catalog_query_text())
    return df.withColumns({"SystemTable": label_case(P.SYSTEM_TABLES, P.SYSTEM_TABLES_DEFAULT, msg="QueryText"),
                           "DirectUser": stored(bronze, "p_user")})


def deep_enum_rows(bronze: DataFrame, *, as_of=None, lookback=None, session_lookback=None,
                   sessions: DataFrame | None = None, wrap=None) -> DataFrame:
    """D6's enriched input rows (shared by the batch and streaming detector)."""
    df = deep_enum_lines(bronze, as_of=as_of, lookback=lookback, wrap=wrap)
    if sessions is None:
        sessions = session_info(bronze, as_of, session_lookback, terms=CONN_TERMS_AUTHORIZED,
                                fields=("User",))
    df = session_enrich(df, sessions.select("processId", SRV, "User"), fields=("User",))
    return df.where(_keeper(wrap)(not_superuser()))


def deep_enum_aggs(streaming: bool = False):
    unique = (F.size(F.collect_set("SystemTable")).cast("long") if streaming
              else F.count_distinct("SystemTable"))   # 12 possible labels either way
    return [F.count(F.lit(1)).alias("SystemTableQueries"), small_set("SystemTable").alias("TablesScanned"),
            unique.alias("UniqueSystemTables"), F.min(TS).alias("FirstQuery"), F.max(TS).alias("LastQuery"),
            F.max("FinalUser").alias("User")]


def deep_enum_output(agg: DataFrame, threshold=10, high=15, critical=30, multi_table=5) -> DataFrame:
    agg = agg.where(F.col("SystemTableQueries") > threshold)
    return agg.select(
        F.col("LastQuery").alias("TimeGenerated"),
        F.lit("Deep Schema Enumeration").alias("AnomalyType"),
        severity("SystemTableQueries", high, critical).alias("Severity"),
        F.when(F.col("UniqueSystemTables") > multi_table, F.lit("HIGH - Multi-table scan"))
        .otherwise(F.lit("MEDIUM")).alias("RiskLevel"),
        F.col(SRV).alias("ServerName"), "User", "SystemTableQueries", "UniqueSystemTables",
        join_set("TablesScanned", ", ").alias("TablesScanned"),
        _window_text("FirstQuery", "LastQuery").alias("TimeWindow"))


# --------------------------------------------------------------------- D7
def brute_force_match(df: DataFrame) -> Column:
    """Whether a log line counts for D7."""
    return (stored(df, "is_auth_failure") & _is_category(df)
            & ((stored(df, "p_host") != "") | (stored(df, "p_user") != "")))


def brute_force_rows(bronze: DataFrame, *, as_of=None, lookback=None, wrap=None) -> DataFrame:
    """D7's input rows (shared by the batch and streaming detector)."""
    df = since(bronze, as_of, lookback).where(_keeper(wrap)(brute_force_match(bronze)))
    return df.withColumns({"UserName": stored(bronze, "p_user"),
                           "ClientHost": stored(bronze, "p_host"),
                           "DatabaseName": stored(bronze, "p_database")})


def brute_force(bronze: DataFrame, *, as_of=None, lookback="24h",
                threshold=5, high=10, critical=20) -> DataFrame:
    """Repeated authentication failures from one client host."""
    as_of = _as_of(bronze, as_of, lookback)
    df = brute_force_rows(bronze, as_of=as_of, lookback=lookback)
    keys = ["ClientHost"]
    agg = aggregate_with_sets(df, keys, [
        ("FailedAttempts", "count", None), ("FirstAttempt", "min", TS), ("LastAttempt", "max", TS)],
        [("Users", "UserName", 10), ("Databases", "DatabaseName", 5)])
    return brute_force_output(agg, threshold, high, critical)


def brute_force_output(agg: DataFrame, threshold=5, high=10, critical=20) -> DataFrame:
    agg = agg.where(F.col("FailedAttempts") > threshold)
    return agg.select(
        F.col("LastAttempt").alias("TimeGenerated"),
        F.lit("Brute Force Authentication").alias("AnomalyType"),
        severity("FailedAttempts", high, critical).alias("Severity"),
        F.lit("Multiple").alias("ServerName"), F.col("ClientHost").alias("SourceHost"),
        "FailedAttempts",
        join_set("Users", ", ").alias("Users"), join_set("Databases", ", ").alias("Databases"),
        _hms_window("FirstAttempt", "LastAttempt").alias("TimeWindow"))


def brute_force_by_code(bronze: DataFrame, *, as_of=None, lookback="24h",
                        low=5, high=10, critical=20) -> DataFrame:
    """Authentication failures by SQLSTATE class 28, per host and server,
    with a LOW tier for hosts under the threshold."""
    as_of = _as_of(bronze, as_of, lookback)
    df = since(bronze, as_of, lookback).where(stored(bronze, "is_auth_code"))
    df = df.withColumns({"UserName": stored(bronze, "p_user"),
                         "ClientHost": first_non_empty(stored(bronze, "p_host"), default=P.UNKNOWN),
                         "DatabaseName": stored(bronze, "p_database"),
                         "ErrorCode": F.col("sqlerrcode")})
    keys = ["ClientHost", SRV]
    agg = aggregate_with_sets(df, keys, [
        ("FailedAttempts", "count", None), ("FirstAttempt", "min", TS), ("LastAttempt", "max", TS)],
        [("Users", "UserName", 10), ("Databases", "DatabaseName", 5),
         ("ErrorCodes", "ErrorCode", 5), ("SampleMessages", "message", 2)])
    return agg.select(
        "ClientHost", F.col(SRV).alias("ServerName"), "FailedAttempts",
        severity("FailedAttempts", high, critical, low=low).alias("Severity"),
        join_set("Users", ", ").alias("Users"), join_set("Databases", ", ").alias("Databases"),
        join_set("ErrorCodes", ", ").alias("ErrorCodes"),
        "FirstAttempt", "LastAttempt", "SampleMessages"
    ).orderBy(F.desc("FailedAttempts"), "ClientHost", "ServerName")


# --------------------------------------------------------------------- D9
def privilege_offhours(metrics: DataFrame, *, as_of=None, lookback="7d", ops="PrivilegeOps") -> DataFrame:
    """Privilege changes in the activity metrics, graded by hour and weekday;
    ``ops="DDLOps"`` grades schema changes the same way."""
    df = since(metrics, as_of, lookback, ts="Timestamp").where(F.col(ops) > 0)
    h, d = F.col("HourOfDay"), F.col("DayOfWeek")
    midnight = (h < 6) | (h > 22)
    off = (h < 9) | (h > 17)
    weekend = d.isin(0, 6)
    return df.select(
        "Timestamp", "ServerName", ops, "HourOfDay", "DayOfWeek",
        F.when(midnight, "Midnight").when(off, "Off-Hours").otherwise("Business Hours").alias("TimeContext"),
        F.when(weekend, "Weekend").otherwise("Weekday").alias("DayContext"),
        F.when(midnight & weekend, "CRITICAL").when(off, "HIGH").otherwise("MEDIUM").alias("Severity"),
        "ActivityCount").orderBy(F.desc("Timestamp"), "ServerName")


# --------------------------------------------------------------------- D10
def error_spike_5m(bronze: DataFrame, *, as_of=None, lookback="2h", bucket="5m",
                   threshold=10, high=25, critical=50) -> DataFrame:
    """ERROR/FATAL/PANIC counts per server and 5 minutes, newest first."""
    as_of = _as_of(bronze, as_of, lookback)
    df = since(bronze, as_of, lookback).where(flag(bronze, "is_err") & F.col("errorLevel").isin(*P.ERROR_LEVELS))
    df = df.withColumn("ErrorCategory", label_case(P.ERROR_5M_CATEGORIES, P.ERROR_5M_DEFAULT))
    df, bkey = _bucketed(df, bucket)
    keys = [*bkey, SRV]
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("ErrorCount"),
        F.count_distinct("ErrorCategory").alias("UniqueErrorTypes"),
        F.slice(small_set("ErrorCategory"), 1, 5).alias("ErrorTypes"))
    agg = agg.where(F.col("ErrorCount") > threshold)
    tw = [F.col("Bucket").alias("TimeWindow")] if bkey else []
    return agg.select(
        *tw, F.col(SRV).alias("ServerName"), "ErrorCount",
        severity("ErrorCount", high, critical).alias("Severity"),
        join_set("ErrorTypes", "; ").alias("ErrorTypes"), "UniqueErrorTypes"
    ).orderBy(*([F.desc("TimeWindow")] if bkey else []), "ServerName")


# --------------------------------------------------------------------- D11
def exfiltration_by_user(bronze: DataFrame, *, as_of=None, lookback="1h",
                         threshold=15, high=30, critical=50, session_lookback="1h") -> DataFrame:
    """Excessive reads per user, database, host and backend."""
    as_of = _as_of(bronze, as_of, lookback, session_lookback)
    sessions = session_info(bronze, as_of, session_lookback, terms=CONN_TERMS_AUTHORIZED)
    df = since(bronze, as_of, lookback).where(
        stored(bronze, "is_audit") & stored(bronze, "t_select")
        & (F.col("backend_type") == P.CLIENT_BACKEND))
    df = join_sessions(df, sessions, "left")
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("User", "Database", "SourceHost")})
    agg = df.groupBy("User", "Database", "SourceHost", "processId").agg(
        F.count(F.lit(1)).alias("SelectCount"), F.max(TS).alias("LastQuery"),
        F.count_distinct(stored(bronze, "p_object_type")).alias("TablesAccessed"))
    agg = agg.where(F.col("SelectCount") > threshold)
    return agg.select("User", "Database", "SourceHost", "SelectCount", "TablesAccessed",
                      severity("SelectCount", high, critical).alias("Severity"), "LastQuery"
                      ).orderBy(F.desc("SelectCount"), "User", "Database", "SourceHost")


def exfiltration_by_message_user(bronze: DataFrame, *, as_of=None, lookback="1h", threshold=15) -> DataFrame:
    """D11's simple form: excessive reads by the user that the message itself names ('' where it names none)."""
    df = since(bronze, _as_of(bronze, as_of, lookback), lookback).where(
        stored(bronze, "is_audit") & stored(bronze, "t_select"))
    agg = df.groupBy(stored(bronze, "p_user").alias("UserName")).agg(F.count(F.lit(1)).alias("SelectCount"))
    return agg.where(F.col("SelectCount") > threshold).withColumn("Severity", F.lit("CRITICAL"))


# --------------------------------------------------------------------- D13
def _quick(bronze, as_of, lookback, session_lookback, pred, exclude, keys_fn, bucket,
           count_name, first_name, last_name, threshold, high, critical, anomaly, last_alias):
    df = since(bronze, as_of, lookback).where(_is_category(bronze) & pred)
    df = df.withColumn("DirectUser", stored(bronze, "p_user"))
    sessions = session_info(bronze, as_of, session_lookback, terms=CONN_TERMS_AUTHORIZED, fields=("User",))
    df = session_enrich(df, sessions, fields=("User",))
    if exclude:
        df = df.where(~F.col("FinalUser").isin(*exclude))
    df, bkey = _bucketed(df, bucket)
    keys = [SRV, *keys_fn, *bkey]
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name), F.min(TS).alias(first_name),
                                F.max(TS).alias(last_name), F.max("FinalUser").alias("User"))
    agg = agg.where(F.col(count_name) > threshold)
    return agg.select(F.col(last_name).alias("TimeGenerated"), F.lit(anomaly).alias("AnomalyType"),
                      severity(count_name, high, critical).alias("Severity"),
                      F.col(SRV).alias("ServerName"), "User", count_name)


def quick_exfil(bronze, *, as_of=None, lookback="5m", bucket=None, threshold=15, high=30, critical=50,
                session_lookback="24h"):
    as_of = _as_of(bronze, as_of, lookback, session_lookback)
    pred = (stored(bronze, "is_audit") & stored(bronze, "t_exfil")
            & (F.col("backend_type") == P.CLIENT_BACKEND))
    return _quick(bronze, as_of, lookback, session_lookback, pred, (P.SUPERUSER,), ["processId"], bucket,
                  "SelectCount", "FirstSeen", "LastSeen", threshold, high, critical, "Data Exfiltration", None)


def quick_destructive(bronze, *, as_of=None, lookback="10m", bucket="2m", threshold=5, high=10, critical=20,
                      session_lookback="24h"):
    as_of = _as_of(bronze, as_of, lookback, session_lookback)
    pred = (stored(bronze, "is_audit") & stored(bronze, "t_destructive")
            & (F.col("backend_type") == P.CLIENT_BACKEND))
    return _quick(bronze, as_of, lookback, session_lookback, pred, (), [], bucket,
                  "OperationCount", "FirstOp", "LastOp", threshold, high, critical, "Destructive Operations", None)


def quick_errors(bronze, *, as_of=None, lookback="15m", bucket="1m", threshold=3, high=8, critical=15,
                 session_lookback="24h"):
    as_of = _as_of(bronze, as_of, lookback, session_lookback)
    pred = flag(bronze, "is_err") & F.col("errorLevel").isin(*P.ERROR_LEVELS)
    return _quick(bronze, as_of, lookback, session_lookback, pred, (), [], bucket,
                  "ErrorCount", "FirstError", "LastError", threshold, high, critical, "Error Spike", None)


def quick_privilege(bronze, *, as_of=None, lookback="10m", bucket="5m", threshold=3, high=5, critical=10,
                    session_lookback="24h"):
    as_of = _as_of(bronze, as_of, lookback, session_lookback)
    pred = stored(bronze, "t_privilege_activity")
    return _quick(bronze, as_of, lookback, session_lookback, pred, (P.SUPERUSER,), [], bucket,
                  "PrivilegeOpsCount", "FirstOp", "LastOp", threshold, high, critical, "Privilege Escalation", None)


def quick_all(bronze, *, limit: int = 100, **params) -> DataFrame:
    """The quick-start dashboard: four narrow detectors, newest 100."""
    parts = [quick_exfil(bronze, **params.get("exfil", {})),
             quick_destructive(bronze, **params.get("destructive", {})),
             quick_errors(bronze, **params.get("errors", {})),
             quick_privilege(bronze, **params.get("privilege", {}))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.orderBy(F.desc("TimeGenerated"), "AnomalyType", "ServerName").limit(limit)
