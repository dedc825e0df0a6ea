"""DuckDB SQL for every registered query (the correctness oracle).

Each string rebuilds the bronze rows from ``events`` (``bronze_sql``) and
then states the query in plain SQL, independently of the DataFrame code.
Shared pieces (session lookup, enrichment) are CTE builders here.
"""

from __future__ import annotations

from auditlens.functions import patterns as P
from auditlens.plans import sqltext as S
from auditlens.plans.bronze_sql import with_bronze
from auditlens.plans.profile import DAY

TS = "EventProcessedUtcTime"
CAT = "category = 'PostgreSQLLogs'"
AUDIT = S.contains("message", P.AUDIT_MARK)
CLIENT = "backend_type = 'client backend'"
ERRPRED = f"({S.in_list('errorLevel', P.ERROR_LEVELS)} OR (sqlerrcode <> '00000' AND sqlerrcode <> ''))"


def U(p):  # extract user
    return S.extract(P.USER_RE, "message") if p is None else S.extract(p, "message")


def sess_cte(name="sess", authorized_only=False):
    terms = (P.CONN_AUTHORIZED,) if authorized_only else (P.CONN_AUTHORIZED, P.CONN_RECEIVED)
    return f"""{name} AS (
  SELECT processId, LogicalServerName, max(u) AS "User", max(d) AS "Database", max(h) AS SourceHost
  FROM (SELECT processId, LogicalServerName, {S.extract(P.USER_RE, 'message')} AS u,
               {S.extract(P.DATABASE_RE, 'message')} AS d, {S.extract(P.HOST_RE, 'message')} AS h
        FROM bronze WHERE {S.contains_any('message', terms)}) c
  WHERE u <> ''
  GROUP BY processId, LogicalServerName)"""


def direct_cols():
    return (f"{S.extract(P.USER_RE, 'message')} AS DirectUser, "
            f"{S.extract(P.DATABASE_RE, 'message')} AS DirectDatabase, "
            f"{S.extract(P.HOST_RE, 'message')} AS DirectHost")


def final_cols(s="s"):
    return (f"{S.first_non_empty('DirectUser', s + '.\"User\"', default='UNKNOWN')} AS FinalUser, "
            f"{S.first_non_empty('DirectDatabase', s + '.\"Database\"', default='UNKNOWN')} AS FinalDatabase, "
            f"{S.first_non_empty('DirectHost', s + '.SourceHost', default='UNKNOWN')} AS FinalHost")


def bucket(secs):
    return S.bin_ts(TS, secs)


def arr(expr):
    """Render a list as the registered queries render arrays."""
    return f"COALESCE(array_to_string({expr}, ', '), '')"


def window_text(a, b):
    return f"({S.iso_datetime_text(a)} || ' to ' || {S.iso_datetime_text(b)})"


def hms_window(a, b):
    return f"({S.hms(a)} || ' - ' || {S.hms(b)})"


# ------------------------------------------------------------------ detectors
def error_spike_sql(bucket_secs=DAY, threshold=3, high=8, critical=15):
    cat = S.label_case(P.ERROR_SPIKE_CATEGORIES, P.ERROR_SPIKE_DEFAULT)
    return with_bronze(sess_cte(), f"""ev AS (
  SELECT b.*, {cat} AS ErrorCategory, {direct_cols()}, {bucket(bucket_secs)} AS Bucket
  FROM bronze b WHERE {CAT} AND {ERRPRED}),
j AS (SELECT ev.*, {final_cols()} FROM ev LEFT JOIN sess s USING (processId, LogicalServerName)),
g AS (
  SELECT LogicalServerName, backend_type, Bucket, count(*) AS ErrorCount,
         {S.set_n('ErrorCategory', None)} AS ErrorTypes, {S.set_n('sqlerrcode', None)} AS ErrorCodes,
         min({TS}) AS FirstError, max({TS}) AS LastError, {S.set_n('message', 3)} AS SampleErrors,
         max(FinalUser) AS "User", max(FinalDatabase) AS "Database", max(FinalHost) AS SourceHost
  FROM j GROUP BY LogicalServerName, backend_type, Bucket HAVING count(*) > {threshold})""") + f"""
SELECT LastError AS TimeGenerated, 'Critical Error Spike' AS AnomalyType,
       {S.severity('ErrorCount', high, critical)} AS Severity, LogicalServerName AS ServerName,
       "User", "Database", SourceHost, backend_type AS BackendType, ErrorCount,
       {arr('ErrorTypes')} AS ErrorTypes, {arr('ErrorCodes')} AS ErrorCodes,
       {window_text('FirstError', 'LastError')} AS TimeWindow, {arr('SampleErrors')} AS SampleErrors
FROM g"""


def sess_auth_cte():
    return sess_cte("sess", authorized_only=True)


def _enriched(ev_cte: str, where_final: str = "", auth_only=False, direct=True):
    """sess + ev + j(+FinalUser..) CTEs; ``where_final`` filters j."""
    parts = [sess_cte("sess", authorized_only=auth_only), ev_cte,
             f"j0 AS (SELECT ev.*, {final_cols()} FROM ev LEFT JOIN sess s USING (processId, LogicalServerName))",
             f"j AS (SELECT * FROM j0 {('WHERE ' + where_final) if where_final else ''})"]
    return parts


def _enriched_live(ev_cte: str, where_final: str):
    """As ``_enriched``, each line with the newest connection of its backend in the 24 hours before."""
    terms = (P.CONN_AUTHORIZED, P.CONN_RECEIVED)
    return [ev_cte, f"""conn AS (
  SELECT * FROM (SELECT processId, LogicalServerName, {TS} AS t, {S.extract(P.USER_RE, 'message')} AS u,
                        {S.extract(P.DATABASE_RE, 'message')} AS d, {S.extract(P.HOST_RE, 'message')} AS h
                 FROM bronze WHERE {S.contains_any('message', terms)}) c WHERE u <> '')""",
            "lines AS MATERIALIZED (SELECT row_number() OVER () AS line, * FROM ev)",
            f"""near AS (SELECT line, max(struct_pack(t := t, u := u, d := d, h := h)) AS c FROM lines AS l JOIN conn
  ON l.processId = conn.processId AND l.LogicalServerName = conn.LogicalServerName
    AND t <= {TS} AND t >= {TS} - INTERVAL '24 hours' GROUP BY line)""",
            'sess AS (SELECT line, c.u AS "User", c.d AS "Database", c.h AS SourceHost FROM near)',
            f"""j AS (SELECT * FROM (SELECT l.*, {final_cols()} FROM lines AS l LEFT JOIN sess s USING (line)) x
  {('WHERE ' + where_final) if where_final else ''})"""]


def exfiltration_sql(threshold=15, high=30, critical=50, bucket_secs=None):
    bsel = f", {bucket(bucket_secs)} AS Bucket" if bucket_secs else ""
    bgrp = ", Bucket" if bucket_secs else ""
    ev = f"""ev AS (
  SELECT * FROM (
    SELECT b.*, {S.extract(P.AUDIT_CLASS_RE, 'message')} AS AuditOperation,
      {S.extract(P.AUDIT_STATEMENT_RE, 'message')} AS AuditStatement,
      {S.extract(P.AUDIT_OBJECT_TYPE_RE, 'message')} AS TableName,
      trim({S.extract(P.QUERY_TEXT_RE, 'message')}, '"') AS QueryText,
      LogicalServerName || '-' || COALESCE(CAST(processId AS VARCHAR), '') AS ProcessSession,
      {direct_cols()}{bsel}
    FROM bronze b WHERE {CAT} AND {AUDIT} AND {S.has_any('message', P.EXFIL_TERMS)} AND {CLIENT}) x
  WHERE AuditOperation = 'READ' OR AuditStatement = 'SELECT')"""
    g = f"""g AS (
  SELECT ProcessSession, LogicalServerName, backend_type, processId{bgrp}, count(*) AS SelectCount,
    min({TS}) AS FirstSeen, max({TS}) AS LastSeen, {S.set_n('TableName', 10)} AS TablesAccessed,
    {S.set_n('QueryText', 3)} AS SampleQueries, max(FinalUser) AS "User", max(FinalDatabase) AS "Database",
    max(FinalHost) AS SourceHost
  FROM j GROUP BY ProcessSession, LogicalServerName, backend_type, processId{bgrp} HAVING count(*) > {threshold})"""
    return with_bronze(*_enriched(ev, "FinalUser <> 'azuresu'"), g) + f"""
SELECT LastSeen AS TimeGenerated, 'Potential Data Exfiltration' AS AnomalyType,
  {S.severity('SelectCount', high, critical)} AS Severity, LogicalServerName AS ServerName,
  "User", "Database", SourceHost, backend_type AS BackendType, processId AS ProcessID, SelectCount,
  {hms_window('FirstSeen', 'LastSeen')} AS TimeWindow,
  COALESCE(array_to_string(TablesAccessed, ', '), '') AS TablesAccessed,
  COALESCE(array_to_string(SampleQueries, ' ||| '), '') AS SampleQueries
FROM g"""


def destructive_ops_sql(bucket_secs=DAY, threshold=5, high=10, critical=20, enriched=_enriched):
    ev = f"""ev AS (
  SELECT * FROM (
    SELECT b.*, {S.extract(P.AUDIT_CLASS_RE, 'message')} AS AuditOperation,
      trim({S.extract(P.AUDIT_STATEMENT_RE, 'message')}, ' ') AS AuditStatement,
      {S.extract(P.AUDIT_OBJECT_TYPE_RE, 'message')} AS TableAffected,
      trim({S.extract(P.QUERY_TEXT_RE, 'message')}, '"') AS QueryText,
      {direct_cols()}, {bucket(bucket_secs)} AS Bucket
    FROM bronze b WHERE {CAT} AND {AUDIT} AND {S.has_any('message', P.DESTRUCTIVE_PREFILTER_TERMS)}) x
  WHERE {S.has_any('message', P.DESTRUCTIVE_TERMS)}
    AND (AuditOperation = 'WRITE' OR {S.has_any('AuditStatement', P.DESTRUCTIVE_TERMS)}))"""
    g = f"""g AS (
  SELECT LogicalServerName, backend_type, Bucket, count(*) AS OperationCount,
    {S.set_n('AuditStatement', None)} AS Operations, {S.set_n('TableAffected', None)} AS TablesAffected,
    min({TS}) AS FirstOccurrence, max({TS}) AS LastOccurrence, {S.set_n('QueryText', 3)} AS SampleMessages,
    max(FinalUser) AS "User", max(FinalDatabase) AS "Database", max(FinalHost) AS SourceHost
  FROM j GROUP BY LogicalServerName, backend_type, Bucket
  HAVING count(*) > {threshold} AND backend_type = 'client backend')"""
    return with_bronze(*enriched(ev, "FinalUser NOT IN ('azuresu', 'azure_maintenance', 'UNKNOWN')"), g) + f"""
SELECT LastOccurrence AS TimeGenerated, 'Mass Destructive Operations' AS AnomalyType,
  {S.severity('OperationCount', high, critical)} AS Severity, LogicalServerName AS ServerName,
  "User", "Database", SourceHost, backend_type AS BackendType, OperationCount,
  {arr('Operations')} AS Operations, {arr('TablesAffected')} AS TablesAffected,
  {window_text('FirstOccurrence', 'LastOccurrence')} AS TimeWindow, {arr('SampleMessages')} AS SampleMessages
FROM g"""


def privilege_escalation_sql(bucket_secs=DAY, threshold=0, high=3, critical=5, enriched=_enriched):
    ev = f"""ev AS (
  SELECT b.*, {S.label_case(P.PRIVILEGE_OPS, P.PRIVILEGE_OPS_DEFAULT)} AS PrivilegeOp,
    substring(message, 1, 200) AS QueryText, {direct_cols()}, errorLevel AS LogType,
    {bucket(bucket_secs)} AS Bucket
  FROM bronze b WHERE {CAT} AND {S.has_any('message', P.PRIVILEGE_TERMS)}
    AND NOT {S.contains('message', 'azure_maintenance')} AND NOT {S.contains('message', 'azuresu')}
    AND (backend_type = 'client backend' OR {S.empty('backend_type')}))"""
    g = f"""g AS (
  SELECT LogicalServerName, Bucket, count(*) AS PrivilegeOpsCount,
    {S.set_n('PrivilegeOp', None)} AS Operations, {S.set_n('LogType', None)} AS LogTypes,
    min({TS}) AS FirstOp, max({TS}) AS LastOp, {S.set_n('QueryText', 3)} AS SampleQueries,
    max(FinalUser) AS "User"
  FROM j GROUP BY LogicalServerName, Bucket HAVING count(*) > {threshold})"""
    return with_bronze(*enriched(ev, "FinalUser NOT IN ('azuresu', 'azure_maintenance', 'UNKNOWN')"), g) + f"""
SELECT LastOp AS TimeGenerated, 'Privilege Escalation' AS AnomalyType,
  {S.severity('PrivilegeOpsCount', high, critical)} AS Severity, LogicalServerName AS ServerName, "User",
  PrivilegeOpsCount, {arr('Operations')} AS Operations, {arr('LogTypes')} AS LogTypes,
  {window_text('FirstOp', 'LastOp')} AS TimeWindow, {arr('SampleQueries')} AS SampleQueries
FROM g"""


def cross_schema_recon_sql(threshold=4, high=5, critical=8, literal=False, bucket_secs=None):
    bsel = f", {bucket(bucket_secs)} AS Bucket" if bucket_secs else ""
    bgrp = ", Bucket" if bucket_secs else ""
    if literal:   # the reference's captures: schema regex from the 5th field on, object type as table
        schema_src = S.extract(P.AUDIT_SCHEMA_RE, 'message')
        table_src = S.extract(P.AUDIT_OBJECT_TYPE_RE, 'message')
    else:
        schema_src = S.extract(P.SCHEMA_PREFIX_RE, 'TableAccessed')
        table_src = S.extract(P.AUDIT_OBJECT_NAME_RE, 'message')
    ev = f"""ev AS (
  SELECT * FROM (
    SELECT *, CASE WHEN {S.non_empty('SchemaAccessed')} THEN SchemaAccessed
                   ELSE {S.extract(P.SCHEMA_PREFIX_RE, 'TableAccessed')} END AS SchemaName
    FROM (SELECT *, {schema_src} AS SchemaAccessed
          FROM (SELECT b.*, {table_src} AS TableAccessed,
                       {S.extract(P.USER_RE, 'message')} AS DirectUser, '' AS DirectDatabase, '' AS DirectHost{bsel}
                FROM bronze b WHERE {CAT} AND {AUDIT} AND {CLIENT}) a) c
    WHERE {S.non_empty('SchemaAccessed')} OR {S.non_empty('TableAccessed')}) d
  WHERE {S.non_empty('SchemaName')} AND SchemaName NOT IN ('pg_catalog', 'information_schema', ''))"""
    g = f"""g AS (
  SELECT LogicalServerName, processId{bgrp}, count(DISTINCT SchemaName) AS SchemasAccessed,
    {S.set_n('SchemaName', None)} AS SchemaList, count(DISTINCT TableAccessed) AS TablesAccessed,
    min({TS}) AS FirstAccess, max({TS}) AS LastAccess, max(FinalUser) AS "User"
  FROM j GROUP BY LogicalServerName, processId{bgrp} HAVING count(DISTINCT SchemaName) > {threshold})"""
    return with_bronze(*_enriched(ev, "FinalUser <> 'azuresu'", auth_only=True), g) + f"""
SELECT LastAccess AS TimeGenerated, 'Cross-Schema Reconnaissance' AS AnomalyType,
  {S.severity('SchemasAccessed', high, critical)} AS Severity, LogicalServerName AS ServerName, "User",
  SchemasAccessed, {arr('SchemaList')} AS SchemaList, TablesAccessed,
  {window_text('FirstAccess', 'LastAccess')} AS TimeWindow
FROM g"""


def deep_schema_enum_sql(threshold=10, high=15, critical=30, multi=5, bucket_secs=None):
    bsel = f", {bucket(bucket_secs)} AS Bucket" if bucket_secs else ""
    bgrp = ", Bucket" if bucket_secs else ""
    qt = S.first_non_empty(f"trim({S.extract(P.QUERY_TEXT_RE, 'message')}, '\"')",
                           S.extract(P.STATEMENT_TEXT_RE, 'message'), 'message')
    ev = f"""ev AS (
  SELECT *, {S.label_case(P.SYSTEM_TABLES, P.SYSTEM_TABLES_DEFAULT, msg='QueryText')} AS SystemTable
  FROM (SELECT b.*, {qt} AS QueryText, {S.extract(P.USER_RE, 'message')} AS DirectUser,
               '' AS DirectDatabase, '' AS DirectHost{bsel}
        FROM bronze b WHERE {CAT} AND {AUDIT} AND {CLIENT} AND {S.has_any('message', P.CATALOG_TERMS)}) a)"""
    g = f"""g AS (
  SELECT LogicalServerName, processId{bgrp}, count(*) AS SystemTableQueries,
    {S.set_n('SystemTable', None)} AS TablesScanned, count(DISTINCT SystemTable) AS UniqueSystemTables,
    min({TS}) AS FirstQuery, max({TS}) AS LastQuery, max(FinalUser) AS "User"
  FROM j GROUP BY LogicalServerName, processId{bgrp} HAVING count(*) > {threshold})"""
    return with_bronze(*_enriched(ev, "FinalUser <> 'azuresu'", auth_only=True), g) + f"""
SELECT LastQuery AS TimeGenerated, 'Deep Schema Enumeration' AS AnomalyType,
  {S.severity('SystemTableQueries', high, critical)} AS Severity,
  CASE WHEN UniqueSystemTables > {multi} THEN 'HIGH - Multi-table scan' ELSE 'MEDIUM' END AS RiskLevel,
  LogicalServerName AS ServerName, "User", SystemTableQueries, UniqueSystemTables,
  {arr('TablesScanned')} AS TablesScanned, {window_text('FirstQuery', 'LastQuery')} AS TimeWindow
FROM g"""


AUTH_FAIL = (f"({S.contains('message', 'authentication failed')} OR "
             f"{S.contains('message', 'password authentication failed')} OR sqlerrcode = '28P01')")


def brute_force_sql(threshold=5, high=10, critical=20, bucket_secs=None):
    bsel = f", {bucket(bucket_secs)} AS Bucket" if bucket_secs else ""
    bgrp = ", Bucket" if bucket_secs else ""
    return with_bronze(f"""ev AS (
  SELECT * FROM (SELECT b.*, {S.extract(P.USER_RE, 'message')} AS UserName,
                        {S.extract(P.HOST_RE, 'message')} AS ClientHost,
                        {S.extract(P.DATABASE_RE, 'message')} AS DatabaseName{bsel}
                 FROM bronze b WHERE {CAT} AND {AUTH_FAIL}) x
  WHERE {S.non_empty('ClientHost')} OR {S.non_empty('UserName')})""", f"""g AS (
  SELECT ClientHost{bgrp}, count(*) AS FailedAttempts, min({TS}) AS FirstAttempt, max({TS}) AS LastAttempt,
    {S.set_n('UserName', 10)} AS Users, {S.set_n('DatabaseName', 5)} AS Databases
  FROM ev GROUP BY ClientHost{bgrp} HAVING count(*) > {threshold})""") + f"""
SELECT LastAttempt AS TimeGenerated, 'Brute Force Authentication' AS AnomalyType,
  {S.severity('FailedAttempts', high, critical)} AS Severity, 'Multiple' AS ServerName,
  ClientHost AS SourceHost, FailedAttempts, {arr('Users')} AS Users, {arr('Databases')} AS Databases,
  {hms_window('FirstAttempt', 'LastAttempt')} AS TimeWindow
FROM g"""


def brute_force_by_code_sql(low=5, high=10, critical=20):
    pred = ("((starts_with(sqlerrcode, '28') AND sqlerrcode <> '28000') OR "
            "(sqlerrcode = '28000' AND lower(errorLevel) IN ('error', 'fatal')) OR "
            f"(lower(errorLevel) IN ('error', 'fatal') AND {S.contains('message', 'authentication')}))")
    return with_bronze(f"""ev AS (
  SELECT b.*, {S.extract(P.USER_RE, 'message')} AS UserName,
    {S.first_non_empty(S.extract(P.HOST_RE, 'message'), default='UNKNOWN')} AS ClientHost,
    {S.extract(P.DATABASE_RE, 'message')} AS DatabaseName, sqlerrcode AS ErrorCode
  FROM bronze b WHERE {pred})""", f"""g AS (
  SELECT ClientHost, LogicalServerName, count(*) AS FailedAttempts, min({TS}) AS FirstAttempt,
    max({TS}) AS LastAttempt, {S.set_n('UserName', 10)} AS Users, {S.set_n('DatabaseName', 5)} AS Databases,
    {S.set_n('ErrorCode', 5)} AS ErrorCodes, {S.set_n('message', 2)} AS SampleMessages
  FROM ev GROUP BY ClientHost, LogicalServerName)""") + f"""
SELECT ClientHost, LogicalServerName AS ServerName, FailedAttempts,
  {S.severity('FailedAttempts', high, critical, low=low)} AS Severity,
  {arr('Users')} AS Users, {arr('Databases')} AS Databases, {arr('ErrorCodes')} AS ErrorCodes,
  FirstAttempt, LastAttempt, {arr('SampleMessages')} AS SampleMessages
FROM g"""


def activity_cte(bucket_secs=300):
    m = "message"
    return f"""am AS (
  SELECT LogicalServerName AS ServerName, {bucket(bucket_secs)} AS "Timestamp",
    CAST(hour({TS}) AS INTEGER) AS HourOfDay, CAST(dayofweek({TS}) AS INTEGER) AS DayOfWeek,
    count(*) AS ActivityCount,
    count(*) FILTER (WHERE {S.contains(m, P.AUDIT_MARK)}) AS AuditLogs,
    count(*) FILTER (WHERE {S.in_list('errorLevel', P.ERROR_LEVELS)}) AS Errors,
    count(*) FILTER (WHERE {S.contains(m, P.CONN_AUTHORIZED)}) AS Connections,
    count(DISTINCT NULLIF({S.extract(P.USER_RE, m)}, '')) AS UniqueUsers,
    count(*) FILTER (WHERE {S.has_any(m, P.ACTIVITY_SELECT_TERMS)}) AS SelectOps,
    count(*) FILTER (WHERE {S.has_any(m, P.ACTIVITY_WRITE_TERMS)}) AS WriteOps,
    count(*) FILTER (WHERE {S.has_any(m, P.ACTIVITY_DDL_TERMS)}) AS DDLOps,
    count(*) FILTER (WHERE {S.has_any(m, P.ACTIVITY_PRIVILEGE_TERMS)}) AS PrivilegeOps
  FROM bronze WHERE {CAT}
  GROUP BY LogicalServerName, {bucket(bucket_secs)}, CAST(hour({TS}) AS INTEGER), CAST(dayofweek({TS}) AS INTEGER))"""


def privilege_offhours_sql(ops="PrivilegeOps"):
    return with_bronze(activity_cte()) + f"""
SELECT "Timestamp", ServerName, {ops}, HourOfDay, DayOfWeek,
  CASE WHEN HourOfDay < 6 OR HourOfDay > 22 THEN 'Midnight'
       WHEN HourOfDay < 9 OR HourOfDay > 17 THEN 'Off-Hours' ELSE 'Business Hours' END AS TimeContext,
  CASE WHEN DayOfWeek IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS DayContext,
  CASE WHEN (HourOfDay < 6 OR HourOfDay > 22) AND DayOfWeek IN (0, 6) THEN 'CRITICAL'
       WHEN HourOfDay < 9 OR HourOfDay > 17 THEN 'HIGH' ELSE 'MEDIUM' END AS Severity,
  ActivityCount
FROM am WHERE {ops} > 0"""


def error_spike_5m_sql(bucket_secs=DAY, threshold=10, high=25, critical=50):
    return with_bronze(f"""ev AS (
  SELECT b.*, {S.label_case(P.ERROR_5M_CATEGORIES, P.ERROR_5M_DEFAULT)} AS ErrorCategory,
    {bucket(bucket_secs)} AS Bucket
  FROM bronze b WHERE {S.in_list('errorLevel', P.ERROR_LEVELS)})""", f"""g AS (
  SELECT Bucket, LogicalServerName, count(*) AS ErrorCount, count(DISTINCT ErrorCategory) AS UniqueErrorTypes,
    list_slice({S.set_n('ErrorCategory', None)}, 1, 5) AS ErrorTypes
  FROM ev GROUP BY Bucket, LogicalServerName HAVING count(*) > {threshold})""") + f"""
SELECT Bucket AS TimeWindow, LogicalServerName AS ServerName, ErrorCount,
  {S.severity('ErrorCount', high, critical)} AS Severity,
  COALESCE(array_to_string(ErrorTypes, '; '), '') AS ErrorTypes, UniqueErrorTypes
FROM g"""


def exfiltration_by_user_sql(threshold=15, high=30, critical=50):
    return with_bronze(sess_cte("sess", authorized_only=True), f"""ev AS (
  SELECT b.* FROM bronze b WHERE {AUDIT} AND {S.has_any('message', P.USER_SELECT_TERMS)} AND {CLIENT})""",
                       """j AS (
  SELECT ev.*, COALESCE(s."User", '') AS "User", COALESCE(s."Database", '') AS "Database",
    COALESCE(s.SourceHost, '') AS SourceHost
  FROM ev LEFT JOIN sess s USING (processId, LogicalServerName))""", f"""g AS (
  SELECT "User", "Database", SourceHost, processId, count(*) AS SelectCount, max({TS}) AS LastQuery,
    count(DISTINCT {S.extract(P.AUDIT_OBJECT_TYPE_RE, 'message')}) AS TablesAccessed
  FROM j GROUP BY "User", "Database", SourceHost, processId HAVING count(*) > {threshold})""") + f"""
SELECT "User", "Database", SourceHost, SelectCount, TablesAccessed,
  {S.severity('SelectCount', high, critical)} AS Severity, LastQuery
FROM g"""


def _quick_sql(pred, exclude, extra_keys, bucket_secs, count_name, threshold, high, critical, anomaly):
    b = f", {bucket(bucket_secs)} AS Bucket" if bucket_secs else ""
    gb = ", Bucket" if bucket_secs else ""
    where = ("WHERE FinalUser NOT IN (" + ", ".join(S.q(x) for x in exclude) + ")") if exclude else ""
    keys = "".join(f", {k}" for k in extra_keys)
    return with_bronze(sess_cte("sess", authorized_only=True), f"""ev AS (
  SELECT b.*, {S.extract(P.USER_RE, 'message')} AS DirectUser{b}
  FROM bronze b WHERE {CAT} AND {pred})""", f"""j AS (
  SELECT * FROM (SELECT ev.*, {S.first_non_empty('DirectUser', 's."User"', default='UNKNOWN')} AS FinalUser
                 FROM ev LEFT JOIN sess s USING (processId, LogicalServerName)) x {where})""", f"""g AS (
  SELECT LogicalServerName{keys}{gb}, count(*) AS {count_name}, max({TS}) AS LastSeen, max(FinalUser) AS "User"
  FROM j GROUP BY LogicalServerName{keys}{gb} HAVING count(*) > {threshold})""") + f"""
SELECT LastSeen AS TimeGenerated, {S.q(anomaly)} AS AnomalyType,
  {S.severity(count_name, high, critical)} AS Severity, LogicalServerName AS ServerName, "User", {count_name}
FROM g"""


def quick_exfil_sql():
    pred = f"{AUDIT} AND {S.has_any('message', P.EXFIL_TERMS)} AND {CLIENT}"
    return _quick_sql(pred, ("azuresu",), ["processId"], None, "SelectCount", 15, 30, 50, "Data Exfiltration")


def quick_destructive_sql():
    pred = f"{AUDIT} AND {S.has_any('message', P.DESTRUCTIVE_TERMS)} AND {CLIENT}"
    return _quick_sql(pred, (), [], DAY, "OperationCount", 5, 10, 20, "Destructive Operations")


def quick_errors_sql():
    return _quick_sql(S.in_list('errorLevel', P.ERROR_LEVELS), (), [], DAY, "ErrorCount", 3, 8, 15, "Error Spike")


def quick_privilege_sql():
    pred = S.has_any('message', P.ACTIVITY_PRIVILEGE_TERMS)
    return _quick_sql(pred, ("azuresu",), [], DAY, "PrivilegeOpsCount", 3, 5, 10, "Privilege Escalation")


# ------------------------------------------------------------------ metric tables
def activity_metrics_sql():
    return with_bronze(activity_cte()) + "SELECT * FROM am"


def error_metrics_sql(bucket_secs=60):
    cat = S.label_case(P.ERROR_METRIC_CATEGORIES, P.ERROR_METRIC_DEFAULT)
    return with_bronze(f"""ev AS (
  SELECT b.*, {cat} AS ErrorCategory FROM bronze b WHERE {CAT} AND {ERRPRED})""") + f"""
SELECT {bucket(bucket_secs)} AS "Timestamp", LogicalServerName AS ServerName, count(*) AS ErrorRate,
  {S.set_text('ErrorCategory', None)} AS ErrorTypes
FROM ev GROUP BY LogicalServerName, {bucket(bucket_secs)}"""


def user_metrics_cte(bucket_secs=3600):
    return [sess_cte("sess"), f"""um AS (
  SELECT {bucket(bucket_secs)} AS "Timestamp", s."User" AS UserName, b.LogicalServerName AS ServerName,
    count(*) AS QueryCount,
    count(*) FILTER (WHERE {S.has_any('message', P.USER_SELECT_TERMS)}) AS SelectQueries,
    count(*) FILTER (WHERE {S.has_any('message', P.USER_DESTRUCTIVE_TERMS)}) AS DestructiveOps
  FROM bronze b JOIN sess s USING (processId, LogicalServerName)
  WHERE {CAT} AND {AUDIT} AND s."User" <> ''
  GROUP BY s."User", b.LogicalServerName, {bucket(bucket_secs)})"""]


def user_metrics_sql():
    return with_bronze(*user_metrics_cte()) + "SELECT * FROM um"


# ------------------------------------------------------------------ dashboards
ERR3 = S.in_list("errorLevel", P.ERROR_LEVELS)
ERR2 = S.in_list("errorLevel", P.ERROR_LEVELS_NO_PANIC)


def pct2(num, den):
    return f"((({num}) * 20000 + ({den})) // (2 * ({den}))) / 100.0"


def activity_by_server_sql(bucket_secs=120):
    return with_bronze() + f"""
SELECT LogicalServerName, {bucket(bucket_secs)} AS {TS}, count(*) AS TotalEvents,
  count(*) FILTER (WHERE {ERR3}) AS Errors, count(*) FILTER (WHERE errorLevel = 'WARNING') AS Warnings,
  count(*) FILTER (WHERE {AUDIT}) AS AuditLogs
FROM bronze WHERE {S.non_empty('LogicalServerName')} AND trim(LogicalServerName) <> ''
GROUP BY LogicalServerName, {bucket(bucket_secs)}"""


def audit_distribution_sql(top=10):
    st = S.extract(P.AUDIT_STATEMENT_RE, 'message')
    return with_bronze() + f"""
SELECT AuditStatement, count(*) AS "Count"
FROM (SELECT {st} AS AuditStatement FROM bronze WHERE {AUDIT}) x
WHERE {S.non_empty('AuditStatement')}
GROUP BY AuditStatement ORDER BY "Count" DESC, AuditStatement LIMIT {top}"""


def top_tables_sql(top=15):
    return with_bronze(f"""ev AS (
  SELECT * FROM (SELECT b.*, {S.extract(P.AUDIT_OBJECT_TYPE_RE, 'message')} AS ObjectType,
                        {S.extract(P.AUDIT_OBJECT_NAME_RE, 'message')} AS ObjectName
                 FROM bronze b WHERE {AUDIT}) x WHERE {S.non_empty('ObjectName')})""") + f"""
SELECT ObjectName, {S.set_text('ObjectType', 5)} AS ObjectTypesDisplay, LogicalServerName,
  count(*) AS AccessCount, max({TS}) AS LastAccess
FROM ev GROUP BY ObjectName, LogicalServerName
ORDER BY AccessCount DESC, ObjectName, LogicalServerName LIMIT {top}"""


def audit_timeline_sql(bucket_secs=120, include_misc=True):
    table = P.AUDIT_OPERATION_TYPES if include_misc else tuple(r for r in P.AUDIT_OPERATION_TYPES if r[2] != "MISC")
    lab = S.label_case(table, P.AUDIT_OPERATION_DEFAULT)
    return with_bronze() + f"""
SELECT OperationType, b AS {TS}, count(*) AS "Count"
FROM (SELECT {lab} AS OperationType, {bucket(bucket_secs)} AS b FROM bronze WHERE {AUDIT}) x
GROUP BY OperationType, b"""


def errors_by_category_sql(bucket_secs=1800):
    lab = S.label_case(P.ERROR_DASHBOARD_CATEGORIES, P.ERROR_DASHBOARD_DEFAULT)
    return with_bronze() + f"""
SELECT ErrorCategory, b AS {TS}, count(*) AS "Count"
FROM (SELECT {lab} AS ErrorCategory, {bucket(bucket_secs)} AS b FROM bronze WHERE {ERR3}) x
GROUP BY ErrorCategory, b"""


def activity_by_backend_sql(bucket_secs=300):
    return with_bronze() + f"""
SELECT backend_type, {bucket(bucket_secs)} AS {TS}, count(*) AS TotalLogs,
  count(*) FILTER (WHERE {ERR2}) AS Errors
FROM bronze WHERE {AUDIT} GROUP BY backend_type, {bucket(bucket_secs)}"""


def top_users_sql(top=10):
    u = f"trim({S.extract(P.USER_RE, 'message')}, '\"')"
    d = f"NULLIF(trim({S.extract(P.DATABASE_RE, 'message')}, '\"'), '')"
    return with_bronze() + f"""
SELECT UserName, count(*) AS TotalActivity, count(*) FILTER (WHERE {AUDIT}) AS AuditLogs,
  count(*) FILTER (WHERE {S.contains('message', P.CONN_AUTHORIZED)}) AS Connections,
  count(*) FILTER (WHERE {ERR2}) AS Errors, count(DISTINCT db) AS Databases, max({TS}) AS LastActivity
FROM (SELECT *, {u} AS UserName, {d} AS db FROM bronze) x
WHERE {S.non_empty('UserName')}
GROUP BY UserName ORDER BY TotalActivity DESC, UserName LIMIT {top}"""


def top_hosts_sql(top=10, high=20, medium=5):
    return with_bronze(f"""ev AS (
  SELECT * FROM (SELECT b.*, {S.extract(P.HOST_RE, 'message')} AS ClientHost,
                        {S.extract(P.USER_RE, 'message')} AS UserName FROM bronze b) x
  WHERE {S.non_empty('ClientHost')})""", f"""g AS (
  SELECT ClientHost, count(*) AS TotalConnections, count(DISTINCT NULLIF(UserName, '')) AS UniqueUsers,
    {S.set_text('UserName', 10)} AS UsersDisplay, count(*) FILTER (WHERE {ERR2}) AS Errors,
    min({TS}) AS FirstSeen, max({TS}) AS LastSeen
  FROM ev GROUP BY ClientHost ORDER BY TotalConnections DESC, ClientHost LIMIT {top})""") + f"""
SELECT ClientHost, TotalConnections, UniqueUsers, UsersDisplay, Errors,
  {pct2('Errors', 'TotalConnections')} AS ErrorRate,
  CASE WHEN {pct2('Errors', 'TotalConnections')} > {high} THEN 'HIGH'
       WHEN {pct2('Errors', 'TotalConnections')} > {medium} THEN 'MEDIUM' ELSE 'LOW' END AS Risk,
  FirstSeen, LastSeen
FROM g"""


def user_db_heatmap_sql(min_activity=10, top=50):
    cond = S.contains_any('message', (P.AUDIT_MARK, P.CONN_AUTHORIZED))
    return with_bronze() + f"""
SELECT UserName, DatabaseName, count(*) AS ActivityCount, count(*) FILTER (WHERE {AUDIT}) AS AuditLogs,
  max({TS}) AS LastActivity
FROM (SELECT *, {S.extract(P.USER_RE, 'message')} AS UserName, {S.extract(P.DATABASE_RE, 'message')} AS DatabaseName
      FROM bronze WHERE {cond}) x
WHERE {S.non_empty('UserName')} AND {S.non_empty('DatabaseName')}
GROUP BY UserName, DatabaseName HAVING count(*) > {min_activity}
ORDER BY ActivityCount DESC, UserName, DatabaseName LIMIT {top}"""


def auth_failures_sql(top=20):
    return with_bronze() + f"""
SELECT UserName, ClientHost, count(*) AS FailedAttempts,
  {S.severity('count(*)', 10, 20, low=5)} AS ThreatLevel,
  {arr(S.set_n('DatabaseName', None))} AS Databases, min({TS}) AS FirstAttempt, max({TS}) AS LastAttempt
FROM (SELECT *, {S.extract(P.USER_RE, 'message')} AS UserName, {S.extract(P.HOST_RE, 'message')} AS ClientHost,
             {S.extract(P.DATABASE_RE, 'message')} AS DatabaseName FROM bronze WHERE {AUTH_FAIL}) x
GROUP BY UserName, ClientHost ORDER BY FailedAttempts DESC, UserName, ClientHost LIMIT {top}"""


def top_error_codes_sql(top=15):
    return with_bronze(f"""g AS (
  SELECT sqlerrcode, errorLevel, count(*) AS "Count", max({TS}) AS LastOccurrence
  FROM bronze WHERE sqlerrcode <> '00000' AND sqlerrcode <> ''
  GROUP BY sqlerrcode, errorLevel ORDER BY "Count" DESC, sqlerrcode, errorLevel LIMIT {top})""") + f"""
SELECT sqlerrcode, {S.label_case(P.ERROR_CODE_CLASSES, P.ERROR_CODE_DEFAULT)} AS ErrorDescription,
  errorLevel, "Count", LastOccurrence FROM g"""


def metrics_latest_sql(top=20):
    return with_bronze(activity_cte()) + f'SELECT * FROM am ORDER BY "Timestamp" DESC, ServerName LIMIT {top}'


def metrics_stats_sql():
    return with_bronze(activity_cte()) + """
SELECT ServerName, count(*) AS Records, avg(ActivityCount) AS AvgActivity, max(ActivityCount) AS MaxActivity,
  avg(Errors) AS AvgErrors, avg(UniqueUsers) AS AvgUniqueUsers
FROM am GROUP BY ServerName"""


def minute_diff(later, earlier):
    return f"date_diff('minute', date_trunc('minute', {earlier}), date_trunc('minute', {later}))"


def data_freshness_sql(fresh=5):
    return with_bronze(f"""g AS (
  SELECT max({TS}) AS LastEvent, min({TS}) AS FirstEvent, count(*) AS TotalEvents FROM bronze)""") + f"""
SELECT LastEvent, FirstEvent, TotalEvents,
  date_diff('day', CAST(FirstEvent AS DATE), CAST(LastEvent AS DATE)) AS TimeRange,
  CASE WHEN {minute_diff('LastEvent', 'LastEvent')} < {fresh} THEN 'Fresh data' ELSE 'Stale data' END AS Status,
  {minute_diff('LastEvent', 'LastEvent')} AS LatencyMinutes
FROM g"""


def audit_coverage_sql():
    return with_bronze(f"""g AS (
  SELECT LogicalServerName, count(*) AS TotalLogs, count(*) FILTER (WHERE {AUDIT}) AS AuditLogs,
    count(*) FILTER (WHERE {ERR3}) AS ErrorLogs, count(*) FILTER (WHERE errorLevel = 'WARNING') AS WarningLogs
  FROM bronze GROUP BY LogicalServerName)""") + f"""
SELECT *, {pct2('AuditLogs', 'TotalLogs')} AS AuditCoverage, {pct2('ErrorLogs', 'TotalLogs')} AS ErrorRate FROM g"""


def backend_distribution_sql():
    return with_bronze() + 'SELECT backend_type, count(*) AS "Count" FROM bronze GROUP BY backend_type'


def metrics_status_sql(healthy=10):
    return with_bronze(activity_cte(), """g AS (
  SELECT ServerName, max("Timestamp") AS LastUpdate, count(*) AS TotalRecords,
    avg(ActivityCount) AS AvgActivity, max(Errors) AS MaxErrors FROM am GROUP BY ServerName)""",
                       """n AS (SELECT max("Timestamp") AS now_ts FROM am)""") + f"""
SELECT ServerName, CASE WHEN {minute_diff('now_ts', 'LastUpdate')} < {healthy} THEN 'Healthy' ELSE 'Delayed' END AS Status,
  {minute_diff('now_ts', 'LastUpdate')} AS DelayMinutes, LastUpdate, TotalRecords, AvgActivity, MaxErrors
FROM g, n"""


def error_code_diagnostics_sql():
    return with_bronze() + """
SELECT sqlerrcode, errorLevel, count(*) AS count_, max(message) AS sample_msg
FROM bronze WHERE sqlerrcode <> '00000' AND sqlerrcode <> '' GROUP BY sqlerrcode, errorLevel"""


def privilege_ops_by_user_sql():
    return with_bronze() + f"""
SELECT UserName, LogicalServerName, count(*) AS Operations
FROM (SELECT *, {S.extract(P.USER_RE, 'message')} AS UserName FROM bronze
      WHERE {S.has_any('message', P.ACTIVITY_PRIVILEGE_TERMS)}) x
GROUP BY UserName, LogicalServerName HAVING count(*) > 0"""


def errors_per_minute_sql(bucket_secs=60, threshold=15):
    return with_bronze() + f"""
SELECT {bucket(bucket_secs)} AS {TS}, count(*) AS ErrorCount FROM bronze WHERE {ERR3}
GROUP BY {bucket(bucket_secs)} HAVING count(*) > {threshold}"""


def history_depth_sql():
    return with_bronze(activity_cte()) + "SELECT ServerName, count(*) AS count_ FROM am GROUP BY ServerName"


def connection_sample_sql(n=10):
    return with_bronze() + f"""
SELECT * FROM bronze WHERE {S.contains('message', P.CONN_AUTHORIZED)}
ORDER BY {TS} DESC, LogicalServerName, processId, message LIMIT {n}"""


def hourly_profile_sql():
    return with_bronze(activity_cte()) + """
SELECT HourOfDay, DayOfWeek, count(*) AS Buckets, avg(ActivityCount) AS AvgActivity, avg(Errors) AS AvgErrors,
  avg(UniqueUsers) AS AvgUniqueUsers, max(ActivityCount) AS MaxActivity
FROM am GROUP BY CUBE (HourOfDay, DayOfWeek)"""


def active_users_today_sql():
    return with_bronze("""d AS (SELECT date_trunc('day', max(EventProcessedUtcTime)) AS day0 FROM bronze)""") + f"""
SELECT UserName, count(*) AS Connections, count(DISTINCT NULLIF(DatabaseName, '')) AS Databases,
  min({TS}) AS FirstConnection, max({TS}) AS LastConnection
FROM (SELECT b.*, {S.extract(P.USER_RE, 'message')} AS UserName, {S.extract(P.DATABASE_RE, 'message')} AS DatabaseName
      FROM bronze b, d WHERE b.{TS} >= d.day0 AND {S.contains('message', P.CONN_AUTHORIZED)}) x
WHERE {S.non_empty('UserName')} GROUP BY UserName"""


def current_activity_sql():
    return with_bronze() + f"""
SELECT LogicalServerName, count(*) AS TotalEvents, count(*) FILTER (WHERE {AUDIT}) AS AuditLogs,
  count(*) FILTER (WHERE {S.contains('message', P.CONN_AUTHORIZED)}) AS Connections,
  count(*) FILTER (WHERE {ERR3}) AS Errors,
  count(DISTINCT NULLIF({S.extract(P.USER_RE, 'message')}, '')) AS Users, max({TS}) AS LastEvent
FROM bronze GROUP BY LogicalServerName"""


# ------------------------------------------------------------------ union, alerts, KPIs
def _kv(k, expr):
    return f"'{k}=' || COALESCE(CAST({expr} AS VARCHAR), '')"


COMMON_ORDER = ('TimeGenerated DESC, AnomalyType NULLS FIRST, Severity NULLS FIRST, ServerName NULLS FIRST, '
                '"User" NULLS FIRST, "Database" NULLS FIRST, SourceHost NULLS FIRST, MetricName NULLS FIRST, '
                'MetricValue NULLS FIRST, Details NULLS FIRST')


def _union_parts():
    """Per detector: (SQL, user, database, host, metric, entries of Details)."""
    N = "CAST(NULL AS VARCHAR)"
    return [
        (exfiltration_sql(), '"User"', '"Database"', "SourceHost", "SelectCount",
             [("ProcessID", "ProcessID"), ("BackendType", "BackendType"), ("TimeWindow", "TimeWindow"),
              ("TablesAccessed", "TablesAccessed"), ("SampleQueries", "SampleQueries")]),
        (destructive_ops_sql(), '"User"', '"Database"', "SourceHost", "OperationCount",
             [("BackendType", "BackendType"), ("Operations", "Operations"), ("TablesAffected", "TablesAffected"),
              ("TimeWindow", "TimeWindow"), ("SampleMessages", "SampleMessages")]),
        (error_spike_sql(), '"User"', '"Database"', "SourceHost", "ErrorCount",
             [("BackendType", "BackendType"), ("ErrorTypes", "ErrorTypes"), ("ErrorCodes", "ErrorCodes"),
              ("TimeWindow", "TimeWindow"), ("SampleErrors", "SampleErrors")]),
        (privilege_escalation_sql(), '"User"', N, N, "PrivilegeOpsCount",
             [("Operations", "Operations"), ("LogTypes", "LogTypes"), ("TimeWindow", "TimeWindow"),
              ("SampleQueries", "SampleQueries")]),
        (cross_schema_recon_sql(), '"User"', N, N, "SchemasAccessed",
             [("SchemaList", "SchemaList"), ("TablesAccessed", "TablesAccessed"), ("TimeWindow", "TimeWindow")]),
        (deep_schema_enum_sql(), '"User"', N, N, "SystemTableQueries",
             [("RiskLevel", "RiskLevel"), ("UniqueSystemTables", "UniqueSystemTables"),
              ("TablesScanned", "TablesScanned"), ("TimeWindow", "TimeWindow")]),
        (brute_force_sql(), N, N, "SourceHost", "FailedAttempts",
             [("Users", "Users"), ("Databases", "Databases"), ("TimeWindow", "TimeWindow")]),
    ]


def anomalies_union_sql(hunt=True):
    def part(sql, u, d, h, metric, kvs):
        det = "concat_ws('; ', " + ", ".join(_kv(k, e) for k, e in kvs) + ")"
        return (f"SELECT TimeGenerated, AnomalyType, Severity, ServerName, {u} AS \"User\", {d} AS \"Database\", "
                f"{h} AS SourceHost, '{metric}' AS MetricName, CAST({metric} AS BIGINT) AS MetricValue, "
                f"{det} AS Details FROM ({sql}) x")
    return "\nUNION ALL\n".join(f"({part(*p)})" for p in _union_parts())


def anomaly_details_sql():
    def part(sql, u, d, h, metric, kvs):
        names = ", ".join(f"'{k}'" for k, _ in kvs)
        values = ", ".join(f"COALESCE(CAST({e} AS VARCHAR), '')" for _, e in kvs)
        return (f'SELECT TimeGenerated, AnomalyType, Severity, ServerName, {u} AS "User", {h} AS SourceHost, '
                f"CAST({metric} AS BIGINT) AS MetricValue, TimeWindow, unnest([{names}]) AS Detail, "
                f"unnest([{values}]) AS DetailValue FROM ({sql}) x")
    return "\nUNION ALL\n".join(f"({part(*p)})" for p in _union_parts())


def condition_alerts_sql():
    rows = f"""
SELECT TimeGenerated, AnomalyType, Severity, ServerName, "User", CAST(MetricValue AS DOUBLE) AS Score
FROM ({anomalies_union_sql()}) u
UNION ALL SELECT ts, 'ML Baseline Deviation',
  CASE WHEN abs(score) > 3 THEN 'CRITICAL' WHEN abs(score) > 2 THEN 'HIGH' ELSE 'MEDIUM' END,
  ServerName, NULL, abs(round(score, 2)) FROM sc WHERE anomalies <> 0"""
    alerts = """
  VALUES ('Potential Data Exfiltration', 'CRITICAL', NULL, 'Data Exfiltration', 'suspiciousDataAccess', 'Email + Teams', '5m'),
    ('Mass Destructive Operations', 'CRITICAL,HIGH', NULL, 'Destructive Operations', 'destructiveOperations', 'Email + Teams + SMS', '2m'),
    ('Privilege Escalation', 'CRITICAL,HIGH', NULL, 'Privilege Escalation', 'privilegeEscalation', 'Email + Teams + Incident in Sentinel', '5m'),
    ('ML Baseline Deviation', 'CRITICAL', 3.0, 'ML Anomaly Detection', 'mlAnomalyDetection', 'Email + Teams', '5m')"""
    return with_bronze(*series_ctes()) + f"""
SELECT AlertName, QuerySource, "Action", Frequency, TimeGenerated, r.AnomalyType, Severity, ServerName, "User", Score
FROM ({rows}) r JOIN ({alerts}) a(AnomalyType, sev, above, AlertName, QuerySource, "Action", Frequency)
  ON r.AnomalyType = a.AnomalyType AND list_contains(string_split(sev, ','), Severity) AND (above IS NULL OR Score > above)"""


def activity_rollup_sql(span):
    return with_bronze() + f"""
SELECT LogicalServerName AS ServerName, date_trunc('{span}', EventProcessedUtcTime) AS "Timestamp",
  count(*) AS ActivityCount, count(*) FILTER (WHERE contains(lower(message), 'audit:')) AS AuditLogs,
  count(*) FILTER (WHERE errorLevel IN ('ERROR', 'FATAL', 'PANIC')) AS Errors,
  count(DISTINCT nullif(regexp_extract(message, 'user=([^\\s,]+)', 1), '')) AS UniqueUsers,
  count(DISTINCT nullif(regexp_extract(message, 'host=([^\\s]+)', 1), '')) AS UniqueHosts
FROM bronze WHERE category = 'PostgreSQLLogs' GROUP BY 1, 2"""


def backend_sessions_sql(gap="1 DAY"):
    return with_bronze() + f"""
, marked AS (SELECT *, CASE WHEN EventProcessedUtcTime - lag(EventProcessedUtcTime) OVER w <= INTERVAL {gap} THEN 0 ELSE 1 END AS fresh
  FROM bronze WHERE EventProcessedUtcTime IS NOT NULL
  WINDOW w AS (PARTITION BY processId, LogicalServerName ORDER BY EventProcessedUtcTime)),
spells AS (SELECT *, sum(fresh) OVER (PARTITION BY processId, LogicalServerName ORDER BY EventProcessedUtcTime) AS spell FROM marked)
SELECT processId, LogicalServerName, min(EventProcessedUtcTime) AS SessionStart, max(EventProcessedUtcTime) AS LastEvent,
  count(*) AS Events, count(*) FILTER (WHERE contains(lower(message), 'audit:')) AS AuditLogs,
  count(*) FILTER (WHERE errorLevel IN ('ERROR', 'FATAL', 'PANIC')) AS Errors,
  max(regexp_extract(message, 'user=([^\\s,]+)', 1)) AS "User"
FROM spells GROUP BY processId, LogicalServerName, spell"""


def recent_errors_sql():
    return f"""
SELECT ServerName, count(*) AS Minutes, CAST(sum(ErrorRate) AS BIGINT) AS Errors, max("Timestamp") AS LastMinute
FROM ({error_metrics_sql()}) m
WHERE "Timestamp" >= (SELECT max(EventProcessedUtcTime) FROM ({bronze_sql()}) b) - INTERVAL 168 HOUR
GROUP BY ServerName"""


def anomalies_all_sql(limit=100):
    return f"SELECT * FROM ({anomalies_union_sql()}) u ORDER BY {COMMON_ORDER} LIMIT {limit}"


def security_kpis_sql(host_error_rate=10):
    u = anomalies_union_sql()
    host = S.extract(P.HOST_RE, 'message')
    return with_bronze(f"a AS ({u})", f"""h AS (
  SELECT ClientHost, count(*) AS n, count(*) FILTER (WHERE {ERR2}) AS e
  FROM (SELECT *, {host} AS ClientHost FROM bronze) x WHERE {S.non_empty('ClientHost')} GROUP BY ClientHost)""") + f"""
SELECT 'anomalies_by_type_severity' AS Kpi, concat_ws(' / ', AnomalyType, Severity) AS Dimension, count(*) AS "Value"
FROM a GROUP BY concat_ws(' / ', AnomalyType, Severity)
UNION ALL
SELECT 'users_with_anomalies', '', count(DISTINCT "User") FROM a WHERE "User" <> '' AND "User" <> 'UNKNOWN'
UNION ALL
SELECT 'hosts_error_rate_over_10pct', '', count(*) FROM h WHERE {pct2('e', 'n')} > {host_error_rate}
UNION ALL
SELECT 'users_auth_failures_over_10', '', count(*) FROM (
  SELECT {S.extract(P.USER_RE, 'message')} AS u FROM bronze WHERE {AUTH_FAIL} GROUP BY 1 HAVING count(*) > 10) f"""


def alert_candidates_sql(day=DAY, exfil_bucketed=False):
    b = bucket(day)
    du = S.first_non_empty(S.extract(P.USER_RE, 'message'), default='UNKNOWN')
    cls = S.extract(P.AUDIT_CLASS_RE, 'message')
    stm = S.extract(P.AUDIT_STATEMENT_RE, 'message')

    def cand(rule, where, keys, bucketed, metric="count(*)"):
        wcol = f"{b}" if bucketed else "CAST(NULL AS TIMESTAMP)"
        gk = " || '|' || ".join(f"COALESCE(CAST({k} AS VARCHAR), '')" for k in keys)
        gby = ", ".join(keys + (["WindowStart"] if bucketed else []))
        return f"""SELECT '{rule}' AS RuleName, LogicalServerName AS ServerName, {gk} AS GroupKey,
  {"WindowStart" if bucketed else "CAST(NULL AS TIMESTAMP)"} AS WindowStart,
  CAST({metric} AS DOUBLE) AS MetricValue, max({TS}) AS TimeGenerated
FROM (SELECT *, {wcol} AS WindowStart, {du} AS FinalUser FROM bronze) x WHERE {where}
GROUP BY {gby}"""
    parts = [
        cand("Data Exfil", f"{CAT} AND {AUDIT} AND {S.has_any('message', P.EXFIL_TERMS)} AND {CLIENT} "
                           f"AND ({cls} = 'READ' OR {stm} = 'SELECT') AND FinalUser <> 'azuresu'",
             ["LogicalServerName", "backend_type", "processId"], exfil_bucketed),
        cand("Destruction", f"{CAT} AND {AUDIT} AND {S.has_any('message', P.DESTRUCTIVE_PREFILTER_TERMS)} "
                            f"AND {S.has_any('message', P.DESTRUCTIVE_TERMS)} AND ({cls} = 'WRITE' OR "
                            f"{S.has_any(f'trim({stm}, chr(32))', P.DESTRUCTIVE_TERMS)}) "
                            f"AND FinalUser NOT IN ('azuresu', 'azure_maintenance', 'UNKNOWN') AND {CLIENT}",
             ["LogicalServerName", "backend_type"], True),
        cand("Privilege", f"{CAT} AND {S.has_any('message', P.PRIVILEGE_ALERT_TERMS)} AND ({CLIENT} OR "
                          f"{S.empty('backend_type')}) AND FinalUser NOT IN ('azuresu', 'azure_maintenance')",
             ["LogicalServerName"], True),
        cand("Error Spike", f"{CAT} AND {ERRPRED}", ["LogicalServerName", "backend_type"], True),
    ]
    sch = S.extract(P.AUDIT_SCHEMA_RE, 'message')
    tab = S.extract(P.AUDIT_OBJECT_TYPE_RE, 'message')
    schema_name = (f"CASE WHEN {S.non_empty(sch)} THEN {sch} ELSE {S.extract(P.SCHEMA_PREFIX_RE, tab)} END")
    parts.append(f"""SELECT 'Recon (Schema)' AS RuleName, LogicalServerName AS ServerName,
  COALESCE(CAST(LogicalServerName AS VARCHAR), '') || '|' || COALESCE(CAST(processId AS VARCHAR), '') AS GroupKey,
  WindowStart, CAST(count(DISTINCT SchemaName) AS DOUBLE) AS MetricValue, max({TS}) AS TimeGenerated
FROM (SELECT *, {b} AS WindowStart, {du} AS FinalUser, {schema_name} AS SchemaName FROM bronze
      WHERE {CAT} AND {AUDIT} AND {CLIENT} AND ({S.non_empty(sch)} OR {S.non_empty(tab)})) x
WHERE {S.non_empty('SchemaName')} AND SchemaName NOT IN ('pg_catalog', 'information_schema', '')
  AND FinalUser <> 'azuresu'
GROUP BY LogicalServerName, processId, WindowStart""")
    parts.append(cand("Recon (Deep)", f"{CAT} AND {AUDIT} AND {CLIENT} AND {S.has_any('message', P.CATALOG_TERMS)} "
                                      f"AND FinalUser <> 'azuresu'", ["LogicalServerName", "processId"], True))
    return "\nUNION ALL\n".join(f"({p})" for p in parts)


def rules_values(table=None):
    from auditlens.operators.alerts import RULES

    def lit(v):
        return "NULL" if v is None else (S.q(v) if isinstance(v, str) else f"CAST({v} AS DOUBLE)")
    rows = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in table or RULES)
    return (f"rules(RuleName, QuerySource, TriggerField, Threshold, HighAbove, CriticalAbove, BaseSeverity, "
            f"Action, Frequency) AS (VALUES {rows})")


ML_CANDIDATES = ("SELECT 'ML Anomaly' AS RuleName, ServerName, ServerName AS GroupKey, ts AS WindowStart, "
                 "abs(round(score, 2)) AS MetricValue, ts AS TimeGenerated FROM sc WHERE anomalies <> 0")


def alert_rules_sql():
    return with_bronze(*series_ctes(), f"c AS ({alert_candidates_sql()} UNION ALL ({ML_CANDIDATES}))", rules_values()) + """
SELECT RuleName, QuerySource, TriggerField, CAST(Threshold AS DOUBLE) AS Threshold, ServerName, GroupKey,
  WindowStart, MetricValue,
  CASE WHEN CriticalAbove IS NOT NULL AND MetricValue > CriticalAbove THEN 'CRITICAL'
       WHEN HighAbove IS NOT NULL AND MetricValue > HighAbove THEN 'HIGH' ELSE BaseSeverity END AS Severity,
  Action, Frequency, TimeGenerated
FROM c JOIN rules USING (RuleName) WHERE MetricValue > Threshold"""


# ------------------------------------------------------------------ series
def series_ctes(step=300, periods=(12, 288, 2016), min_corr=0.6, threshold=1.5):
    def clean(c):
        return f"(CASE WHEN {c} IS NULL OR isnan({c}) THEN 0.0 ELSE {c} END)"
    cv = {p: f"(CASE WHEN n >= {2 * p} THEN {clean(f'c{p}')} ELSE 0.0 END)" for p in periods}
    whens = []
    for i, p in enumerate(periods):
        conds = [f"{cv[p]} >= {cv[q]}" for q in periods[i + 1:]] + [f"{cv[p]} >= {min_corr}"]
        whens.append(f"WHEN {' AND '.join(conds)} THEN {p}")
    lags = ", ".join(f"lag(d, {p}) OVER (PARTITION BY ServerName ORDER BY idx) AS l{p}" for p in periods)
    corrs = ", ".join(f"corr(d, l{p}) AS c{p}" for p in periods)
    return [activity_cte(), f"""s AS (
  SELECT ServerName, {S.bin_ts('"Timestamp"', step)} AS ts, CAST(sum(ActivityCount) AS BIGINT) AS v
  FROM am WHERE {S.non_empty('ServerName')} GROUP BY ServerName, {S.bin_ts('"Timestamp"', step)})""",
            """bnd AS (SELECT ServerName, min(ts) AS t0, max(ts) AS t1 FROM s GROUP BY ServerName)""",
            f"""grid AS (
  SELECT ServerName, ts, CAST(round((epoch(ts) - epoch(t0)) / {step}) AS BIGINT) AS idx
  FROM (SELECT ServerName, unnest(generate_series(t0, t1, INTERVAL '{step} seconds')) AS ts, t0
        FROM bnd) g)""",
            """x AS (SELECT g.ServerName, g.ts, g.idx, COALESCE(s.v, 0) AS v FROM grid g LEFT JOIN s USING (ServerName, ts))""",
            """tr AS (
  SELECT ServerName, COALESCE(regr_slope(v, idx), 0.0) AS slope, COALESCE(regr_intercept(v, idx), avg(v)) AS icpt,
    count(*) AS n FROM x GROUP BY ServerName)""",
            """d AS (SELECT x.*, tr.icpt + tr.slope * x.idx AS trend, x.v - (tr.icpt + tr.slope * x.idx) AS d, tr.n
       FROM x JOIN tr USING (ServerName))""",
            f"""ac AS (SELECT ServerName, max(n) AS n, {corrs} FROM (SELECT *, {lags} FROM d) l GROUP BY ServerName)""",
            f"""per AS (SELECT ServerName, CASE {' '.join(whens)} ELSE 0 END AS period FROM ac)""",
            """dp AS (SELECT d.*, per.period, CASE WHEN per.period > 0 THEN d.idx % per.period END AS slot
        FROM d JOIN per USING (ServerName))""",
            """seas AS (SELECT ServerName, slot, avg(d) AS seasonal FROM dp WHERE period > 0 GROUP BY ServerName, slot)""",
            """r AS (SELECT dp.ServerName, dp.ts, dp.v, dp.trend + COALESCE(seas.seasonal, 0.0) AS baseline,
              dp.v - (dp.trend + COALESCE(seas.seasonal, 0.0)) AS resid
       FROM dp LEFT JOIN seas ON seas.ServerName = dp.ServerName AND seas.slot = dp.slot)""",
            """q AS (SELECT ServerName, quantile_cont(resid, 0.1) AS q10, quantile_cont(resid, 0.9) AS q90
       FROM r GROUP BY ServerName)""",
            f"""sc AS (
  SELECT *, CASE WHEN abs(score) > {threshold} THEN CAST(sign(score) AS INTEGER) ELSE 0 END AS anomalies
  FROM (SELECT r.*, CASE WHEN q90 - q10 <= 0 THEN 0.0
                         WHEN resid > q90 THEN (resid - q90) / (q90 - q10)
                         WHEN resid < q10 THEN (resid - q10) / (q90 - q10) ELSE 0.0 END AS score
        FROM r JOIN q USING (ServerName)) z)"""]


def baseline_deviation_sql(top=20, high=2.0, critical=3.0):
    return with_bronze(*series_ctes()) + f"""
SELECT ts AS TimeGenerated, 'ML Baseline Deviation' AS AnomalyType,
  CASE WHEN anomalies > 0 THEN 'Above Normal' ELSE 'Below Normal' END AS AnomalyDirection,
  CASE WHEN abs(score) > {critical} THEN 'CRITICAL' WHEN abs(score) > {high} THEN 'HIGH' ELSE 'MEDIUM' END AS Severity,
  ServerName, v AS ActivityCount, round(baseline, 0) AS ExpectedBaseline, round(score, 2) AS DeviationScore
FROM sc WHERE anomalies <> 0
ORDER BY abs(round(score, 2)) DESC, ServerName, ts LIMIT {top}"""


def baseline_deviation_pct_sql(top=20):
    return with_bronze(*series_ctes()) + f"""
SELECT ts AS "Timestamp", ServerName, v AS Activity, round(baseline, 0) AS Baseline,
  round(CASE WHEN baseline = 0 THEN NULL ELSE abs(v - baseline) * 100 / baseline END, 1) AS DeviationPercent,
  CASE WHEN anomalies > 0 THEN 'Activity Spike' ELSE 'Activity Drop' END AS Direction,
  CASE WHEN abs(score) > 3.5 THEN 'CRITICAL' WHEN abs(score) > 2.5 THEN 'HIGH'
       WHEN abs(score) > 1.5 THEN 'MEDIUM' ELSE 'LOW' END AS Severity,
  round(score, 2) AS AnomalyScore
FROM sc WHERE anomalies <> 0
ORDER BY abs(score) DESC, ServerName, ts LIMIT {top}"""


def baseline_model_sql():
    return with_bronze(*series_ctes()) + """
SELECT ServerName, t0 AS origin, CAST(period AS INTEGER) AS period, n, round(slope, 9) + 0.0 AS slope, round(icpt, 9) + 0.0 AS icpt,
  round(q10, 9) + 0.0 AS q10, round(q90, 9) + 0.0 AS q90,
  (SELECT count(*) FROM seas WHERE seas.ServerName = tr.ServerName) AS n_slots
FROM tr JOIN bnd USING (ServerName) JOIN per USING (ServerName) JOIN q USING (ServerName)"""


def activity_series_sql():
    return with_bronze(*series_ctes()) + """
SELECT ServerName, count(*) AS Points, min(ts) AS FirstPoint, max(ts) AS LastPoint,
  string_agg(CAST(v AS VARCHAR), ', ' ORDER BY ts) AS ActivityCounts
FROM x GROUP BY ServerName"""


def series_expanded_sql():
    return with_bronze(*series_ctes()) + """
SELECT ServerName, ts AS "Timestamp", v AS ActivityCount, CAST(anomalies AS DOUBLE) AS anomalies,
  round(score, 6) + 0.0 AS score, round(baseline, 6) + 0.0 AS baseline
FROM sc"""


def stream_health_sql(cut="2024-01-15 10:02:00", delay="10 MINUTES", bin_secs=300):
    end = f"{S.bin_ts(TS, bin_secs)} + INTERVAL {bin_secs} SECONDS"
    return with_bronze(f"""landed AS (
  SELECT *, CASE WHEN {TS} < TIMESTAMP '{cut}' AND processId % 7 <> 0 THEN 0 ELSE 1 END AS batch FROM bronze)""",
                       """mark AS (SELECT max(EventProcessedUtcTime) AS newest FROM landed WHERE batch = 0)""",
                       f"""marked AS (
  SELECT l.*, CASE WHEN batch = 1 THEN newest END AS before, CASE WHEN batch = 1 THEN newest - INTERVAL {delay} END AS wm
  FROM landed l, mark)""") + f"""
SELECT CAST(batch AS BIGINT) AS Batch, LogicalServerName AS ServerName, count(*) AS "Rows",
  count(*) FILTER (WHERE {TS} < wm) AS LateRows, count(*) FILTER (WHERE {end} <= wm) AS DroppedRows,
  COALESCE(max(CASE WHEN {TS} < wm THEN CAST(epoch_us(before) - epoch_us({TS}) AS DOUBLE) / 1000000.0 END), 0.0) AS MaxDelaySeconds,
  min({TS}) AS OldestEvent, max({TS}) AS NewestEvent, max(wm) AS Watermark
FROM marked GROUP BY batch, LogicalServerName"""


def exfiltration_by_message_user_sql(threshold=15):
    return with_bronze() + f"""
SELECT {S.extract(P.USER_RE, 'message')} AS UserName, count(*) AS SelectCount, 'CRITICAL' AS Severity
FROM bronze WHERE {AUDIT} AND {S.has_any('message', P.USER_SELECT_TERMS)}
GROUP BY 1 HAVING count(*) > {threshold}"""


def alert_stream_sql(ml=False):
    candidates = alert_candidates_sql(exfil_bucketed=True) + (f" UNION ALL ({ML_CANDIDATES})" if ml else "")
    from auditlens.plans.profile import HUNT_RULES
    return with_bronze(*(series_ctes() if ml else []), f"c AS ({candidates})", rules_values(HUNT_RULES)) + """
SELECT RuleName, QuerySource, TriggerField, CAST(Threshold AS DOUBLE) AS Threshold, ServerName, GroupKey,
  WindowStart, MetricValue,
  CASE WHEN CriticalAbove IS NOT NULL AND MetricValue > CriticalAbove THEN 'CRITICAL'
       WHEN HighAbove IS NOT NULL AND MetricValue > HighAbove THEN 'HIGH' ELSE BaseSeverity END AS Severity,
  Action, Frequency, TimeGenerated
FROM c JOIN rules USING (RuleName)
WHERE MetricValue > Threshold"""


def alert_once_stream_sql(quiet=7 * DAY):
    return f"""SELECT DISTINCT RuleName, QuerySource, Action, Frequency, ServerName, GroupKey,
  {S.bin_ts('WindowStart', quiet)} AS Burst FROM ({alert_stream_sql()}) a"""


def alert_burst_stream_sql(quiet=2 * DAY):
    """Gaps and islands: a window's time is the last microsecond of its day."""
    return f"""
WITH a AS (SELECT *, WindowStart + INTERVAL '{DAY} seconds' - INTERVAL '1 microsecond' AS moment FROM ({alert_stream_sql()}) x),
b AS (SELECT *, CASE WHEN moment > lag(moment) OVER w + INTERVAL '{quiet} seconds' OR lag(moment) OVER w IS NULL THEN 1 ELSE 0 END AS fresh
  FROM a WINDOW w AS (PARTITION BY RuleName, ServerName, GroupKey ORDER BY moment)),
c AS (SELECT *, sum(fresh) OVER (PARTITION BY RuleName, ServerName, GroupKey ORDER BY moment) AS island FROM b)
SELECT RuleName, QuerySource, Action, Frequency, ServerName, GroupKey, min(WindowStart) AS BurstStart,
  max(WindowStart) + INTERVAL '{DAY} seconds' AS BurstEnd, count(*) AS Windows, max(MetricValue) AS PeakValue,
  arg_max(Severity, MetricValue) AS Severity, max(TimeGenerated) AS TimeGenerated
FROM c GROUP BY RuleName, QuerySource, Action, Frequency, ServerName, GroupKey, island"""


# ------------------------------------------------------------------ ingest, parse, sessions
def bronze_sql():
    return with_bronze() + "SELECT * FROM bronze"


def audit_parse_sql():
    m = "message"
    return with_bronze() + f"""
SELECT {TS}, LogicalServerName, processId,
  {S.extract(P.AUDIT_CLASS_RE, m)} AS AuditClass, {S.extract(P.AUDIT_STATEMENT_RE, m)} AS AuditStatement,
  {S.extract(P.AUDIT_OBJECT_TYPE_RE, m)} AS ObjectType, {S.extract(P.AUDIT_OBJECT_NAME_RE, m)} AS ObjectName,
  trim({S.extract(P.QUERY_TEXT_RE, m)}, '"') AS QueryText
FROM bronze WHERE {AUDIT}"""


def conn_parse_sql():
    return with_bronze() + f"""
SELECT {TS}, LogicalServerName, processId, {direct_cols()}
FROM bronze WHERE {S.contains_any('message', (P.CONN_AUTHORIZED, P.CONN_RECEIVED))}"""


def session_info_sql():
    return with_bronze(sess_cte()) + "SELECT * FROM sess"


def session_enrich_sql():
    return with_bronze(sess_cte(), f"""ev AS (SELECT b.*, {direct_cols()} FROM bronze b WHERE {AUDIT})""") + f"""
SELECT {TS}, LogicalServerName, processId, {final_cols()}
FROM ev LEFT JOIN sess s USING (processId, LogicalServerName)"""


def session_asof_sql():
    terms = (P.CONN_AUTHORIZED, P.CONN_RECEIVED)
    return with_bronze(f"""conn AS (
  SELECT * FROM (SELECT processId, LogicalServerName, {TS} AS valid_from,
                        {S.extract(P.USER_RE, 'message')} AS AsOfUser,
                        {S.extract(P.DATABASE_RE, 'message')} AS AsOfDatabase,
                        {S.extract(P.HOST_RE, 'message')} AS AsOfHost
                 FROM bronze WHERE {S.contains_any('message', terms)}) c WHERE AsOfUser <> '')""",
                       f"""ev AS (SELECT {TS}, LogicalServerName, processId FROM bronze WHERE {AUDIT})""") + f"""
SELECT ev.{TS}, ev.LogicalServerName, ev.processId, c.AsOfUser, c.AsOfDatabase, c.AsOfHost
FROM ev ASOF LEFT JOIN conn c
  ON ev.processId = c.processId AND ev.LogicalServerName = c.LogicalServerName AND ev.{TS} >= c.valid_from"""


def quick_all_sql(limit=100):
    parts = [quick_exfil_sql(), quick_destructive_sql(), quick_errors_sql(), quick_privilege_sql()]
    u = "\nUNION ALL BY NAME\n".join(f"({p})" for p in parts)
    return f"SELECT * FROM ({u}) u ORDER BY TimeGenerated DESC, AnomalyType NULLS FIRST, ServerName NULLS FIRST LIMIT {limit}"


def auth_error_diagnostics_sql():
    return with_bronze() + """
SELECT sqlerrcode, upper(errorLevel) AS errorLevel, count(*) AS count_, max(message) AS sample_msg
FROM bronze WHERE starts_with(sqlerrcode, '28') GROUP BY sqlerrcode, upper(errorLevel)"""


def destructive_ops_live_sql():
    """The live detectors have no samples."""
    columns = ["TimeGenerated", "AnomalyType", "Severity", "ServerName", '"User"', '"Database"', "SourceHost", "BackendType",
               "OperationCount", "Operations", "TablesAffected", "TimeWindow"]
    return f"SELECT {', '.join(columns)} FROM ({destructive_ops_sql(enriched=_enriched_live)}) x"


def privilege_escalation_live_sql():
    columns = ["TimeGenerated", "AnomalyType", "Severity", "ServerName", '"User"', "PrivilegeOpsCount", "Operations",
               "LogTypes", "TimeWindow"]
    return f"SELECT {', '.join(columns)} FROM ({privilege_escalation_sql(enriched=_enriched_live)}) x"


def session_enrich_stream_sql():
    ev = f"ev AS (SELECT b.*, {direct_cols()} FROM bronze b WHERE {AUDIT})"
    return with_bronze(*_enriched_live(ev, "")) + f"""
SELECT {TS}, LogicalServerName, processId, FinalUser, FinalDatabase, FinalHost FROM j"""
