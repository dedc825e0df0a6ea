"""The events -> bronze adapter written as DuckDB SQL (a CTE named ``bronze``).

Mirrors ``auditlens.sources.events_adapter.bronze_from_events`` row for row.
"""

from auditlens.plans.sqltext import q
from auditlens.sources.events_adapter import CATALOG_VIEWS, SCHEMAS, TABLES


def _pick(idx: str, values) -> str:
    return "([" + ", ".join(q(v) for v in values) + f"])[({idx}) + 1]"


_CTE = f"""
ev0 AS (
  SELECT event_id AS e, user_id AS u, event_type AS et, value AS val, ts,
         COALESCE(CAST(NULLIF(regexp_extract(props, '"k":\\s*([0-9]+)', 1), '') AS BIGINT), 0) AS k
  FROM events
),
ev1 AS (
  SELECT *,
    CASE WHEN u % 50 = 0 THEN 'azuresu' WHEN u % 50 = 1 THEN 'azure_maintenance'
         ELSE 'u' || CAST(u AS VARCHAR) END AS uname,
    'db' || CAST(u % 3 AS VARCHAR) AS db,
    '10.0.0.' || CAST(u % 16 AS VARCHAR) AS host,
    {_pick('(e + k) % 8', SCHEMAS)} AS sch,
    {_pick('k % 8', TABLES)} AS tbl,
    'AUDIT: SESSION,' || CAST(e AS VARCHAR) || ',1,' AS head
  FROM ev0
),
ev2 AS (
  SELECT *, sch || '.' || tbl AS obj,
    {_pick('e % 3', ('UPDATE', 'DELETE', 'INSERT'))} AS wstmt,
    {_pick('k % 3', ('CREATE TABLE', 'DROP TABLE', 'ALTER TABLE'))} AS ddl,
    {_pick('k % 4', ('GRANT', 'REVOKE', 'CREATE ROLE', 'ALTER ROLE'))} AS role,
    {_pick('e % 6', CATALOG_VIEWS)} AS catalog,
    {_pick('e % 8', ('28P01', '42P01', '42501', '53300', '08006', '28000', '57014', '23505'))} AS code,
    CASE WHEN e % 3 = 0 THEN ' user=' || uname || ' host=' || host
         WHEN e % 3 = 1 THEN ' host=' || host ELSE '' END AS auth_tail
  FROM ev1
),
bronze AS (
  SELECT
    ts AS EventProcessedUtcTime,
    CASE
      WHEN et = 'signup' THEN
        CASE WHEN e % 5 = 0 THEN 'connection received: host=' || host || ' port=' || CAST(e % 100 + 5432 AS VARCHAR)
             ELSE 'connection authorized: user=' || uname || ' database=' || db || ' host=' || host || ' application_name=psql' END
      WHEN et = 'view' THEN
        CASE WHEN k % 5 = 0 THEN head || 'READ,SELECT,,,SELECT * FROM ' || catalog || ',<not logged>'
             ELSE head || 'READ,SELECT,TABLE,' || obj || ',SELECT * FROM ' || obj || ' WHERE id = ' || CAST(k AS VARCHAR) || ',<not logged>' END
      WHEN et = 'click' THEN
        CASE WHEN k % 10 = 0 THEN head || 'DDL,TRUNCATE TABLE,TABLE,' || obj || ',TRUNCATE ' || obj || ',<not logged>'
             ELSE head || 'WRITE,' || wstmt || ',TABLE,' || obj || ',' || wstmt || ' ' || obj || ',<not logged>' END
      WHEN et = 'purchase' THEN
        CASE WHEN e % 4 = 0 THEN head || 'DDL,' || ddl || ',TABLE,' || sch || '.tmp_' || CAST(k AS VARCHAR) || ',' || ddl || ' ' || sch || '.tmp_' || CAST(k AS VARCHAR) || ',<not logged>'
             WHEN e % 4 = 1 THEN head || 'ROLE,' || role || ',,,' || role || ' reader_' || CAST(k AS VARCHAR) || ' ON ' || obj || ',<not logged>'
             WHEN e % 4 = 2 THEN head || 'READ,SELECT,,,SELECT * FROM information_schema.columns WHERE table_name = ' || tbl || ',<not logged>'
             ELSE head || 'MISC,SET,,,SET search_path TO ' || sch || ',<not logged>' END
      WHEN et = 'error' THEN
        CASE WHEN e % 8 = 0 THEN 'password authentication failed for user "' || uname || '"' || auth_tail
             WHEN e % 8 = 1 THEN 'relation "' || obj || '" does not exist'
             WHEN e % 8 = 2 THEN 'permission denied for table ' || tbl
             WHEN e % 8 = 3 THEN 'sorry, too many clients already'
             WHEN e % 8 = 4 THEN 'could not receive data from client: connection reset by peer'
             WHEN e % 8 = 5 THEN 'no pg_hba.conf entry for host "' || host || '", user "' || uname || '", database "' || db || '"'
             WHEN e % 8 = 6 THEN 'canceling statement due to statement timeout'
             ELSE 'duplicate key value violates unique constraint "pk_' || tbl || '"' END
      ELSE '' END AS message,
    CASE WHEN et = 'error' THEN
           CASE WHEN e % 97 = 0 THEN 'PANIC' WHEN e % 8 = 4 OR e % 8 = 5 THEN 'FATAL' ELSE 'ERROR' END
         WHEN et = 'purchase' AND val > 300 THEN 'WARNING'
         ELSE 'LOG' END AS errorLevel,
    CASE WHEN et = 'error' THEN code ELSE '00000' END AS sqlerrcode,
    CAST(u AS BIGINT) AS processId,
    CASE WHEN et = 'error' AND e % 7 = 0 THEN ''
         WHEN et = 'view' AND e % 23 = 0 THEN 'parallel worker'
         ELSE 'client backend' END AS backend_type,
    'srv' || CAST(u % 4 AS VARCHAR) AS LogicalServerName,
    'PostgreSQLLogs' AS category
  FROM ev2
)"""


def with_bronze(*ctes: str) -> str:
    """``WITH <adapter CTEs>, <extra CTEs>`` prefix for an oracle query."""
    extra = "".join(",\n" + c for c in ctes)
    return "WITH " + _CTE.strip() + extra + "\n"
