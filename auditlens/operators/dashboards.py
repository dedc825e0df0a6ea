"""Dashboard tiles and health queries (Q1-Q25).

Each tile is a DataFrame function with the reference's lookback and bin
as defaults. Top-k tiles sort by the reference's key and then by the
group keys, so ties are broken the same way every run; Spark plans
``orderBy().limit()`` as a per-partition top-k (TakeOrderedAndProject),
never a full sort.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from auditlens.functions import patterns as P
from auditlens.functions.text import is_not_empty, label_case, severity, trim_chars
from auditlens.functions.timefn import TS, bin_ts, day_boundaries, minute_boundaries, resolve_as_of, since
from auditlens.operators.sets import aggregate_with_sets, join_set
from auditlens.sources.parsed import flag, stored

SRV = "LogicalServerName"


def _err() -> Column:
    return F.col("errorLevel").isin(*P.ERROR_LEVELS)


def _err2() -> Column:
    return F.col("errorLevel").isin(*P.ERROR_LEVELS_NO_PANIC)


def pct2(num: str, den: str) -> Column:
    """round(num * 100 / den, 2) with exact half-up rounding (integer
    arithmetic, so every engine gets the same value)."""
    return (F.expr(f"({num} * 20000 + {den}) div (2 * {den})") / F.lit(100.0))


def _nonempty_or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


# Q1
def activity_by_server(bronze, *, as_of=None, lookback="1h", bucket="2m"):
    df = since(bronze, as_of, lookback).where(is_not_empty(SRV) & (F.trim(F.col(SRV)) != ""))
    return df.groupBy(SRV, bin_ts(TS, bucket).alias(TS)).agg(
        F.count(F.lit(1)).alias("TotalEvents"), F.count_if(_err()).alias("Errors"),
        F.count_if(F.col("errorLevel") == "WARNING").alias("Warnings"),
        F.count_if(stored(bronze, "is_audit")).alias("AuditLogs"))


# Q2
def audit_distribution(bronze, *, as_of=None, lookback="6h", top=10):
    df = since(bronze, as_of, lookback).where(stored(bronze, "is_audit"))
    df = df.withColumn("AuditStatement", stored(bronze, "p_statement")).where(is_not_empty("AuditStatement"))
    return (df.groupBy("AuditStatement").agg(F.count(F.lit(1)).alias("Count"))
            .orderBy(F.desc("Count"), "AuditStatement").limit(top))


# Q3
def top_tables(bronze, *, as_of=None, lookback="6h", top=15):
    df = since(bronze, as_of, lookback).where(stored(bronze, "is_audit"))
    df = df.withColumns({"ObjectType": stored(bronze, "p_object_type"),
                         "ObjectName": stored(bronze, "p_object")})
    df = df.where(is_not_empty("ObjectName"))
    keys = ["ObjectName", SRV]
    agg = aggregate_with_sets(df, keys, [("AccessCount", "count", None), ("LastAccess", "max", TS)],
                              [("ObjectTypes", "ObjectType", 5)])
    agg = agg.orderBy(F.desc("AccessCount"), "ObjectName", SRV).limit(top)
    return agg.select("ObjectName", join_set("ObjectTypes", ", ").alias("ObjectTypesDisplay"),
                      SRV, "AccessCount", "LastAccess")


# Q4
def audit_timeline(bronze, *, as_of=None, lookback="1h", bucket="2m", include_misc=True):
    table = P.AUDIT_OPERATION_TYPES if include_misc else tuple(
        r for r in P.AUDIT_OPERATION_TYPES if r[2] != "MISC")
    df = since(bronze, as_of, lookback).where(stored(bronze, "is_audit"))
    df = df.withColumn("OperationType", label_case(table, P.AUDIT_OPERATION_DEFAULT))
    return df.groupBy("OperationType", bin_ts(TS, bucket).alias(TS)).agg(F.count(F.lit(1)).alias("Count"))


# Q5
def errors_by_category(bronze, *, as_of=None, lookback="24h", bucket="30m"):
    df = since(bronze, as_of, lookback).where(flag(bronze, "is_err") & _err())
    df = df.withColumn("ErrorCategory", label_case(P.ERROR_DASHBOARD_CATEGORIES, P.ERROR_DASHBOARD_DEFAULT))
    return df.groupBy("ErrorCategory", bin_ts(TS, bucket).alias(TS)).agg(F.count(F.lit(1)).alias("Count"))


# Q6
def activity_by_backend(bronze, *, as_of=None, lookback="1h", bucket="5m"):
    df = since(bronze, as_of, lookback).where(stored(bronze, "is_audit"))
    return df.groupBy("backend_type", bin_ts(TS, bucket).alias(TS)).agg(
        F.count(F.lit(1)).alias("TotalLogs"), F.count_if(_err2()).alias("Errors"))


# Q7
def top_users(bronze, *, as_of=None, lookback="24h", top=10):
    df = since(bronze, as_of, lookback).withColumn("UserName", trim_chars('"', stored(bronze, "p_user")))
    df = df.where(is_not_empty("UserName"))
    db = _nonempty_or_null(trim_chars('"', stored(bronze, "p_database")))
    agg = df.groupBy("UserName").agg(
        F.count(F.lit(1)).alias("TotalActivity"),
        F.count_if(stored(bronze, "is_audit")).alias("AuditLogs"),
        F.count_if(stored(bronze, "is_conn_auth")).alias("Connections"),
        F.count_if(_err2()).alias("Errors"), F.count_distinct(db).alias("Databases"),
        F.max(TS).alias("LastActivity"))
    return agg.orderBy(F.desc("TotalActivity"), "UserName").limit(top).select(
        "UserName", "TotalActivity", "AuditLogs", "Connections", "Errors", "Databases", "LastActivity")


# Q8
def top_hosts(bronze, *, as_of=None, lookback="24h", top=10, high=20, medium=5):
    df = since(bronze, as_of, lookback).withColumns({"ClientHost": stored(bronze, "p_host"),
                                                     "UserName": stored(bronze, "p_user")})
    df = df.where(is_not_empty("ClientHost"))
    agg = aggregate_with_sets(df, ["ClientHost"], [
        ("TotalConnections", "count", None), ("UniqueUsers", "dcount", "UserName"),
        ("Errors", "count_if", _err2()), ("FirstSeen", "min", TS), ("LastSeen", "max", TS)],
        [("Users", "UserName", 10)])
    agg = agg.orderBy(F.desc("TotalConnections"), "ClientHost").limit(top)
    rate = pct2("Errors", "TotalConnections")
    return agg.select("ClientHost", "TotalConnections", "UniqueUsers",
                      join_set("Users", ", ").alias("UsersDisplay"), "Errors", rate.alias("ErrorRate"),
                      F.when(rate > high, "HIGH").when(rate > medium, "MEDIUM").otherwise("LOW").alias("Risk"),
                      "FirstSeen", "LastSeen")


# Q9
def user_db_heatmap(bronze, *, as_of=None, lookback="24h", min_activity=10, top=50):
    df = since(bronze, as_of, lookback).where(stored(bronze, "is_audit") | stored(bronze, "is_conn_auth"))
    df = df.withColumns({"UserName": stored(bronze, "p_user"),
                         "DatabaseName": stored(bronze, "p_database")})
    df = df.where(is_not_empty("UserName") & is_not_empty("DatabaseName"))
    agg = df.groupBy("UserName", "DatabaseName").agg(
        F.count(F.lit(1)).alias("ActivityCount"),
        F.count_if(stored(bronze, "is_audit")).alias("AuditLogs"), F.max(TS).alias("LastActivity"))
    return (agg.where(F.col("ActivityCount") > min_activity)
            .orderBy(F.desc("ActivityCount"), "UserName", "DatabaseName").limit(top)
            .select("UserName", "DatabaseName", "ActivityCount", "AuditLogs", "LastActivity"))


# Q10
def auth_failures(bronze, *, as_of=None, lookback="24h", top=20, databases=100):
    """``Databases`` holds the ``databases`` smallest names: whoever fails to log in chooses them freely."""
    df = since(bronze, as_of, lookback).where(stored(bronze, "is_auth_failure"))
    df = df.withColumns({"UserName": stored(bronze, "p_user"),
                         "ClientHost": stored(bronze, "p_host"),
                         "DatabaseName": stored(bronze, "p_database")})
    agg = aggregate_with_sets(df, ["UserName", "ClientHost"], [
        ("FailedAttempts", "count", None), ("FirstAttempt", "min", TS), ("LastAttempt", "max", TS)],
        [("Databases", "DatabaseName", databases)])
    return (agg.withColumn("ThreatLevel", severity("FailedAttempts", 10, 20, low=5))
            .orderBy(F.desc("FailedAttempts"), "UserName", "ClientHost").limit(top)
            .select("UserName", "ClientHost", "FailedAttempts", "ThreatLevel", "Databases",
                    "FirstAttempt", "LastAttempt"))


# Q11
def top_error_codes(bronze, *, as_of=None, lookback="24h", top=15):
    df = since(bronze, as_of, lookback).where(flag(bronze, "is_err") & (F.col("sqlerrcode") != P.OK_CODE)
                                              & (F.col("sqlerrcode") != ""))
    agg = df.groupBy("sqlerrcode", "errorLevel").agg(F.count(F.lit(1)).alias("Count"),
                                                     F.max(TS).alias("LastOccurrence"))
    agg = agg.orderBy(F.desc("Count"), "sqlerrcode", "errorLevel").limit(top)
    return agg.select("sqlerrcode",
                      label_case(P.ERROR_CODE_CLASSES, P.ERROR_CODE_DEFAULT).alias("ErrorDescription"),
                      "errorLevel", "Count", "LastOccurrence")


# Q12
def metrics_latest(metrics, *, top=20):
    return metrics.orderBy(F.desc("Timestamp"), "ServerName").limit(top)


# Q13
def metrics_stats(metrics, *, as_of=None, lookback="24h"):
    df = since(metrics, as_of, lookback, ts="Timestamp")
    return df.groupBy("ServerName").agg(
        F.count(F.lit(1)).alias("Records"), F.avg("ActivityCount").alias("AvgActivity"),
        F.max("ActivityCount").alias("MaxActivity"), F.avg("Errors").alias("AvgErrors"),
        F.avg("UniqueUsers").alias("AvgUniqueUsers"))


# Q14
def data_freshness(bronze, *, as_of=None, fresh_minutes=5):
    """``as_of=None``: now = newest event (replay), so latency is 0."""
    agg = bronze.agg(F.max(TS).alias("LastEvent"), F.min(TS).alias("FirstEvent"),
                     F.count(F.lit(1)).alias("TotalEvents"))
    now = F.col("LastEvent") if as_of is None else F.lit(resolve_as_of(bronze, as_of))
    lat = minute_boundaries(now, "LastEvent")
    return agg.select("LastEvent", "FirstEvent", "TotalEvents",
                      day_boundaries("LastEvent", "FirstEvent").alias("TimeRange"),
                      F.when(lat < fresh_minutes, "Fresh data").otherwise("Stale data").alias("Status"),
                      lat.alias("LatencyMinutes"))


# Q15
def audit_coverage(bronze, *, as_of=None, lookback="1h"):
    df = since(bronze, as_of, lookback)
    agg = df.groupBy(SRV).agg(
        F.count(F.lit(1)).alias("TotalLogs"),
        F.count_if(stored(bronze, "is_audit")).alias("AuditLogs"),
        F.count_if(_err()).alias("ErrorLogs"), F.count_if(F.col("errorLevel") == "WARNING").alias("WarningLogs"))
    return agg.withColumns({"AuditCoverage": pct2("AuditLogs", "TotalLogs"),
                            "ErrorRate": pct2("ErrorLogs", "TotalLogs")})


# Q16
def backend_distribution(bronze, *, as_of=None, lookback="24h"):
    return (since(bronze, as_of, lookback).groupBy("backend_type").agg(F.count(F.lit(1)).alias("Count"))
            .orderBy(F.desc("Count"), "backend_type"))


# Q17
def metrics_status(metrics, *, as_of=None, healthy_minutes=10):
    agg = metrics.groupBy("ServerName").agg(
        F.max("Timestamp").alias("LastUpdate"), F.count(F.lit(1)).alias("TotalRecords"),
        F.avg("ActivityCount").alias("AvgActivity"), F.max("Errors").alias("MaxErrors"))
    now = F.lit(resolve_as_of(metrics, as_of, "Timestamp")) if as_of is not None else metrics.select(
        F.max("Timestamp")).scalar()
    delay = minute_boundaries(now, "LastUpdate")
    return agg.select("ServerName",
                      F.when(delay < healthy_minutes, "Healthy").otherwise("Delayed").alias("Status"),
                      delay.alias("DelayMinutes"), "LastUpdate", "TotalRecords", "AvgActivity", "MaxErrors")


# Q18
def error_code_diagnostics(bronze, *, as_of=None, lookback="24h", auth_only=False):
    df = since(bronze, as_of, lookback).where(flag(bronze, "is_err"))
    if auth_only:
        df = df.where(F.col("sqlerrcode").startswith("28"))
        lvl = F.upper("errorLevel")
    else:
        df = df.where((F.col("sqlerrcode") != P.OK_CODE) & (F.col("sqlerrcode") != ""))
        lvl = F.col("errorLevel")
    return (df.groupBy("sqlerrcode", lvl.alias("errorLevel"))
            .agg(F.count(F.lit(1)).alias("count_"), F.max("message").alias("sample_msg"))
            .orderBy(F.desc("count_"), "sqlerrcode", "errorLevel"))


# Q19
def privilege_ops_by_user(bronze, *, as_of=None, lookback="24h"):
    df = since(bronze, as_of, lookback).where(stored(bronze, "t_privilege_activity"))
    df = df.withColumn("UserName", stored(bronze, "p_user"))
    return (df.groupBy("UserName", SRV).agg(F.count(F.lit(1)).alias("Operations"))
            .where(F.col("Operations") > 0))


# Q20
def errors_per_minute(bronze, *, as_of=None, lookback="10m", bucket="1m", threshold=15):
    df = since(bronze, as_of, lookback).where(flag(bronze, "is_err") & _err())
    return (df.groupBy(bin_ts(TS, bucket).alias(TS)).agg(F.count(F.lit(1)).alias("ErrorCount"))
            .where(F.col("ErrorCount") > threshold))


# Q21
def history_depth(metrics, *, as_of=None, lookback="7d"):
    return since(metrics, as_of, lookback, ts="Timestamp").groupBy("ServerName").agg(
        F.count(F.lit(1)).alias("count_"))


# Q22
def connection_sample(bronze, *, as_of=None, lookback="1h", n=10):
    """``take 10`` of connection rows; the newest ten, so the sample is stable."""
    from auditlens.sources.bronze import BRONZE_COLS
    df = since(bronze, as_of, lookback).where(flag(bronze, "is_conn") & stored(bronze, "is_conn_auth"))
    return df.orderBy(F.desc(TS), SRV, "processId", "message").limit(n).select(*BRONZE_COLS)


# Q24
def hourly_profile(metrics):
    """Activity by hour of day and weekday: the seasonal baseline, with
    per-hour, per-weekday and overall subtotals (cube)."""
    return metrics.cube("HourOfDay", "DayOfWeek").agg(
        F.count(F.lit(1)).alias("Buckets"), F.avg("ActivityCount").alias("AvgActivity"),
        F.avg("Errors").alias("AvgErrors"), F.avg("UniqueUsers").alias("AvgUniqueUsers"),
        F.max("ActivityCount").alias("MaxActivity"))


# Q25
def active_users_today(bronze, *, as_of=None):
    """Users connected since the start of ``as_of``'s day (default: the
    newest event's day)."""
    day = resolve_as_of(bronze, as_of)
    day = day.replace(hour=0, minute=0, second=0, microsecond=0) if isinstance(day, dt.datetime) else day
    df = since(bronze, day, 0) if isinstance(day, dt.datetime) else bronze.where(
        F.col(TS) >= F.date_trunc("day", F.lit(day)).cast(bronze.schema[TS].dataType))
    df = df.where(flag(bronze, "is_conn") & stored(bronze, "is_conn_auth"))
    df = df.withColumns({"UserName": stored(bronze, "p_user"),
                         "DatabaseName": stored(bronze, "p_database")}).where(is_not_empty("UserName"))
    return df.groupBy("UserName").agg(
        F.count(F.lit(1)).alias("Connections"), F.count_distinct(_nonempty_or_null(F.col("DatabaseName"))).alias("Databases"),
        F.min(TS).alias("FirstConnection"), F.max(TS).alias("LastConnection"))


def current_activity(bronze, *, as_of=None, lookback="1h"):
    """What is happening now: per-server totals over the last hour."""
    df = since(bronze, as_of, lookback)
    return df.groupBy(SRV).agg(
        F.count(F.lit(1)).alias("TotalEvents"),
        F.count_if(stored(bronze, "is_audit")).alias("AuditLogs"),
        F.count_if(stored(bronze, "is_conn_auth")).alias("Connections"),
        F.count_if(_err()).alias("Errors"),
        F.count_distinct(_nonempty_or_null(stored(bronze, "p_user"))).alias("Users"),
        F.max(TS).alias("LastEvent"))
