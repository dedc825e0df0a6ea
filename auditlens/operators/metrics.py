"""Metric tables (I6-I9, I11): windowed aggregates of the raw log.

The same functions feed the batch backfill and the streaming maintenance
(``auditlens.streaming.metric_stream``); ``distinct="approx"`` switches
exact distinct counts to HyperLogLog, which streaming needs.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.config import path_exists, shared_dir
from auditlens.functions import patterns as P
from auditlens.functions.text import is_not_empty, label_case
from auditlens.functions.timefn import TS, bin_ts, since
from auditlens.operators.sessions import join_sessions, session_info
from auditlens.operators.sets import join_set, small_set
from auditlens.sources.bronze import CATEGORY
from auditlens.sources.parsed import flag, stored

ACTIVITY_COLS = ["Timestamp", "ServerName", "HourOfDay", "DayOfWeek", "ActivityCount", "AuditLogs",
                 "Errors", "Connections", "UniqueUsers", "SelectOps", "WriteOps", "DDLOps", "PrivilegeOps"]
ERROR_COLS = ["Timestamp", "ServerName", "ErrorRate", "ErrorTypes"]
USER_COLS = ["Timestamp", "UserName", "ServerName", "QueryCount", "SelectQueries", "DestructiveOps"]


def _dcount(c, distinct: str):
    return F.approx_count_distinct(c) if distinct == "approx" else F.count_distinct(c)


def activity_aggs(distinct: str = "exact", users: bool = True, log: DataFrame | None = None):
    out = [
        F.count(F.lit(1)).alias("ActivityCount"),
        F.count_if(stored(log, "is_audit")).alias("AuditLogs"),
        F.count_if(F.col("errorLevel").isin(*P.ERROR_LEVELS)).alias("Errors"),
        F.count_if(stored(log, "is_conn_auth")).alias("Connections"),
        F.count_if(stored(log, "t_activity_select")).alias("SelectOps"),
        F.count_if(stored(log, "t_activity_write")).alias("WriteOps"),
        F.count_if(stored(log, "t_activity_ddl")).alias("DDLOps"),
        F.count_if(stored(log, "t_privilege_activity")).alias("PrivilegeOps"),
    ]
    if users:
        out.insert(4, _dcount(F.nullif(stored(log, "p_user"), F.lit("")), distinct).alias("UniqueUsers"))
    return out


def activity_metrics(bronze: DataFrame, *, as_of=None, lookback=None, bucket="5m",
                     distinct: str = "exact") -> DataFrame:
    """5-minute per-server activity (postgres_activity_metrics).

    ``UniqueUsers`` counts non-empty ``user=`` values [decision: the empty
    extraction of non-connection rows is not a user].
    """
    df = since(bronze, as_of, lookback).where(F.col("category") == CATEGORY)
    agg = df.groupBy(F.col("LogicalServerName").alias("ServerName"),
                     bin_ts(TS, bucket).alias("Timestamp"),
                     F.hour(TS).cast("int").alias("HourOfDay"),
                     (F.dayofweek(TS) - 1).cast("int").alias("DayOfWeek")).agg(*activity_aggs(distinct, log=df))
    return agg.select(*ACTIVITY_COLS)


def activity_sketches(bronze: DataFrame, *, as_of=None, lookback=None, bucket="5m", lg_k: int = 14) -> DataFrame:
    """Activity per server and bucket that adds up: counts, and HyperLogLog sketches of the users
    and client hosts named, so that any longer span is made from these rows (``roll_up``).

    A sketch of 2**lg_k registers takes 2**lg_k bytes at most, and a few while it holds few values; its relative
    error is about 0.83 / sqrt(2**lg_k), 0.65 % at 14. The exact ``UniqueUsers`` of ``activity_metrics`` stays.
    """
    df = since(bronze, as_of, lookback).where(F.col("category") == CATEGORY)

    def sketch(name):
        return F.hll_sketch_agg(F.nullif(stored(df, name), F.lit("")), lg_k)
    return df.groupBy(F.col("LogicalServerName").alias("ServerName"), bin_ts(TS, bucket).alias("Timestamp")).agg(
        F.count(F.lit(1)).alias("ActivityCount"), F.count_if(stored(df, "is_audit")).alias("AuditLogs"),
        F.count_if(F.col("errorLevel").isin(*P.ERROR_LEVELS)).alias("Errors"),
        sketch("p_user").alias("UserSketch"), sketch("p_host").alias("HostSketch"))


def roll_up(sketches: DataFrame, bucket="1h", by=("ServerName",)) -> DataFrame:
    """Totals of a longer span from ``activity_sketches`` rows, never from the log; ``by`` may be
    empty (all servers). Distinct users and hosts come from the union of the sketches."""
    agg = sketches.groupBy(*by, bin_ts("Timestamp", bucket).alias("Timestamp")).agg(
        *[F.sum(c).alias(c) for c in ("ActivityCount", "AuditLogs", "Errors")],
        F.hll_union_agg("UserSketch").alias("u"), F.hll_union_agg("HostSketch").alias("h"))
    return agg.select(*by, "Timestamp", "ActivityCount", "AuditLogs", "Errors",
                      F.hll_sketch_estimate("u").alias("UniqueUsers"), F.hll_sketch_estimate("h").alias("UniqueHosts"))


def error_aggs():
    return [F.count(F.lit(1)).alias("ErrorRate"),
            join_set(small_set("ErrorCategory"), ", ").alias("ErrorTypes")]


def error_rows(bronze: DataFrame, wrap=None) -> DataFrame:
    code = F.col("sqlerrcode")
    cond = (flag(bronze, "is_err") & (F.col("category") == CATEGORY)
            & (F.col("errorLevel").isin(*P.ERROR_LEVELS) | ((code != P.OK_CODE) & (code != ""))))
    df = bronze.where(wrap(cond) if wrap else cond)
    return df.withColumn("ErrorCategory", label_case(P.ERROR_METRIC_CATEGORIES, P.ERROR_METRIC_DEFAULT))


def error_metrics(bronze: DataFrame, *, as_of=None, lookback=None, bucket="1m") -> DataFrame:
    """1-minute error count and categories per server (postgres_error_metrics)."""
    df = error_rows(since(bronze, as_of, lookback))
    agg = df.groupBy(F.col("LogicalServerName").alias("ServerName"),
                     bin_ts(TS, bucket).alias("Timestamp")).agg(*error_aggs())
    return agg.select(*ERROR_COLS)


def user_aggs(log: DataFrame | None = None):
    return [F.count(F.lit(1)).alias("QueryCount"),
            F.count_if(stored(log, "t_select")).alias("SelectQueries"),
            F.count_if(stored(log, "t_destructive")).alias("DestructiveOps")]


def user_metrics(bronze: DataFrame, *, as_of=None, lookback=None, session_lookback="24h",
                 bucket="1h", sessions: DataFrame | None = None) -> DataFrame:
    """Hourly per-user AUDIT counts for sessions with a known user
    (postgres_user_metrics). The reference's left join followed by a
    non-empty test is an inner join."""
    if sessions is None:
        sessions = session_info(bronze, as_of, session_lookback, fields=("User",))
    df = since(bronze, as_of, lookback).where(stored(bronze, "is_audit") & (F.col("category") == CATEGORY))
    df = join_sessions(df, sessions.where(is_not_empty("User")), "inner")
    agg = df.groupBy(F.col("User").alias("UserName"), F.col("LogicalServerName").alias("ServerName"),
                     bin_ts(TS, bucket).alias("Timestamp")).agg(*user_aggs(df))
    return agg.select(*USER_COLS)


def _read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stored table; one without any file yet has the columns given."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.read.schema(schema).parquet(path)


def set_or_append(spark: SparkSession, df: DataFrame, path: str, keys, date_from: str = "Timestamp") -> DataFrame:
    """``.set-or-append``: create the table, or bring it up to date.

    The table is partitioned by ``metric_date`` (UTC date of ``date_from``), so
    lookback filters prune partitions. Rows of ``df`` replace stored rows of
    the same keys, so a bucket that was half full when it was first written
    is corrected; only the dates that ``df`` touches are read and rewritten,
    and re-running a backfill changes nothing. An empty ``df`` leaves, or makes, a
    table of its columns. Returns the table as stored.
    """
    df = df.withColumn("metric_date", F.to_date(date_from))
    if path_exists(spark, path):
        staged = shared_dir(spark, "set-or-append")
        df.write.partitionBy("metric_date").parquet(staged)
        new = spark.read.schema(df.schema).parquet(staged)
        old = _read_table(spark, path, df.schema).join(new.select("metric_date").distinct(), "metric_date", "left_semi")
        kept = old.join(new.select(*keys), list(keys), "left_anti")
        merged = shared_dir(spark, "set-or-append")
        new.unionByName(kept.select(*new.columns)).write.partitionBy("metric_date").parquet(merged)
        df = spark.read.schema(df.schema).parquet(merged)
    (df.repartitionByRange("metric_date", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("metric_date").parquet(path))
    return _read_table(spark, path, df.schema)


def activity_backfill(spark: SparkSession, bronze: DataFrame, path: str, *, as_of=None, lookback="30d",
                      bucket="5m") -> DataFrame:
    """Initial history load of the activity table (same transform as I6), from
    the start of a whole bucket on."""
    rows = activity_metrics(since(bronze, as_of, lookback, align=bucket), bucket=bucket)
    return set_or_append(spark, rows, path, ["ServerName", "Timestamp", "HourOfDay", "DayOfWeek"])


def sketch_backfill(spark: SparkSession, bronze: DataFrame, path: str, *, as_of=None, lookback="30d",
                    bucket="5m") -> DataFrame:
    """Initial history load of the sketch table."""
    rows = activity_sketches(since(bronze, as_of, lookback, align=bucket), bucket=bucket)
    return set_or_append(spark, rows, path, ["ServerName", "Timestamp"])


def error_backfill(spark: SparkSession, bronze: DataFrame, path: str, *, as_of=None, lookback="30d",
                   bucket="1m") -> DataFrame:
    """Initial history load of the error table (same transform as I8)."""
    rows = error_metrics(since(bronze, as_of, lookback, align=bucket), bucket=bucket)
    return set_or_append(spark, rows, path, ["ServerName", "Timestamp"])


def user_backfill(spark: SparkSession, bronze: DataFrame, path: str, *, as_of=None, lookback="7d",
                  bucket="1h") -> DataFrame:
    """Initial history load of the user table (same transform as I9)."""
    log = since(bronze, as_of, lookback, align=bucket)
    rows = user_metrics(log, session_lookback=None, bucket=bucket)
    return set_or_append(spark, rows, path, ["UserName", "ServerName", "Timestamp"])
