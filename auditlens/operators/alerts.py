"""Unified anomaly feed (D12) and alert rules.

``anomalies_all`` shows the newest rows of the one-scan feed (``operators/feed.py``).

``alert_rules`` evaluates the alert rule table against long-form
"candidate" rows: each alert query yields (RuleName, ServerName, GroupKey,
WindowStart, MetricValue, TimeGenerated) and a join with the
rule table (its strategy by measured size) applies each
rule's threshold, severity tiers and action. Actions are emitted as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.functions import patterns as P
from auditlens.functions.text import extract, first_non_empty, has_any, is_empty, is_not_empty, severity, trim_chars
from auditlens.functions.timefn import TS, resolve_as_of, since
from auditlens.operators.feed import COMMON, UNION_KINDS, anomalies_union, by_tag, details_text, tag_lines  # noqa: F401
from auditlens.operators.parse import schema_of
from auditlens.sources.bronze import CATEGORY
from auditlens.sources.parsed import stored

SRV = "LogicalServerName"


def anomalies_all(bronze: DataFrame, *, as_of=None, params: dict | None = None, limit: int = 100) -> DataFrame:
    """The main anomaly dashboard: union of the detectors, newest ``limit``; ``Details`` as text."""
    u = anomalies_union(bronze, as_of=as_of, params=params).withColumn("Details", details_text()).select(*COMMON)
    return u.orderBy(F.desc("TimeGenerated"), *[c for c in COMMON if c != "TimeGenerated"]).limit(limit)


def security_kpis(anomalies: DataFrame, bronze: DataFrame, *, as_of=None, lookback="24h",
                  host_error_rate=10.0, auth_threshold=10) -> DataFrame:
    """Security KPIs (long form Kpi, Dimension, Value): anomalies by type and
    severity, distinct users with anomalies, hosts with error rate above 10 %,
    and users with more than ``auth_threshold`` authentication failures."""
    from auditlens.config import shared_dir
    from auditlens.operators.dashboards import pct2

    # Both KPIs read the anomaly rows: write them once (small, thresholded)
    # instead of running every detector twice.
    shared_dir(anomalies.sparkSession)
    if lookback is not None:        # the log's newest event, not the feed's
        as_of = resolve_as_of(bronze, as_of)
    a = since(anomalies, as_of, lookback, ts="TimeGenerated").select(
        "TimeGenerated", "AnomalyType", "Severity", "User").checkpoint(eager=True)
    by_type = a.groupBy(F.concat_ws(" / ", "AnomalyType", "Severity").alias("Dimension")).agg(
        F.count(F.lit(1)).alias("Value")).select(F.lit("anomalies_by_type_severity").alias("Kpi"),
                                                 "Dimension", "Value")
    users = a.where(is_not_empty("User") & (F.col("User") != P.UNKNOWN)).agg(
        F.count_distinct("User").alias("Value")).select(
        F.lit("users_with_anomalies").alias("Kpi"), F.lit("").alias("Dimension"), "Value")
    b = since(bronze, as_of, lookback).withColumn("ClientHost", stored(bronze, "p_host"))
    hosts = (b.where(is_not_empty("ClientHost")).groupBy("ClientHost")
             .agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(F.col("errorLevel").isin(*P.ERROR_LEVELS_NO_PANIC)).alias("e"))
             .where(pct2("e", "n") > host_error_rate)
             .agg(F.count(F.lit(1)).alias("Value"))
             .select(F.lit("hosts_error_rate_over_10pct").alias("Kpi"), F.lit("").alias("Dimension"), "Value"))
    failed = since(bronze, as_of, lookback).where(stored(bronze, "is_auth_failure"))
    failed = (failed.groupBy(stored(bronze, "p_user").alias("u")).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > auth_threshold).agg(F.count(F.lit(1)).alias("Value"))
              .select(F.lit("users_auth_failures_over_10").alias("Kpi"), F.lit("").alias("Dimension"), "Value"))
    return by_type.unionByName(users).unionByName(hosts).unionByName(failed)


# ---------------------------------------------------------------- alert rules
RULE_SCHEMA = T.StructType([
    T.StructField("RuleName", T.StringType()), T.StructField("QuerySource", T.StringType()),
    T.StructField("TriggerField", T.StringType()), T.StructField("Threshold", T.DoubleType()),
    T.StructField("HighAbove", T.DoubleType()), T.StructField("CriticalAbove", T.DoubleType()),
    T.StructField("BaseSeverity", T.StringType()), T.StructField("Action", T.StringType()),
    T.StructField("Frequency", T.StringType()),
])

# The alert rule table (name, source query, trigger field,
# threshold, HIGH above, CRITICAL above, base severity, action, frequency).
RULES = [
    ("Data Exfil", "suspiciousDataAccess", "SelectCount", 15.0, 30.0, 50.0, "MEDIUM", "Email + Teams", "5m"),
    ("Destruction", "destructiveOperations", "OperationCount", 5.0, 10.0, 20.0, "MEDIUM", "URGENT Email", "2m"),
    ("Privilege", "privilegeEscalation", "PrivilegeOpsCount", 1.0, None, None, "HIGH", "High Priority Email", "5m"),
    ("Error Spike", "errorSpike", "ErrorCount", 3.0, 8.0, 15.0, "MEDIUM", "Email", "5m"),
    ("Recon (Schema)", "crossSchemaRecon", "SchemasAccessed", 4.0, None, None, "MEDIUM", "Warning Email", "5m"),
    ("Recon (Deep)", "deepSchemaEnum", "SystemTableQueries", 10.0, None, None, "MEDIUM", "Warning Email", "5m"),
    ("ML Anomaly", "mlAnomalyDetection", "DeviationScore", 3.0, None, None, "CRITICAL", "Review Email", "5m"),
]


def rules_df(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, RULE_SCHEMA)


# Default windows of the alert queries (lookback, bucket).
ALERT_WINDOWS = {
    "Data Exfil": ("5m", None), "Destruction": ("10m", "2m"), "Privilege": ("15m", "5m"),
    "Error Spike": ("15m", "1m"), "Recon (Schema)": ("15m", "10m"), "Recon (Deep)": ("10m", "5m"),
}


def _group_key(keys: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def alert_matches(df: DataFrame) -> list[tuple[str, Column, list[str], str | None]]:
    """Per alert query: (rule, whether a line counts, group keys, column whose distinct values
    are counted or None for a row count)."""
    cat, audit = F.col("category") == CATEGORY, stored(df, "is_audit")
    client = F.col("backend_type") == P.CLIENT_BACKEND
    user = first_non_empty(stored(df, "p_user"), default=P.UNKNOWN)
    statement = trim_chars(" ", stored(df, "p_statement"))
    return [
        ("Data Exfil", cat & audit & stored(df, "t_exfil") & client
         & ((stored(df, "p_class") == "READ") | (stored(df, "p_statement") == "SELECT")) & (user != P.SUPERUSER),
         [SRV, "backend_type", "processId"], None),
        ("Destruction", cat & audit & stored(df, "t_destructive_pre") & stored(df, "t_destructive")
         & ((stored(df, "p_class") == "WRITE") | has_any(statement, P.DESTRUCTIVE_TERMS))
         & ~user.isin(*P.SYSTEM_USERS, P.UNKNOWN) & client, [SRV, "backend_type"], None),
        ("Privilege", cat & stored(df, "t_privilege_alert") & (client | is_empty("backend_type"))
         & ~user.isin(*P.SYSTEM_USERS), [SRV], None),
        ("Error Spike", cat & stored(df, "is_err"), [SRV, "backend_type"], None),
        ("Recon (Schema)", cat & audit & client & (user != P.SUPERUSER)
         & ~alert_schema(df).isin(*P.CATALOG_SCHEMAS, ""), [SRV, "processId"], "SchemaName"),
        ("Recon (Deep)", cat & audit & client & stored(df, "t_catalog") & (user != P.SUPERUSER),
         [SRV, "processId"], None),
    ]


def alert_schema(df: DataFrame) -> Column:
    """The alert rule's schema: the reference's literal capture, else the prefix of the object type."""
    literal = extract(P.AUDIT_SCHEMA_RE, "message")
    return F.when(is_not_empty(literal), literal).otherwise(schema_of(stored(df, "p_object_type")))


def _alert_windows(bronze: DataFrame, as_of, windows: dict | None):
    w = ALERT_WINDOWS | (windows or {})
    if any(lb is not None for lb, _ in w.values()):
        as_of = resolve_as_of(bronze, as_of)
    return w, as_of


def alert_inputs(bronze: DataFrame, *, as_of=None, windows: dict | None = None, wrap=None):
    """Per alert query: (rule, filtered rows, group keys, bucket, distinct), for streams, which
    pass ``wrap=above_watermark`` so that the filters stay above the watermark."""
    w, as_of = _alert_windows(bronze, as_of, windows)
    out = []
    for rule, cond, keys, distinct in alert_matches(bronze):
        df = since(bronze, as_of, w[rule][0]).where(wrap(cond) if wrap else cond)
        if distinct:
            df = df.withColumn(distinct, alert_schema(bronze))
        out.append((rule, df, keys, w[rule][1], distinct))
    return out


def alert_candidates(bronze: DataFrame, *, as_of=None, windows: dict | None = None) -> DataFrame:
    """The six log-based alert queries as long-form metric rows (no threshold).

    One scan and one aggregation: every line is tagged with the rules it counts for, and the
    tagged lines are grouped by rule, key and window.
    """
    w, as_of = _alert_windows(bronze, as_of, windows)
    matches = {rule: (cond, keys, distinct) for rule, cond, keys, distinct in alert_matches(bronze)}
    df = tag_lines(bronze, {r: m[0] for r, m in matches.items()}, as_of, w, "RuleName",
                   ("is_audit", "is_err", "t_privilege_alert"))
    df = df.withColumns({
        "GroupKey": by_tag("RuleName", {r: _group_key(m[1]) for r, m in matches.items()}),
        "distinct": by_tag("RuleName", {r: alert_schema(bronze) for r, m in matches.items() if m[2]})})
    agg = df.groupBy("RuleName", F.col(SRV).alias("ServerName"), "GroupKey", F.col("Bucket").alias("WindowStart")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("distinct").alias("d"), F.max(TS).alias("TimeGenerated"))
    counts_values = F.col("RuleName").isin(*[r for r, m in matches.items() if m[2]])
    return agg.select("RuleName", "ServerName", "GroupKey", "WindowStart",
                      F.when(counts_values, F.col("d")).otherwise(F.col("n")).cast("double").alias("MetricValue"),
                      "TimeGenerated")


def ml_candidates(series_anomalies: DataFrame) -> DataFrame:
    """Baseline-deviation rows as alert candidates (metric = |score|)."""
    return series_anomalies.select(
        F.lit("ML Anomaly").alias("RuleName"), "ServerName", F.col("ServerName").alias("GroupKey"),
        F.col("TimeGenerated").alias("WindowStart"),
        F.abs(F.col("DeviationScore")).cast("double").alias("MetricValue"),
        "TimeGenerated")


def alert_rules(candidates: DataFrame, rules: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Apply the rule table: fire where MetricValue > Threshold; grade by the
    rule's HIGH/CRITICAL tiers; attach the action. Candidates' columns in ``keep`` stay. The rule table is the
    caller's, so its join is left to the measured size."""
    j = candidates.join(rules, "RuleName")
    j = j.where(F.col("MetricValue") > F.col("Threshold"))
    sev = (F.when(F.col("CriticalAbove").isNotNull() & (F.col("MetricValue") > F.col("CriticalAbove")), "CRITICAL")
           .when(F.col("HighAbove").isNotNull() & (F.col("MetricValue") > F.col("HighAbove")), "HIGH")
           .otherwise(F.col("BaseSeverity")))
    return j.select("RuleName", "QuerySource", "TriggerField", "Threshold", "ServerName", "GroupKey",
                    "WindowStart", "MetricValue", sev.alias("Severity"), "Action", "Frequency", "TimeGenerated",
                    *keep)


# --------------------------------------------------- alerts with conditions
# Alerts on anomaly rows (name, source query, anomaly type,
# conditions that must all hold, action, frequency).
FEED_ALERTS = [
    ("Data Exfiltration", "suspiciousDataAccess", "Potential Data Exfiltration",
     (("Severity", "in", ("CRITICAL",)),), "Email + Teams", "5m"),
    ("Destructive Operations", "destructiveOperations", "Mass Destructive Operations",
     (("Severity", "in", ("CRITICAL", "HIGH")),), "Email + Teams + SMS", "2m"),
    ("Privilege Escalation", "privilegeEscalation", "Privilege Escalation",
     (("Severity", "in", ("CRITICAL", "HIGH")),), "Email + Teams + Incident in Sentinel", "5m"),
    ("ML Anomaly Detection", "mlAnomalyDetection", "ML Baseline Deviation",
     (("Severity", "in", ("CRITICAL",)), ("Score", ">", 3.0)), "Email + Teams", "5m"),
]

_TESTS = {"in": lambda c, v: c.isin(*v), "==": lambda c, v: c == v, ">": lambda c, v: c > v,
          ">=": lambda c, v: c >= v, "<": lambda c, v: c < v, "<=": lambda c, v: c <= v}


def rule_condition(anomaly_type: str | None, conditions) -> Column:
    """One rule as a Column: the anomaly type (None: any) and every (field, test, value)."""
    out = F.lit(True) if anomaly_type is None else F.col("AnomalyType") == anomaly_type
    for field, test, value in conditions:
        if test not in _TESTS:
            raise ValueError(f"a condition tests with one of {sorted(_TESTS)}, not {test!r}")
        out = out & _TESTS[test](F.col(field), value)
    return out


def scored_rows(feed: DataFrame, ml: DataFrame | None = None, *, high=2.0, critical=3.0) -> DataFrame:
    """Anomaly rows that rules test: (TimeGenerated, AnomalyType, Severity, ServerName, User, Score).

    ``ml``: baseline deviations (``series.series_anomalies``); their score is |DeviationScore|.
    """
    cols = ["TimeGenerated", "AnomalyType", "Severity", "ServerName", "User"]
    out = feed.select(*cols, F.col("MetricValue").cast("double").alias("Score"))
    if ml is None:
        return out
    return out.unionByName(ml.select(
        "TimeGenerated", F.lit("ML Baseline Deviation").alias("AnomalyType"),
        severity(F.abs("score"), high, critical).alias("Severity"), "ServerName",
        F.lit(None).cast("string").alias("User"), F.abs("DeviationScore").alias("Score")))


def condition_alerts(rows: DataFrame, alerts=FEED_ALERTS) -> DataFrame:
    """One row per anomaly row and alert whose conditions it fulfils, with the alert's action.

    All alerts are tested in one pass, as an array of the alerts that fire on a row; nothing is joined.
    """
    def fired(name, source, kind, conditions, action, frequency):
        return F.when(rule_condition(kind, conditions), F.struct(
            F.lit(name).alias("AlertName"), F.lit(source).alias("QuerySource"), F.lit(action).alias("Action"),
            F.lit(frequency).alias("Frequency")))
    out = rows.withColumn("fired", F.explode(F.array(*[fired(*a) for a in alerts])))
    return out.where(F.col("fired").isNotNull()).select("fired.*", *rows.columns)
