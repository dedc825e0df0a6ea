"""The unified anomaly feed (D12) in one scan of the log.

A line can count for several detectors. ``tag_lines`` reads the log once, with the detectors'
own predicates (``detectors.*_match``), and gives one row per line and detector it counts
for. The tagged lines meet the sessions once, and one aggregation computes all detectors'
metrics and bounded sets, grouped by (detector, its keys, window). Thresholds, severities and
texts are then columns chosen by detector. Rows are those of the single detectors.

Sessions come from one more scan, which reads connection lines only.

Common schema: (TimeGenerated, AnomalyType, Severity, ServerName, User, Database, SourceHost,
MetricName, MetricValue, TimeWindow, Details); ``Details`` is a map from text to text that
holds what only some detectors have, lists joined by ", ".
"""

from __future__ import annotations

import datetime as dt
import inspect
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions import patterns as P
from auditlens.functions.text import first_non_empty, is_not_empty, label_case, severity, trim_chars
from auditlens.functions.timefn import TS, bin_ts, hms, iso_datetime_text, resolve_as_of, seconds, since, within
from auditlens.operators import detectors as D
from auditlens.operators.parse import query_text, schema_of
from auditlens.operators.session_table import feed_sessions_at
from auditlens.operators.sessions import CONN_TERMS_AUTHORIZED, KEYS, connection_lines, join_sessions
from auditlens.operators.sets import aggregate_with_sets, join_set
from auditlens.sources.parsed import stored

SRV = "LogicalServerName"
COMMON = ["TimeGenerated", "AnomalyType", "Severity", "ServerName", "User", "Database", "SourceHost",
          "MetricName", "MetricValue", "Details"]
UNION_KINDS = ("exfiltration", "destructive_ops", "error_spike", "privilege_escalation",
               "cross_schema_recon", "deep_schema_enum", "brute_force")

_MATCHES = {"exfiltration": D.exfiltration_match, "destructive_ops": D.destructive_match,
            "error_spike": D.error_match, "privilege_escalation": D.privilege_match,
            "cross_schema_recon": D.cross_schema_match, "deep_schema_enum": D.deep_enum_match,
            "brute_force": D.brute_force_match}
#: Line kinds that cover all of them.
_LINES = ("is_audit", "is_err", "t_privilege", "is_auth_failure")
_DETECTORS = {k: getattr(D, k) for k in UNION_KINDS}
_KEYS = {"exfiltration": [SRV, "backend_type", "processId"], "destructive_ops": [SRV, "backend_type"],
         "error_spike": [SRV, "backend_type"], "privilege_escalation": [SRV], "cross_schema_recon": [SRV, "processId"],
         "deep_schema_enum": [SRV, "processId"], "brute_force": ["ClientHost"]}


def by_tag(tag: str, values: dict[str, Column], default: Column | None = None) -> Column:
    """The value of the row's tag; null (or ``default``) for others."""
    out = F
    for name, value in values.items():
        out = out.when(F.col(tag) == name, value)
    return out.otherwise(default) if default is not None else out


def tag_lines(bronze: DataFrame, matches: dict[str, Column], as_of, windows: dict[str, tuple], tag: str,
              kinds: tuple[str, ...]) -> DataFrame:
    """One row per line and name in ``matches`` whose condition it fulfils within the name's
    lookback, with that name in ``tag`` and the start of the name's window in ``Bucket``.

    ``windows``: name -> (lookback or None, bucket or None). The log is read once, over the longest lookback.
    ``kinds``: columns of the parsed log of which every such line has at least one; tested
    first, in the scan of a parsed log, so that each condition is evaluated once and on few lines.
    """
    used = {n: windows[n] for n in matches}
    lookbacks = [lb for lb, _ in used.values()]
    df = bronze if any(lb is None for lb in lookbacks) else since(bronze, as_of, max(lookbacks, key=seconds))
    conds = {n: c & within(bronze, as_of, used[n][0]) for n, c in matches.items()}
    conds = {n: c & F.col(TS).isNotNull() if used[n][1] is not None else c for n, c in conds.items()}
    df = df.where(reduce(lambda a, b: a | b, [stored(bronze, k) for k in kinds]))
    df = df.withColumn(tag, F.explode(F.array(*[F.when(c, F.lit(n)) for n, c in conds.items()])))
    df = df.where(F.col(tag).isNotNull())
    bins = {}                   # one bin column per length, as Spark plans one window at a time
    for bucket in {seconds(b) for _, b in used.values() if b is not None}:
        bins[bucket] = f"__bin{bucket}"
        epoch = F.lit(dt.datetime(1970, 1, 1)).cast(bronze.schema[TS].dataType)
        df = df.withColumn(bins[bucket], bin_ts(F.coalesce(F.col(TS), epoch), bucket))
    none = F.lit(None).cast(bronze.schema[TS].dataType)
    start = by_tag(tag, {n: F.col(bins[seconds(b)]) for n, (_, b) in used.items() if b is not None}, none) if bins else none
    return df.withColumn("Bucket", start).drop(*bins.values())


def _param(params: dict, kind: str, name: str):
    """A detector's parameter: the given one, else its function's default."""
    default = inspect.signature(_DETECTORS[kind]).parameters.get(name)
    return params.get(kind, {}).get(name, default.default if default is not None else None)


def feed_sessions(bronze: DataFrame, as_of, lookback, auth_lookback) -> DataFrame:
    """Per backend the session of any connection line (User, Database, SourceHost) and the user
    of the authorized ones (AuthUser), in one aggregation."""
    spans = (lookback, auth_lookback)
    conn = bronze if None in spans else since(bronze, as_of, max(spans, key=seconds))
    conn = conn.where(connection_lines(bronze)).select(
        *KEYS, stored(bronze, "p_user").alias("User"), stored(bronze, "p_database").alias("Database"),
        stored(bronze, "p_host").alias("SourceHost"), within(bronze, as_of, lookback).alias("any"),
        (connection_lines(bronze, CONN_TERMS_AUTHORIZED) & within(bronze, as_of, auth_lookback)).alias("auth"))
    conn = conn.where(is_not_empty("User"))
    return conn.groupBy(*KEYS).agg(*[F.max(F.when(F.col("any"), F.col(c))).alias(c)
                                     for c in ("User", "Database", "SourceHost")],
                                   F.max(F.when(F.col("auth"), F.col("User"))).alias("AuthUser"))


def _needs_as_of(params: dict, kinds) -> bool:
    return any(_param(params, k, n) is not None for k in kinds for n in ("lookback", "session_lookback"))


def anomaly_groups(bronze: DataFrame, *, as_of=None, params: dict | None = None, kinds=UNION_KINDS,
                   spans: DataFrame | None = None) -> DataFrame:
    """The detectors' groups before any threshold: kind, keys and window, N lines, first and last
    time, session, small sets S1 and S2, bounded sets A (10), B (3) and C (5)."""
    params = params or {}
    if _needs_as_of(params, kinds):
        as_of = resolve_as_of(bronze, as_of)
    windows = {k: (_param(params, k, "lookback"), _param(params, k, "bucket")) for k in kinds}
    df = tag_lines(bronze, {k: _MATCHES[k](bronze) for k in kinds}, as_of, windows, "kind", _LINES)
    obj, kind_of = stored(bronze, "p_object"), stored(bronze, "p_object_type")
    system_table = label_case(P.SYSTEM_TABLES, P.SYSTEM_TABLES_DEFAULT, msg=D.catalog_query_text())
    df = df.select(
        "kind", "Bucket", TS, *KEYS, "backend_type",
        stored(bronze, "p_user").alias("DirectUser"), stored(bronze, "p_database").alias("DirectDatabase"),
        stored(bronze, "p_host").alias("DirectHost"),
        by_tag("kind", {
            "destructive_ops": trim_chars(" ", stored(bronze, "p_statement")),
            "error_spike": label_case(P.ERROR_SPIKE_CATEGORIES, P.ERROR_SPIKE_DEFAULT),
            "privilege_escalation": label_case(P.PRIVILEGE_OPS, P.PRIVILEGE_OPS_DEFAULT),
            "cross_schema_recon": schema_of(obj), "deep_schema_enum": system_table}).alias("s1"),
        by_tag("kind", {"destructive_ops": kind_of, "error_spike": F.col("sqlerrcode"),
                        "privilege_escalation": F.col("errorLevel"), "cross_schema_recon": obj}).alias("s2"),
        by_tag("kind", {"exfiltration": kind_of, "brute_force": stored(bronze, "p_user")}).alias("a"),
        by_tag("kind", {"exfiltration": query_text(), "destructive_ops": query_text(),
                        "error_spike": F.col("message"), "privilege_escalation": D.privilege_sample()}).alias("b"),
        by_tag("kind", {"brute_force": stored(bronze, "p_database")}).alias("c"))
    auth_kinds = [k for k in ("cross_schema_recon", "deep_schema_enum") if k in kinds]
    reach = (_session_span(params, kinds, "exfiltration"), _session_span(params, kinds, "cross_schema_recon"))
    sessions = feed_sessions(bronze, as_of, *reach) if spans is None else feed_sessions_at(spans, as_of, *reach)
    df = join_sessions(df, sessions, "left")
    found = F.when(F.col("kind").isin(*auth_kinds), F.col("AuthUser")).otherwise(F.col("User")) if auth_kinds else "User"
    df = df.withColumns({"FinalUser": first_non_empty("DirectUser", found, default=P.UNKNOWN),
                         "FinalDatabase": first_non_empty("DirectDatabase", "Database", default=P.UNKNOWN),
                         "FinalHost": first_non_empty("DirectHost", "SourceHost", default=P.UNKNOWN)})
    df = df.where(by_tag("kind", {
        "exfiltration": D.not_superuser(), "destructive_ops": D.known_user(), "privilege_escalation": D.known_user(),
        "cross_schema_recon": D.not_superuser(), "deep_schema_enum": D.not_superuser()}, F.lit(True)))
    keys = {c: F.when(F.col("kind").isin(*[k for k in kinds if c in _KEYS[k]]), F.col(source))
            for c, source in ((SRV, SRV), ("backend_type", "backend_type"), ("processId", "processId"),
                              ("ClientHost", "DirectHost")) if any(c in _KEYS[k] for k in kinds)}
    for c in (SRV, "backend_type", "processId", "ClientHost"):
        keys.setdefault(c, F.lit(None).cast("long" if c == "processId" else "string"))
    df = df.withColumns(keys)
    return aggregate_with_sets(df, ["kind", *keys, "Bucket"], [
        ("N", "count", None), ("First", "min", TS), ("Last", "max", TS), ("User", "max", "FinalUser"),
        ("Database", "max", "FinalDatabase"), ("SourceHost", "max", "FinalHost"),
        ("S1", "small_set", "s1"), ("S2", "small_set", "s2")], [("A", "a", 10), ("B", "b", 3), ("C", "c", 5)])


def _session_span(params: dict, kinds, kind: str):
    return params.get(kind, {}).get("session_lookback", "24h") if kind in kinds else "24h"


def anomalies_union(bronze: DataFrame, *, as_of=None, params: dict | None = None, kinds=UNION_KINDS,
                    spans: DataFrame | None = None) -> DataFrame:
    """All detector rows in the common schema with ``TimeWindow`` (no ordering, no limit).

    ``params``: detector -> its parameters. Session lookbacks are those of ``exfiltration`` and,
    for the two reconnaissance detectors, of ``cross_schema_recon``. ``spans``: the stored session
    table, read instead of the log's connection lines.
    """
    params = params or {}
    g = anomaly_groups(bronze, as_of=as_of, params=params, kinds=kinds, spans=spans)
    size = {c: F.size(c).cast("long") for c in ("S1", "S2")}
    iso = F.concat(iso_datetime_text("First"), F.lit(" to "), iso_datetime_text("Last"))
    short = F.concat(hms("First"), F.lit(" - "), hms("Last"))
    metric = F.when(F.col("kind") == "cross_schema_recon", size["S1"]).otherwise(F.col("N"))
    g = g.withColumns({"MetricValue": metric,
                       "TimeWindow": F.when(F.col("kind").isin("exfiltration", "brute_force"), short).otherwise(iso)})

    def choose(values: dict) -> Column:
        return by_tag("kind", {k: v for k, v in values.items() if k in kinds})

    over = choose({k: F.col("MetricValue") > _param(params, k, "threshold") for k in kinds})
    g = g.where(over & ((F.col("kind") != "destructive_ops") | (F.col("backend_type") == P.CLIENT_BACKEND)))
    grade = choose({k: severity("MetricValue", _param(params, k, "high"), _param(params, k, "critical")) for k in kinds})
    multi = _param(params, "deep_schema_enum", "multi_table")
    risk = F.when(size["S1"] > multi, F.lit("HIGH - Multi-table scan")).otherwise(F.lit("MEDIUM"))
    backend, window = ("BackendType", F.col("backend_type")), ("TimeWindow", F.col("TimeWindow"))
    details = choose({
        "exfiltration": _map(("ProcessID", F.col("processId")), backend, window, ("TablesAccessed", join_set("A")),
                             ("SampleQueries", join_set("B", " ||| "))),
        "destructive_ops": _map(backend, ("Operations", join_set("S1")), ("TablesAffected", join_set("S2")), window,
                                ("SampleMessages", join_set("B"))),
        "error_spike": _map(backend, ("ErrorTypes", join_set("S1")), ("ErrorCodes", join_set("S2")), window,
                            ("SampleErrors", join_set("B"))),
        "privilege_escalation": _map(("Operations", join_set("S1")), ("LogTypes", join_set("S2")), window,
                                     ("SampleQueries", join_set("B"))),
        "cross_schema_recon": _map(("SchemaList", join_set("S1")), ("TablesAccessed", size["S2"]), window),
        "deep_schema_enum": _map(("RiskLevel", risk), ("UniqueSystemTables", size["S1"]),
                                 ("TablesScanned", join_set("S1")), window),
        "brute_force": _map(("Users", join_set("A")), ("Databases", join_set("C")), window)})
    types = {"exfiltration": "Potential Data Exfiltration", "destructive_ops": "Mass Destructive Operations",
             "error_spike": "Critical Error Spike", "privilege_escalation": "Privilege Escalation",
             "cross_schema_recon": "Cross-Schema Reconnaissance", "deep_schema_enum": "Deep Schema Enumeration",
             "brute_force": "Brute Force Authentication"}
    metrics = {"exfiltration": "SelectCount", "destructive_ops": "OperationCount", "error_spike": "ErrorCount",
               "privilege_escalation": "PrivilegeOpsCount", "cross_schema_recon": "SchemasAccessed",
               "deep_schema_enum": "SystemTableQueries", "brute_force": "FailedAttempts"}
    brute = F.col("kind") == "brute_force"
    whole_session = F.col("kind").isin("exfiltration", "destructive_ops", "error_spike")
    return g.select(
        F.col("Last").alias("TimeGenerated"),
        choose({k: F.lit(v) for k, v in types.items()}).alias("AnomalyType"), grade.alias("Severity"),
        F.when(brute, F.lit("Multiple")).otherwise(F.col(SRV)).alias("ServerName"),
        F.when(~brute, F.col("User")).alias("User"), F.when(whole_session, F.col("Database")).alias("Database"),
        F.when(whole_session, F.col("SourceHost")).when(brute, F.col("ClientHost")).alias("SourceHost"),
        choose({k: F.lit(v) for k, v in metrics.items()}).alias("MetricName"), "MetricValue", "TimeWindow",
        details.alias("Details"))


def _map(*pairs: tuple[str, Column]) -> Column:
    return F.create_map(*[x for k, v in pairs for x in (F.lit(k), F.coalesce(v.cast("string"), F.lit("")))])


def details_text(c: str = "Details") -> Column:
    """The entries of a ``Details`` map as "key=value; ..." in their order."""
    return F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")


def anomaly_details(anomalies: DataFrame) -> DataFrame:
    """The feed in long form: one row per anomaly and entry of its ``Details``."""
    return anomalies.select("TimeGenerated", "AnomalyType", "Severity", "ServerName", "User", "SourceHost",
                            "MetricValue", "TimeWindow", F.explode("Details").alias("Detail", "DetailValue"))
