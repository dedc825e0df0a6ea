"""Detectors with all their columns, kept up to date by a stream.

The state of a detector is a table of *partial rows*: per backend, window and clock
hour the count, the first and last time and the bounded sets (``make_set(x, n)``: the n
smallest values) of its log lines. Partial rows merge exactly (``sets.merge_partials``), so a
micro-batch appends the partial rows of its own lines and never reads the table: counts of a
hot server are combined in the tasks that read its lines. Connection lines go into a
session table in the same way.

Results are the merged rows of a key and window, joined with the sessions known by
then: a window is complete for what has arrived, open windows are included, and a
session that is opened or arrives late still names the user. ``detector_table`` computes
them from the state; ``start_detector_state(emit=...)`` hands on, after every micro-batch,
the rows of the window dates that the batch touched, for an upsert by key and window.

Each micro-batch writes under its batch id and replaces its own files when it is run
again. ``compact_state`` folds all batches up to one into a single folder, which takes their
place; readers take the newest folded folder and the batches after it. With ``keep`` it
leaves out windows that began longer ago.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.config import committed_batches
from auditlens.functions import patterns as P
from auditlens.functions.text import contains_any, extract, first_non_empty, is_not_empty
from auditlens.functions.timefn import TS, bin_ts, seconds
from auditlens.operators import detectors as D
from auditlens.operators.sessions import CONN_TERMS_ALL, CONN_TERMS_AUTHORIZED, KEYS
from auditlens.operators.sets import aggregate_with_sets, merge_partials
from auditlens.sources.bronze import BRONZE_SCHEMA
from auditlens.sources.parsed import flag

SRV = "LogicalServerName"
FINAL = {"User": ("FinalUser", "DirectUser"), "Database": ("FinalDatabase", "DirectDatabase"),
         "SourceHost": ("FinalHost", "DirectHost")}
ALL_FIELDS = ("User", "Database", "SourceHost")


@dataclass(frozen=True)
class Kind:
    """How a detector's lines become partial rows, and merged rows its output.

    ``sets``: (name, column, n or None for a small domain); ``sizes``: (name, set) for
    distinct counts; ``fields``: what the session supplies; ``keep``: which merged
    backends count, judged once their user is known.
    """

    lines: Callable[..., DataFrame]
    output: Callable[..., DataFrame]
    keys: tuple[str, ...]
    bucket: str
    count: str
    first: str
    last: str
    sets: tuple[tuple[str, str, int | None], ...]
    sizes: tuple[tuple[str, str], ...] = ()
    fields: tuple[str, ...] = ()
    keep: Callable[[], Column] | None = None
    terms: tuple[str, ...] = CONN_TERMS_ALL


KINDS = {
    "exfiltration": Kind(
        D.exfiltration_lines, D.exfiltration_output, (SRV, "backend_type", "processId"), "5m",
        "SelectCount", "FirstSeen", "LastSeen",
        (("TablesAccessed", "TableName", 10), ("SampleQueries", "QueryText", 3)),
        fields=ALL_FIELDS, keep=D.not_superuser),
    "destructive_ops": Kind(
        D.destructive_lines, D.destructive_output, (SRV, "backend_type"), "2m",
        "OperationCount", "FirstOccurrence", "LastOccurrence",
        (("Operations", "AuditStatement", None), ("TablesAffected", "TableAffected", None),
         ("SampleMessages", "QueryText", 3)),
        fields=ALL_FIELDS, keep=D.known_user),
    "error_spike": Kind(
        D.error_spike_lines, D.error_spike_output, (SRV, "backend_type"), "1m",
        "ErrorCount", "FirstError", "LastError",
        (("ErrorTypes", "ErrorCategory", None), ("ErrorCodes", "sqlerrcode", None), ("SampleErrors", "message", 3)),
        fields=ALL_FIELDS),
    "privilege_escalation": Kind(
        D.privilege_lines, D.privilege_output, (SRV,), "1h",
        "PrivilegeOpsCount", "FirstOp", "LastOp",
        (("Operations", "PrivilegeOp", None), ("LogTypes", "LogType", None), ("SampleQueries", "QueryText", 3)),
        fields=("User",), keep=D.known_user),
    "cross_schema_recon": Kind(
        D.cross_schema_lines, D.cross_schema_output, (SRV, "processId"), "10m",
        "lines", "FirstAccess", "LastAccess",
        (("SchemaList", "SchemaName", None), ("TableList", "TableAccessed", None)),
        sizes=(("SchemasAccessed", "SchemaList"), ("TablesAccessed", "TableList")),
        fields=("User",), keep=D.not_superuser, terms=CONN_TERMS_AUTHORIZED),
    "deep_schema_enum": Kind(
        D.deep_enum_lines, D.deep_enum_output, (SRV, "processId"), "5m",
        "SystemTableQueries", "FirstQuery", "LastQuery", (("TablesScanned", "SystemTable", None),),
        sizes=(("UniqueSystemTables", "TablesScanned"),),
        fields=("User",), keep=D.not_superuser, terms=CONN_TERMS_AUTHORIZED),
    "brute_force": Kind(
        D.brute_force_rows, D.brute_force_output, ("ClientHost",), "1h",
        "FailedAttempts", "FirstAttempt", "LastAttempt",
        (("Users", "UserName", 10), ("Databases", "DatabaseName", 5))),
}


def _part_keys(kind: Kind) -> list[str]:
    """Keys of a partial row: all lines of one have the same session and direct values."""
    backend = KEYS if kind.fields else []
    return list(dict.fromkeys([*kind.keys, *backend, *[FINAL[f][1] for f in kind.fields], "WindowStart", "Hour"]))


def partial_rows(log: DataFrame, kind: Kind, bucket: str | None = None) -> DataFrame:
    """The partial rows of some log lines (a micro-batch, or a whole history)."""
    df = kind.lines(log).withColumns({"WindowStart": bin_ts(TS, bucket or kind.bucket),
                                      "Hour": F.date_trunc("hour", F.col(TS))})
    small = [(name, "small_set", column) for name, column, n in kind.sets if n is None]
    bounded = [(name, column, n) for name, column, n in kind.sets if n is not None]
    out = aggregate_with_sets(df, _part_keys(kind), [
        (kind.count, "count", None), (kind.first, "min", TS), (kind.last, "max", TS), *small], bounded)
    return out.withColumn("window_date", F.to_date("WindowStart"))


def session_rows(log: DataFrame) -> DataFrame:
    """The sessions of some log lines: one row per backend, hour and distinct session."""
    conn = log.where(flag(log, "is_conn") & contains_any("message", CONN_TERMS_ALL))
    conn = conn.select(*KEYS, F.date_trunc("hour", F.col(TS)).alias("Hour"),
                       contains_any("message", CONN_TERMS_AUTHORIZED).alias("authorized"),
                       extract(P.USER_RE, "message").alias("User"), extract(P.DATABASE_RE, "message").alias("Database"),
                       extract(P.HOST_RE, "message").alias("SourceHost"))
    out = conn.where(is_not_empty("User")).dropDuplicates()
    return out.withColumn("window_date", F.to_date("Hour"))


def with_sessions(parts: DataFrame, sessions: DataFrame, kind: Kind, session_lookback: str | None) -> DataFrame:
    """Final<X> of each partial row: direct value, else that of the backend's connections
    (of any time, or of the partial row's hour and ``session_lookback`` before it), else UNKNOWN."""
    if kind.terms == CONN_TERMS_AUTHORIZED:
        sessions = sessions.where("authorized")
    by = list(KEYS)
    if session_lookback is not None:
        hours = max(1, seconds(session_lookback) // 3600)
        reached = F.sequence("Hour", F.col("Hour") + F.expr(f"INTERVAL {hours} HOURS"), F.expr("INTERVAL 1 HOUR"))
        sessions = sessions.withColumn("Hour", F.explode(reached))
        by.append("Hour")
    found = sessions.groupBy(*by).agg(*[F.max(f).alias(f) for f in kind.fields])
    key = F.concat_ws("\x1f", *[F.col(c).cast("string") for c in by])
    key = F.when(F.col(SRV).isNotNull() & F.col("processId").isNotNull(), key)
    # a key of its own for the lookup's exchange, so that AQE can split a hot backend
    found = found.select(key.alias("__session"), *kind.fields)
    out = parts.withColumn("__session", key).join(found, "__session", "left").drop("__session")
    return out.withColumns({FINAL[f][0]: first_non_empty(FINAL[f][1], f, default=P.UNKNOWN) for f in kind.fields})


def merged(parts: DataFrame, sessions: DataFrame | None, kind: Kind, *, session_lookback: str | None = "24h",
           windowed: bool = True) -> DataFrame:
    """One row per key and window (or per key) with the detector's aggregates."""
    maxs = []
    if kind.fields:
        parts = with_sessions(parts.drop("window_date"), sessions, kind, session_lookback)
        maxs = [FINAL[f][0] for f in kind.fields]
    if kind.keep is not None:
        parts = parts.where(kind.keep())
    keys = [*kind.keys, *(["WindowStart"] if windowed else [])]
    out = merge_partials(parts, keys, sums=[kind.count], mins=[kind.first], maxs=[kind.last, *maxs],
                         sets=[(name, n) for name, _, n in kind.sets])
    out = out.withColumnsRenamed({FINAL[f][0]: f for f in kind.fields})
    return out.withColumns({name: F.size(of).cast("long") for name, of in kind.sizes}) if kind.sizes else out


# ------------------------------------------------------------------ stored state
def _schema(spark: SparkSession, name: str) -> T.StructType:
    empty = spark.createDataFrame([], BRONZE_SCHEMA)
    rows = session_rows(empty) if name == "sessions" else partial_rows(empty, KINDS[name])
    return T.StructType(rows.schema.fields + [T.StructField("fold", T.IntegerType()), T.StructField("batch", T.LongType())])


def _stored(spark: SparkSession, path: str, name: str) -> DataFrame:
    """All rows of a state table that count: the newest folded folder and the batches after it."""
    df = spark.read.schema(_schema(spark, name)).option("basePath", f"{path}/{name}").parquet(f"{path}/{name}")
    folded = committed_batches(spark, f"{path}/{name}/fold=1")
    if not folded:
        return df.where("fold = 0")
    newest = folded[-1]
    return df.where(((F.col("fold") == 1) & (F.col("batch") == newest)) | ((F.col("fold") == 0) & (F.col("batch") > newest)))


def _store(df: DataFrame, path: str, name: str, batch: int, fold: int = 0) -> None:
    df.write.mode("overwrite").partitionBy("window_date").parquet(f"{path}/{name}/fold={fold}/batch={batch}")


def compact_state(spark: SparkSession, path: str, kinds: Sequence[str], upto: int, *, keep: str | None = None,
                  as_of: dt.datetime | None = None) -> None:
    """Fold the batches up to ``upto``, of which none may still be running, into one
    folder per table. With ``keep``, windows (and connections) that began longer than that
    before ``as_of`` are left out. The folders it replaces may be removed when no reader
    uses them any more."""
    for name in ["sessions", *kinds]:
        df = _stored(spark, path, name).where(F.col("batch") <= upto).drop("fold", "batch")
        if keep is not None:
            begin = F.col("Hour") if name == "sessions" else F.col("WindowStart")
            df = df.where(begin >= F.lit(as_of - dt.timedelta(seconds=seconds(keep))))
        if name == "sessions":
            df = df.dropDuplicates()
        else:
            kind = KINDS[name]
            df = merge_partials(df, [*_part_keys(kind), "window_date"], sums=[kind.count], mins=[kind.first],
                                maxs=[kind.last], sets=[(s, n) for s, _, n in kind.sets])
        _store(df, path, name, upto, fold=1)


def detector_table(spark: SparkSession, path: str, name: str, *, session_lookback: str | None = "24h",
                   windowed: bool = True, dates: DataFrame | None = None, **thresholds) -> DataFrame:
    """The detector's rows for all that the state holds, or for the window dates in ``dates``."""
    kind = KINDS[name]
    parts = _stored(spark, path, name)
    if dates is not None:
        parts = parts.join(dates, "window_date", "left_semi")
    sessions = _stored(spark, path, "sessions") if kind.fields else None
    return kind.output(merged(parts, sessions, kind, session_lookback=session_lookback, windowed=windowed), **thresholds)


def touched_dates(batch: DataFrame, session_lookback: str | None = "24h") -> DataFrame:
    """(window_date): dates of the windows that a batch's lines fall into or, ``session_lookback``
    long, its connections reach. Without a limit a connection reaches every date."""
    days = 1 + (seconds(session_lookback) - 1) // 86400
    day = F.to_date(TS)
    return batch.where(F.col(TS).isNotNull()).select(
        F.explode(F.sequence(day, F.date_add(day, days))).alias("window_date")).distinct()


def start_detector_state(stream: DataFrame, path: str, checkpoint: str, kinds: Sequence[str] = tuple(KINDS), *,
                         buckets: dict[str, str] | None = None, session_lookback: str | None = "24h",
                         thresholds: dict[str, dict] | None = None,
                         emit: Callable[[str, DataFrame, int], None] | None = None,
                         fold_every: int | None = 100, keep: str | None = None, trigger: dict | None = None):
    """Keep the state of detectors up to date from a stream of log rows.

    ``emit(name, rows, batch_id)`` is called after every micro-batch with the detector's rows
    of the window dates the batch touched, as they now stand; a sink upserts
    them by key and window. Every ``fold_every`` batches the state is folded.
    """
    buckets, thresholds = buckets or {}, thresholds or {}

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()      # one micro-batch, read by every detector
        try:
            _store(session_rows(batch), path, "sessions", batch_id)
            for name in kinds:
                _store(partial_rows(batch, KINDS[name], buckets.get(name)), path, name, batch_id)
            if emit is not None:
                dates = touched_dates(batch, session_lookback) if session_lookback else None
                for name in kinds:
                    emit(name, detector_table(spark, path, name, session_lookback=session_lookback, dates=dates,
                                              **thresholds.get(name, {})), batch_id)
            if fold_every and batch_id % fold_every == fold_every - 1:
                compact_state(spark, path, kinds, batch_id, keep=keep, as_of=batch.agg(F.max(TS)).first()[0])
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "1 minute"})).start()
