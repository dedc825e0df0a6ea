"""Session lookup (I4) and enrichment.

AUDIT and error lines carry no user; the connection line of the same
backend (processId on a server) does. ``session_info`` keeps one row per
(processId, LogicalServerName); ``session_enrich`` left-joins it.

Join strategy is left to Catalyst/AQE: the lookup is an aggregate whose
size is measured at runtime, so it is broadcast only when the measured
size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and
otherwise sort-merge joined. The join key is one text per backend
(``backend_key``), not the lookup's group keys: so the small lookup gets an
exchange of its own, and AQE's skew join can split a backend that holds a
large share of the events. (With the group keys the lookup would keep its
aggregation's partitioning, and AQE splits only where both sides are shuffled.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlens.functions import patterns as P
from auditlens.functions.text import contains_any, first_non_empty, is_not_empty
from auditlens.functions.timefn import TS, duration, since
from auditlens.sources.parsed import flag, stored

KEYS = ["processId", "LogicalServerName"]
CONN_TERMS_ALL = (P.CONN_AUTHORIZED, P.CONN_RECEIVED)
CONN_TERMS_AUTHORIZED = (P.CONN_AUTHORIZED,)


def session_info(bronze: DataFrame, as_of=None, lookback: str | None = "24h",
                 terms=CONN_TERMS_ALL, fields=("User", "Database", "SourceHost")) -> DataFrame:
    """One (User, Database, SourceHost) per backend from its connection lines.

    ``any()`` is taken as ``max`` (deterministic; prefers a non-empty value).
    """
    conn = since(bronze, as_of, lookback).where(connection_lines(bronze, terms))
    conn = conn.select(*KEYS,
                       stored(bronze, "p_user").alias("User"),
                       stored(bronze, "p_database").alias("Database"),
                       stored(bronze, "p_host").alias("SourceHost"))
    conn = conn.where(is_not_empty("User"))
    return conn.groupBy(*KEYS).agg(*[F.max(f).alias(f) for f in fields])


def connection_lines(bronze: DataFrame, terms=CONN_TERMS_ALL) -> Column:
    if tuple(terms) == CONN_TERMS_ALL:
        return stored(bronze, "is_conn")
    if tuple(terms) == CONN_TERMS_AUTHORIZED:
        return flag(bronze, "is_conn") & stored(bronze, "is_conn_auth")
    return flag(bronze, "is_conn") & contains_any("message", terms)


def backend_key() -> Column:
    """Server and process in one text; null, so without a match, if either is."""
    return F.concat("LogicalServerName", F.lit("\x1f"), F.col("processId").cast("string"))


def join_sessions(events: DataFrame, sessions: DataFrame, how: str) -> DataFrame:
    """``events`` with the session columns of their backend."""
    key = "__backend"
    found = sessions.withColumn(key, backend_key()).drop(*KEYS)
    return events.withColumn(key, backend_key()).join(found, key, how).drop(key)


def session_enrich(events: DataFrame, sessions: DataFrame,
                   fields=("User", "Database", "SourceHost")) -> DataFrame:
    """Left-join the lookup; Final<X> = direct value, else session, else UNKNOWN.

    ``events`` must carry the Direct<X> columns for the requested fields
    (see ``conn_parse``).
    """
    out = join_sessions(events, sessions, "left")
    final = {"User": ("FinalUser", "DirectUser"),
             "Database": ("FinalDatabase", "DirectDatabase"),
             "SourceHost": ("FinalHost", "DirectHost")}
    return out.withColumns({final[f][0]: first_non_empty(final[f][1], f, default=P.UNKNOWN)
                            for f in fields})


def session_asof(events: DataFrame, bronze: DataFrame, as_of=None, lookback: str | None = None,
                 bucket: str = "10 minutes") -> DataFrame:
    """PID-reuse aware lookup: the newest connection of the backend at or
    before each event (``AsOfUser``, ``AsOfDatabase``, ``AsOfHost``).

    Linear, whatever a backend reconnects: nothing is joined on an interval. Events and
    connections are put in order per backend and ``bucket``, where a running maximum is the newest
    connection so far; for events before their bucket's first connection, a second, narrow table carries the
    newest connection of all earlier buckets in. A hot backend is spread over its buckets; the
    carry's window holds one row per backend and bucket. Of connections at one time
    the largest (User, Database, SourceHost) counts. Events without a time or a backend find none.
    The events are scanned twice, the second time for backend and time only.
    """
    d, session = duration(bucket), F.struct("at", "AsOfUser", "AsOfDatabase", "AsOfHost")
    conn = since(bronze, as_of, lookback).where(stored(bronze, "is_conn"))
    conn = conn.select(*KEYS, F.col(TS).cast(events.schema[TS].dataType).alias("at"),
                       stored(bronze, "p_user").alias("AsOfUser"),
                       stored(bronze, "p_database").alias("AsOfDatabase"),
                       stored(bronze, "p_host").alias("AsOfHost"))
    whole = [F.col(c).isNotNull() for c in (*KEYS, "at")]
    conn = conn.where(is_not_empty("AsOfUser") & whole[0] & whole[1] & whole[2])
    conn = conn.select(*KEYS, "at", F.window("at", d).start.alias("bin"), session.alias("session"))

    # F.window leaves out rows without a time, so these take a bin of their own
    epoch = F.lit("1970-01-01 00:00:00").cast(events.schema[TS].dataType)
    bin_of = F.when(F.col(TS).isNotNull(), F.col("__bin"))
    ev = events.withColumn("__bin", F.window(F.coalesce(F.col(TS), epoch), d).start)
    none = F.lit(None).cast(conn.schema["session"].dataType)
    row = F.struct(*[F.col(c) for c in events.columns])
    lines = ev.select(*KEYS, F.col(TS).alias("at"), bin_of.alias("bin"), none.alias("session"), row.alias("row"))

    bins = lines.select(*KEYS, "bin", "session").unionByName(conn.select(*KEYS, "bin", "session"))
    bins = bins.where(F.col("bin").isNotNull()).groupBy(*KEYS, "bin").agg(F.max("session").alias("newest"))
    earlier = Window.partitionBy(*KEYS).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    carry = bins.select(*KEYS, "bin", F.max("newest").over(earlier).alias("carried"))

    so_far = (Window.partitionBy(*KEYS, "bin").orderBy("at")
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    both = lines.unionByName(conn.withColumn("row", F.lit(None).cast(lines.schema["row"].dataType)))
    placed = both.withColumn("session", F.max("session").over(so_far)).where(F.col("row").isNotNull())
    found = placed.join(carry.where(F.col("carried").isNotNull()), [*KEYS, "bin"], "left")
    newest = F.coalesce("session", "carried")
    return found.select("row.*", *[newest[c].alias(c) for c in ("AsOfUser", "AsOfDatabase", "AsOfHost")])


def _spell_aggs(log: DataFrame):
    return [F.max(TS).alias("LastEvent"), F.count(F.lit(1)).alias("Events"),
            F.count_if(stored(log, "is_audit")).alias("AuditLogs"),
            F.count_if(F.col("errorLevel").isin(*P.ERROR_LEVELS)).alias("Errors"),
            F.max(stored(log, "p_user")).alias("User")]


SPELL_COLS = [*KEYS, "SessionStart", "LastEvent", "Events", "AuditLogs", "Errors", "User"]


def backend_sessions(bronze: DataFrame, *, as_of=None, lookback: str | None = "24h", gap: str = "30m") -> DataFrame:
    """Spells of activity: the lines of a backend without a pause longer than ``gap``.

    One row per backend and spell: SessionStart, LastEvent, Events, AuditLogs, Errors and User
    (from the spell's own lines; '' where none names one). Lines without an event time take no part.

    Lines in one bin of length ``gap`` belong to one spell, so they are counted per backend and
    bin first, with map-side combine, and only the bins are put in order: a backend with a third of all lines
    costs its task one narrow row per bin. (A plain session window sends such a backend's lines to one task.)
    """
    df = since(bronze, as_of, lookback).where(F.col(TS).isNotNull())
    bins = df.groupBy(*KEYS, F.window(TS, duration(gap)).alias("bin")).agg(
        F.min(TS).alias("SessionStart"), *_spell_aggs(bronze))
    w = Window.partitionBy(*KEYS).orderBy("SessionStart")
    pause = F.col("SessionStart") > F.lag("LastEvent").over(w) + F.expr(f"INTERVAL {duration(gap)}")
    spells = bins.withColumn("pause", pause.cast("int")).withColumn("spell", F.sum(F.coalesce("pause", F.lit(1))).over(w))
    return spells.groupBy(*KEYS, "spell").agg(
        F.min("SessionStart").alias("SessionStart"), F.max("LastEvent").alias("LastEvent"),
        *[F.sum(c).alias(c) for c in ("Events", "AuditLogs", "Errors")], F.max("User").alias("User")).select(*SPELL_COLS)


def backend_sessions_stream(stream: DataFrame, *, gap: str = "30m", watermark: str = "10 minutes") -> DataFrame:
    """The same spells from a stream: a session window, emitted when the watermark passes its end."""
    df = stream.withWatermark(TS, watermark)
    agg = df.groupBy(*KEYS, F.session_window(TS, duration(gap)).alias("spell")).agg(*_spell_aggs(stream))
    return agg.withColumn("SessionStart", F.col("spell.start")).select(*SPELL_COLS)
