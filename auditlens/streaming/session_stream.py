"""Session correlation inside a stream (I5): log lines joined with the connection
lines of the same stream.

A line belongs to the newest connection of its backend (server and process) that is
no later than the line and at most ``lookback`` older: two stream-stream left outer joins
with intervals, all sides watermarked, so a session that is opened
while the stream runs is resolved, and the state of a connection is dropped when no line can
reach it any more. The first join meets the connections of the line's own bin of time, the
second, for lines that found none there, the newest connection of each earlier bin: a
line that several connections reach leaves them a bounded number of times, and an
aggregation by line keeps the newest. A line without a connection is
emitted, as UNKNOWN, once the watermark has passed it (and ``lookback`` and two bins more,
for which the joins hold the watermark back).

All steps are stateful operators in append mode; windowed aggregations
(``session_detector_stream``) chain onto them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions import patterns as P
from auditlens.functions.text import contains_any, extract, first_non_empty, is_not_empty
from auditlens.functions.timefn import TS, above_watermark, duration, seconds
from auditlens.operators.sessions import CONN_TERMS_ALL, KEYS, backend_key

FINAL = {"User": ("FinalUser", "DirectUser"), "Database": ("FinalDatabase", "DirectDatabase"),
         "SourceHost": ("FinalHost", "DirectHost")}


def connection_stream(stream: DataFrame, *, watermark="10 minutes", terms=CONN_TERMS_ALL,
                      fields=("User", "Database", "SourceHost")) -> DataFrame:
    """(backend, ConnTime, fields) of the connection lines that name a user."""
    read = {"User": P.USER_RE, "Database": P.DATABASE_RE, "SourceHost": P.HOST_RE}
    conn = stream.select(*KEYS, "message", F.col(TS).alias("ConnTime")).withWatermark("ConnTime", watermark)
    named = contains_any("message", terms) & is_not_empty(extract(P.USER_RE, "message"))
    conn = conn.where(above_watermark(named, "ConnTime"))
    return conn.select(backend_key().alias("conn_backend"), "ConnTime",
                       *[extract(read[f], "message").alias(f) for f in fields])


def session_candidates(events: DataFrame, connections: DataFrame, *, lookback="24h", carry="1h",
                       fields=("User", "Database", "SourceHost")) -> DataFrame:
    """``events`` (with a LineId), each with ``near``, a connection no later than the line in the line's bin of
    size ``carry``, or else with ``far``, the newest one of an earlier bin; both null without a connection.

    Rows of a line: its near connections, or else one per bin of ``lookback`` at most, however often its
    backend connects in that time. All that its backend has in the state is never gone through.
    """
    columns = [c for c in events.columns if c not in (TS, "LineId")]
    reach, day = F.expr(f"INTERVAL {seconds(lookback)} SECONDS"), seconds(lookback) * 1_000_000
    size = min(seconds(carry), seconds(lookback))
    bin_size, time = F.expr(f"INTERVAL {size} SECONDS"), F.unix_micros(TS)

    # newest connection of each backend and bin, for the lines of later bins; a line is only held
    # against those of its span of ``lookback`` and the one before, not against all in the state
    latest = connections.groupBy("conn_backend", F.window("ConnTime", duration(size)).alias("bin")).agg(
        F.max(F.struct("ConnTime", *fields)).alias("far"))
    at = F.floor(F.unix_micros(F.col("far.ConnTime")) / day)
    latest = latest.select(F.col("conn_backend").alias("far_backend"), F.window_time("bin").alias("FarTime"), "far",
                           F.explode(F.array(at, at + 1)).alias("far_day"))

    events = events.withColumns({"backend": backend_key(), "line_bin": F.floor(time / (size * 1_000_000)),
                                 "day": F.floor(time / day)})
    near = connections.withColumn("conn_bin", F.floor(F.unix_micros("ConnTime") / (size * 1_000_000)))
    met = events.join(near, (F.col("backend") == F.col("conn_backend")) & (F.col("line_bin") == F.col("conn_bin"))
                      & (F.col("ConnTime") <= F.col(TS)) & (F.col("ConnTime") >= F.col(TS) - bin_size), "leftOuter")
    met = met.select(TS, *columns, "LineId", "day", F.when(F.col("ConnTime").isNull(), F.col("backend")).alias("open_backend"),
                     F.when(F.col("ConnTime").isNotNull(), F.struct("ConnTime", *fields)).alias("near"))
    return met.join(latest, (F.col("open_backend") == F.col("far_backend")) & (F.col("day") == F.col("far_day"))
                   & (F.col("FarTime") < F.col(TS)) & (F.col("FarTime") >= F.col(TS) - reach - bin_size)
                   & (F.col("far.ConnTime") >= F.col(TS) - reach), "leftOuter")


def session_enrich_stream(events: DataFrame, connections: DataFrame, *, lookback="24h", grain="1m", carry="1h",
                          fields=("User", "Database", "SourceHost")) -> DataFrame:
    """``events`` (a watermarked stream with the Direct<X> columns) with Final<X>: direct
    value, else that of the newest connection within ``lookback``, else UNKNOWN.

    Lines are emitted when the watermark has passed their ``grain``. The column
    ``Minute`` is their window of that size; aggregations that follow take their
    windows from ``window_time(Minute)``, which carries the watermark on.
    """
    columns = [c for c in events.columns if c != TS]
    # equal lines are lines of their own: the joins repeat lines, so each needs a name
    met = session_candidates(events.withColumn("LineId", F.expr("uuid()")), connections, lookback=lookback,
                             carry=carry, fields=fields)
    # aggregates and not keys: what no later step reads leaves the join and the state
    kept = [F.first(c).alias(c) for c in columns]
    lines = met.groupBy("LineId", F.window(TS, duration(grain)).alias("Minute")).agg(
        F.first(F.date_format(TS, "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("at"), *kept,
        F.max(F.coalesce("near", "far")).alias("s"))
    out = lines.select("Minute", F.to_timestamp("at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(TS), *columns,
                       *[F.col("s")[f].alias(f) for f in fields])
    return out.withColumns({FINAL[f][0]: first_non_empty(FINAL[f][1], f, default=P.UNKNOWN) for f in fields})


def window_of(bucket: str) -> Column:
    """The event-time window of lines that ``session_enrich_stream`` has emitted."""
    return F.window(F.window_time("Minute"), duration(bucket))
