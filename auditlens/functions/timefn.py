"""Time helpers: bins, lookback filters, datetime text and boundary diffs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions.text import col_

TS = "EventProcessedUtcTime"
# time column -> date partition column of the stored table it lives in
DATE_PARTITIONS = {TS: "event_date", "Timestamp": "metric_date"}

_UNITS = {"s": 1, "m": 60, "h": 3600, "d": 86400}


def seconds(span: str | int | float | None) -> int | None:
    """'5m' / '1h' / '2d' / '5 minutes' / seconds -> seconds."""
    if span is None:
        return None
    if isinstance(span, (int, float)):
        return int(span)
    s = span.strip().lower()
    if s[-1] in _UNITS and s[:-1].strip().replace(".", "", 1).isdigit():
        return int(float(s[:-1]) * _UNITS[s[-1]])
    n, unit = s.split()
    unit = unit.rstrip("s")
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit]
    return int(float(n) * mult)


def duration(span: str | int) -> str:
    """Seconds or a short span -> a Spark duration string ('300 seconds')."""
    return f"{seconds(span)} seconds"


def bin_ts(ts: str | Column, span: str | int) -> Column:
    """``bin(ts, span)``: start of the epoch-aligned tumbling window."""
    return F.window(col_(ts), duration(span)).start


def since(df: DataFrame, as_of, lookback: str | int | None, ts: str = TS, align: str | int | None = None) -> DataFrame:
    """``where ts >= ago(lookback)`` relative to ``as_of`` (see :func:`resolve_as_of`).

    ``lookback=None`` keeps the whole history. A resolved ``as_of`` is a Python
    datetime, pushed down into the scan as a literal; a Column stays one.
    ``align`` moves the start down to a whole bin, so that no bin is cut.
    """
    if lookback is None:
        return df
    as_of = resolve_as_of(df, as_of, ts)
    if as_of is None:               # no event time at all
        return df.where(F.col(ts).isNotNull())
    if isinstance(as_of, Column):
        lower = as_of - F.expr(f"INTERVAL {seconds(lookback)} SECONDS")
        return df.where(F.col(ts) >= (bin_ts(lower, align) if align else lower))
    start = as_of - dt.timedelta(seconds=seconds(lookback))
    if align:
        epoch = dt.datetime(1970, 1, 1, tzinfo=start.tzinfo)
        start -= (start - epoch) % dt.timedelta(seconds=seconds(align))
    out = df.where(F.col(ts) >= F.lit(start).cast(df.schema[ts].dataType))
    part = DATE_PARTITIONS.get(ts)
    if part and part in df.columns:
        # stored tables are partitioned by the UTC date of their time column
        out = out.where(F.col(part) >= F.lit(start.date()))
    return out


def within(df: DataFrame, as_of, lookback: str | int | None, ts: str = TS) -> Column:
    """The row test of :func:`since` as a Column, for several lookbacks over one scan; ``as_of`` is resolved."""
    if lookback is None:
        return F.lit(True)
    if as_of is None:
        return F.col(ts).isNotNull()
    if isinstance(as_of, Column):
        return F.col(ts) >= as_of - F.expr(f"INTERVAL {seconds(lookback)} SECONDS")
    return F.col(ts) >= F.lit(as_of - dt.timedelta(seconds=seconds(lookback))).cast(df.schema[ts].dataType)


def resolve_as_of(df: DataFrame, as_of=None, ts: str = TS):
    """"Now" as a datetime (or the Column given).

    ``"now"`` is the UTC wall clock (live), a datetime pins it, and None
    replays: the newest event time, one scalar to the driver. On a table
    partitioned by date the newest partition is found from the partition
    column alone, and only that partition's times are scanned. A stream has
    no newest event, so it needs one of the others.
    """
    if isinstance(as_of, str):
        if as_of != "now":
            raise ValueError(f"as_of is a datetime, a Column, 'now' or None, not {as_of!r}")
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)   # UTC wall clock
    if as_of is not None:
        return as_of
    if df.isStreaming:
        raise ValueError("a lookback over a stream needs as_of")
    part = DATE_PARTITIONS.get(ts)
    if part and part in df.columns:
        day = df.agg(F.max(part)).first()[0]
        if day is None:
            return None
        df = df.where(F.col(part) == F.lit(day))
    return df.agg(F.max(ts)).first()[0]


def iso_datetime_text(c: str | Column) -> Column:
    """Datetime as ISO-8601 text with 7 fraction digits and ``Z`` (the
    format the reference's ``strcat`` of a datetime produces)."""
    return F.date_format(col_(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSS'Z'")


def hms(c: str | Column) -> Column:
    return F.date_format(col_(c), "HH:mm:ss")


def minute_boundaries(later: str | Column, earlier: str | Column) -> Column:
    """``datetime_diff('minute', later, earlier)``: minute boundaries crossed."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", col_(earlier)),
                           F.date_trunc("minute", col_(later)))


def day_boundaries(later: str | Column, earlier: str | Column) -> Column:
    """``datetime_diff('day', later, earlier)``: calendar-day boundaries crossed."""
    return F.datediff(F.to_date(col_(later)), F.to_date(col_(earlier))).cast("long")


def above_watermark(cond: Column, ts: str = TS) -> Column:
    """A streaming row filter the optimizer keeps above ``withWatermark``.

    Catalyst pushes predicates that do not reference the event time below
    the watermark operator, so the watermark would only follow the rows
    that pass the filter (a quiet error stream would then hold back its
    metric windows). Referencing the event time keeps the filter above it:
    the watermark follows the whole log stream.
    """
    return F.when(F.col(ts).isNotNull(), cond).otherwise(F.lit(False))
