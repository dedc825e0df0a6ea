"""Time-series baseline and anomaly scoring (D8, D8b), all native Spark.

``make_series``   dense per-key series on a fixed step, zeros where no
                  metric row exists (each key from its own first to its
                  own last bucket).
``pack_series`` / ``expand_series``  the same series as one row per key with
                  array columns, and back (a parallel ``mv-expand``).
``decompose``     per key: linear trend (``regr_slope``/``regr_intercept``
                  on the position), seasonality chosen by the lag
                  autocorrelation of the detrended series at candidate
                  periods (``lag`` + ``corr``), seasonal profile = mean of
                  the detrended value per slot, baseline = trend + seasonal,
                  residual scored with Tukey-style fences on its 10th and
                  90th percentiles: above p90 the score is
                  (r - p90) / (p90 - p10), below p10 (r - p10) / (p90 - p10),
                  else 0; a point is an anomaly (+1/-1) when |score| exceeds
                  the threshold.

``fit_baseline`` stores what ``decompose`` has learned, one row per key (trend,
period, seasonal means by slot, fences); ``score_baseline`` scores new points
with it, in a batch or a stream, by the same formulas.

Every step is a groupBy or a window keyed by the series key; a key's
series is bounded by lookback / step points (2,016 for 7 days of 5-minute
buckets), never by the raw data volume, because the input is the
pre-aggregated metric table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlens.config import shared_dir
from auditlens.functions.text import is_not_empty
from auditlens.functions.timefn import bin_ts, resolve_as_of, seconds, since

# Candidate seasons, as time spans: they mean the same whatever the step is.
DEFAULT_PERIODS = ("1h", "1d", "7d")


def period_steps(periods, step) -> tuple[int, ...]:
    """Spans -> whole numbers of steps; a span under two steps is no season."""
    n = (seconds(p) // seconds(step) for p in periods)
    return tuple(x for x in n if x >= 2)


def make_series(metrics: DataFrame, *, as_of=None, lookback="7d", step="5m", value="ActivityCount",
                by="ServerName", ts="Timestamp") -> DataFrame:
    """(by, ts, idx, v): ``make-series sum(value) default=0 on ts step s by key``.

    Every key has its own grid, from its first to its last bucket: a server
    that joined late gets no leading zeros that would bend its trend.
    """
    df = since(metrics, as_of, lookback, ts=ts).where(is_not_empty(by))
    s = df.groupBy(by, bin_ts(ts, step).alias(ts)).agg(F.sum(value).cast("long").alias("v"))
    step_iv = F.expr(f"INTERVAL {seconds(step)} SECONDS")
    ends = s.groupBy(by).agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    grid = ends.select(by, F.posexplode(F.sequence("lo", "hi", step_iv)).alias("idx", ts))
    return (grid.join(s, [by, ts], "left")
            .select(by, ts, F.col("idx").cast("long").alias("idx"), F.coalesce("v", F.lit(0)).alias("v")))


def pack_series(points: DataFrame, values=("v",), *, by="ServerName", ts="Timestamp") -> DataFrame:
    """One row per key: ``ts`` and each of ``values`` as arrays in order of time.

    For dense series and other rows whose number per key is bounded by
    lookback / step; a key's points become one row. Arrays of a key have one length:
    a NULL value keeps its place.
    """
    packed = points.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(ts, *values))).alias("__points"))
    return packed.select(by, *[F.col("__points").getField(c).alias(c) for c in (ts, *values)])


def expand_series(packed: DataFrame, columns, *, types: dict[str, str] | None = None) -> DataFrame:
    """Parallel ``mv-expand``: the arrays ``columns`` are unfolded together, place by place.

    The other columns repeat. A shorter array gives NULL in its missing places; a NULL array
    counts as empty; a row whose arrays are all empty gives no row. ``types`` casts
    unfolded columns (``to typeof()``). It is a generator on the row: no shuffle.
    """
    types = types or {}
    whole = packed.withColumns({c: F.coalesce(F.col(c), F.array().cast(packed.schema[c].dataType)) for c in columns})
    rest = [c for c in packed.columns if c not in columns]
    out = whole.select(*rest, F.inline(F.arrays_zip(*columns)))
    return out.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in out.columns])


def decompose_packed(packed: DataFrame, *, value="v", by="ServerName", ts="Timestamp", **options) -> DataFrame:
    """Packed dense series with the arrays anomalies, score and baseline beside ``ts`` and ``value``
    (``options`` as in :func:`decompose`, which does the work on the points)."""
    at = packed.select(by, ts, F.col(value).alias("v"),
                       F.transform(value, lambda _, i: i.cast("long")).alias("idx"))
    scored = decompose(expand_series(at, [ts, "idx", "v"]), by=by, **options)
    out = pack_series(scored, ("v", "anomalies", "score", "baseline"), by=by, ts=ts)
    return out.withColumnRenamed("v", value)


def _clean(c):
    return F.when(c.isNull() | F.isnan(c), F.lit(0.0)).otherwise(c)


def _corr(x: str, y: str):
    """Pearson correlation over rows where both are present; NULL (not an
    error) when either side has no variance -- a flat series has no season."""
    both = F.col(y).isNotNull()
    xs = F.when(both, F.col(x))
    return F.try_divide(F.covar_pop(xs, F.col(y)), F.stddev_pop(xs) * F.stddev_pop(F.col(y)))


def _score(resid: str, q10: str, q90: str) -> Column:
    """How far a residual lies outside its fences, in units of their distance."""
    r, lo, hi = F.col(resid), F.col(q10), F.col(q90)
    return (F.when(hi - lo <= 0, F.lit(0.0)).when(r > hi, (r - hi) / (hi - lo))
            .when(r < lo, (r - lo) / (hi - lo)).otherwise(F.lit(0.0)))


def _flagged(df: DataFrame, threshold: float) -> DataFrame:
    df = df.withColumn("score", _score("resid", "q10", "q90"))
    return df.withColumn("anomalies", F.when(F.abs("score") > threshold, F.signum("score")).otherwise(F.lit(0.0))
                         .cast("int"))


def decompose(series: DataFrame, *, threshold=1.5, periods=DEFAULT_PERIODS, step="5m", min_corr=0.6,
              min_cycles=2, by="ServerName", materialize: bool = True) -> DataFrame:
    """Adds trend, seasonal, baseline, residual, score and anomalies (+1/0/-1)."""
    r = _fitted(series, periods, step, min_corr, min_cycles, by, materialize)
    return _flagged(r, threshold).drop("slope", "icpt", "n", "d", "slot", "q10", "q90")


def fit_baseline(metrics: DataFrame, *, as_of=None, lookback="7d", step="5m", periods=DEFAULT_PERIODS, min_corr=0.6,
                 min_cycles=2, by="ServerName", ts="Timestamp") -> DataFrame:
    """The baseline model of every key: origin (time of position 0), slope, icpt, period in
    steps (0: no season), slots (mean of the detrended value by slot), q10 and q90 (fences of
    the residual), n (points fitted). A small table, to be stored and fitted again as often as wanted."""
    series = make_series(metrics, as_of=as_of, lookback=lookback, step=step, by=by, ts=ts)
    r = _fitted(series, periods, step, min_corr, min_cycles, by, True)
    slots = F.array_sort(F.collect_set(F.when(F.col("period") > 0, F.struct("slot", "seasonal"))))
    same = [F.max(c).alias(c) for c in ("slope", "icpt", "period", "q10", "q90", "n")]   # constant within a key
    return r.groupBy(by).agg(F.min(ts).alias("origin"), *same,
                             F.transform(slots, lambda s: s["seasonal"]).alias("slots"))


def score_baseline(points: DataFrame, model: DataFrame, *, threshold=1.5, step="5m", by="ServerName",
                   ts="Timestamp", value="v") -> DataFrame:
    """``points`` (by, ts, value) of the keys the model knows, with baseline, resid, score and
    anomalies. Points need not be those of the fit: the trend goes on, the season repeats."""
    m = model.withColumn("origin", F.col("origin").cast(points.schema[ts].dataType))
    x = points.join(m, by)
    idx = F.floor(F.timestamp_diff("SECOND", F.col("origin"), F.col(ts)) / seconds(step))
    slot = F.when(F.col("period") > 0, F.pmod(idx, F.col("period"))).cast("int")
    seasonal = F.coalesce(F.get("slots", slot), F.lit(0.0))
    x = x.withColumn("baseline", F.col("icpt") + F.col("slope") * idx + seasonal)
    x = x.withColumn("resid", F.col(value) - F.col("baseline"))
    return _flagged(x, threshold).select(*points.columns, "baseline", "resid", "score", "anomalies")


def _fitted(series: DataFrame, periods, step, min_corr, min_cycles, by: str, materialize: bool) -> DataFrame:
    """``series`` with what is fitted per key beside every point.

    The dense series feeds five branches (trend, autocorrelation, seasonal
    profile, quantiles, scoring). With ``materialize`` it is written once to
    the session's shared checkpoint folder (a reliable checkpoint: lineage
    cut, survives executor loss) instead of being recomputed per branch;
    its size is keys x lookback/step, independent of the raw log volume.

    A season is a candidate for series of at least ``min_cycles`` of it, so
    the weekly one needs a lookback of two weeks.
    """
    periods = period_steps(periods, step)
    if materialize:
        shared_dir(series.sparkSession)          # makes sure a checkpoint folder is set
        series = series.checkpoint(eager=True)
    tr = series.groupBy(by).agg(F.regr_slope("v", "idx").alias("slope"),
                                F.regr_intercept("v", "idx").alias("icpt"),
                                F.avg("v").alias("vbar"), F.count(F.lit(1)).alias("n"))
    tr = tr.select(by, F.coalesce("slope", F.lit(0.0)).alias("slope"),
                   F.coalesce("icpt", F.col("vbar")).alias("icpt"), "n")
    d = (series.join(tr, by)
         .withColumn("trend", F.col("icpt") + F.col("slope") * F.col("idx"))
         .withColumn("d", F.col("v") - F.col("trend")))

    w = Window.partitionBy(by).orderBy("idx")
    lagged = d.select(by, "d", "n", *[F.lag("d", p).over(w).alias(f"l{p}") for p in periods])
    ac = lagged.groupBy(by).agg(F.max("n").alias("n"), *[_corr("d", f"l{p}").alias(f"c{p}") for p in periods])
    # usable correlation per candidate: needs whole cycles; NULL/NaN -> 0
    cv = {p: F.when(F.col("n") >= min_cycles * p, _clean(F.col(f"c{p}"))).otherwise(F.lit(0.0)) for p in periods}
    choice = None
    for i, p in enumerate(periods):
        best = F.lit(True)
        for q in periods[i + 1:]:
            best = best & (cv[p] >= cv[q])
        cond = best & (cv[p] >= min_corr)
        choice = F.when(cond, F.lit(p)) if choice is None else choice.when(cond, F.lit(p))
    per = ac.select(by, choice.otherwise(F.lit(0)).alias("period"))

    dp = d.join(per, by).withColumn("slot", F.when(F.col("period") > 0, F.col("idx") % F.col("period")))
    seas = dp.where(F.col("period") > 0).groupBy(by, "slot").agg(F.avg("d").alias("seasonal"))
    r = (dp.join(seas, [by, "slot"], "left")
         .withColumn("seasonal", F.coalesce("seasonal", F.lit(0.0)))
         .withColumn("baseline", F.col("trend") + F.col("seasonal"))
         .withColumn("resid", F.col("v") - F.col("baseline")))
    q = r.groupBy(by).agg(F.percentile("resid", 0.1).alias("q10"), F.percentile("resid", 0.9).alias("q90"))
    return r.join(q, by)


def series_anomalies(metrics: DataFrame, *, as_of=None, lookback="7d", report="1h", step="5m",
                     threshold=1.5, ts="Timestamp") -> DataFrame:
    """Flagged points of the activity series inside the report window."""
    if lookback is not None or report is not None:
        as_of = resolve_as_of(metrics, as_of, ts)
    s = make_series(metrics, as_of=as_of, lookback=lookback, step=step, ts=ts)
    dec = decompose(s, threshold=threshold, step=step)
    dec = dec.where(F.col("anomalies") != 0)
    dec = since(dec, as_of, report, ts=ts)
    return dec.select(F.col(ts).alias("TimeGenerated"), "ServerName", "v", "baseline", "score", "anomalies",
                      F.round("score", 2).alias("DeviationScore"))


def baseline_deviation(metrics: DataFrame, *, as_of=None, lookback="7d", report="1h", step="5m",
                       threshold=1.5, high=2.0, critical=3.0, top=20) -> DataFrame:
    """ML baseline deviation, top ``top`` by |score| in the report window."""
    a = series_anomalies(metrics, as_of=as_of, lookback=lookback, report=report, step=step, threshold=threshold)
    out = a.select(
        "TimeGenerated", F.lit("ML Baseline Deviation").alias("AnomalyType"),
        F.when(F.col("anomalies") > 0, "Above Normal").otherwise("Below Normal").alias("AnomalyDirection"),
        F.when(F.abs("score") > critical, "CRITICAL").when(F.abs("score") > high, "HIGH")
        .otherwise("MEDIUM").alias("Severity"),
        "ServerName", F.col("v").alias("ActivityCount"),
        F.round("baseline", 0).alias("ExpectedBaseline"), "DeviationScore")
    return out.orderBy(F.desc(F.abs("DeviationScore")), "ServerName", "TimeGenerated").limit(top)


def baseline_deviation_pct(metrics: DataFrame, *, as_of=None, lookback="7d", report="24h", step="5m",
                           threshold=1.5, top=20) -> DataFrame:
    """The same model graded 1.5/2.5/3.5 with the deviation in percent."""
    a = series_anomalies(metrics, as_of=as_of, lookback=lookback, report=report, step=step, threshold=threshold)
    sc = F.abs("score")
    out = a.select(
        F.col("TimeGenerated").alias("Timestamp"), "ServerName", F.col("v").alias("Activity"),
        F.round("baseline", 0).alias("Baseline"),
        F.round(F.try_divide(F.abs(F.col("v") - F.col("baseline")) * 100, F.col("baseline")), 1)
        .alias("DeviationPercent"),
        F.when(F.col("anomalies") > 0, "Activity Spike").otherwise("Activity Drop").alias("Direction"),
        F.when(sc > 3.5, "CRITICAL").when(sc > 2.5, "HIGH").when(sc > 1.5, "MEDIUM").otherwise("LOW")
        .alias("Severity"),
        F.col("DeviationScore").alias("AnomalyScore"), sc.alias("_abs"))
    return out.orderBy(F.desc("_abs"), "ServerName", "Timestamp").limit(top).drop("_abs")
