"""Bounded make_set and the series anomaly model on synthetic data."""

import datetime as dt
import math

from pyspark.sql import functions as F

from auditlens.operators.series import decompose, make_series
from auditlens.operators.sets import attach_sets, bounded_sets


def test_bounded_sets_keep_n_smallest_distinct_nonempty(spark):
    rows = [("hot", f"q{i % 50:03d}") for i in range(5000)] + [("hot", ""), ("hot", None), ("cold", "b"),
                                                                ("cold", "a"), ("cold", "a")]
    df = spark.createDataFrame(rows, "k string, v string")
    out = {r.k: r.s for r in bounded_sets(df, ["k"], [("s", "v", 3)]).collect()}
    assert out == {"hot": ["q000", "q001", "q002"], "cold": ["a", "b"]}


def test_bounded_sets_plan_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").cast("string").alias("v"))
    plan = bounded_sets(df, ["k"], [("s", "v", 3)])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_attach_sets_gives_empty_array_for_groups_without_values(spark):
    df = spark.createDataFrame([("a", ""), ("b", "x")], "k string, v string")
    agg = df.groupBy("k").count()
    out = {r.k: r.s for r in attach_sets(agg, df, ["k"], [("s", "v", 2)]).collect()}
    assert out == {"a": [], "b": ["x"]}


def _metrics(spark, values, server="srv1", start=dt.datetime(2026, 1, 1)):
    rows = [(start + dt.timedelta(minutes=5 * i), server, int(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "Timestamp timestamp, ServerName string, ActivityCount long")


def test_make_series_fills_gaps_with_zero(spark):
    m = _metrics(spark, [5, 7, 9]).where(F.col("ActivityCount") != 7)
    s = make_series(m, lookback=None).orderBy("idx").collect()
    assert [(r.idx, r.v) for r in s] == [(0, 5), (1, 0), (2, 9)]


def test_daily_season_is_learned_and_spike_flagged(spark):
    n = 288 * 3
    vals = [round(50 + 30 * math.sin(2 * math.pi * i / 288) + (i % 7)) for i in range(n)]
    vals[700] += 200
    dec = decompose(make_series(_metrics(spark, vals), lookback=None)).orderBy("idx").collect()
    flagged = [(r.idx, r.anomalies) for r in dec if r.anomalies != 0]
    assert (700, 1) in flagged
    assert len(flagged) < 10
    assert dec[0].period == 288               # the daily season was detected
    assert dec[72].seasonal > 20              # and its profile fitted (peak of the sine)


def test_flat_series_has_no_anomalies(spark):
    dec = decompose(make_series(_metrics(spark, [10] * 600), lookback=None))
    assert dec.where("anomalies != 0").count() == 0


def test_drop_is_negative(spark):
    vals = [100 + (i % 5) for i in range(400)]
    vals[300] = 0
    dec = decompose(make_series(_metrics(spark, vals), lookback=None))
    got = dec.where("anomalies != 0").select("idx", "anomalies").collect()
    assert [(r.idx, r.anomalies) for r in got] == [(300, -1)]


def test_one_pass_aggregation_limits_before_the_shuffle(spark):
    from auditlens.operators.sets import aggregate_with_sets
    df = spark.range(1000).select((F.col("id") % 2).cast("string").alias("k"), F.col("id").cast("string").alias("v"))
    out = aggregate_with_sets(df, ["k"], [("n", "count", None)], [("s", "v", 3)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert {r.k: (r.n, r.s) for r in out.collect()} == {"0": (500, ["0", "10", "100"]), "1": (500, ["1", "101", "103"])}


def test_a_late_server_has_its_own_grid(spark):
    import datetime as dt
    t0 = dt.datetime(2026, 1, 5)
    rows = [(t0 + dt.timedelta(minutes=5 * i), "old", 10) for i in range(100)]
    rows += [(t0 + dt.timedelta(minutes=5 * i), "late", 10) for i in range(90, 95)]
    m = spark.createDataFrame(rows, "Timestamp timestamp, ServerName string, ActivityCount long")
    s = make_series(m, lookback=None)
    assert {r.ServerName: r["count"] for r in s.groupBy("ServerName").count().collect()} == {"old": 100, "late": 5}
    late = s.where("ServerName = 'late'").selectExpr("min(idx) AS i", "min(v) AS v").first()
    assert (late.i, late.v) == (0, 10)


def test_seasons_are_time_spans():
    from auditlens.operators.series import DEFAULT_PERIODS, period_steps
    assert period_steps(DEFAULT_PERIODS, "5m") == (12, 288, 2016)
    assert period_steps(DEFAULT_PERIODS, "1h") == (24, 168)
