"""Streams that see new sessions, keep bounded sets, route bursts once and know the baseline.
Each replay lands in several micro-batches with a restart in between."""

import datetime as dt
import os
import random

import pytest
from log_rows import T0, audit, conn, row
from pyspark.sql import functions as F

from auditlens.functions.timefn import TS
from auditlens.operators import alerts as A
from auditlens.operators import detectors as D
from auditlens.operators import series as SR
from auditlens.operators.sessions import session_info
from auditlens.sources.bronze import BRONZE_SCHEMA
from auditlens.streaming import alert_stream as AS
from auditlens.streaming import detector_state as ST
from auditlens.streaming import detector_stream as DS
from auditlens.streaming.session_stream import connection_stream, session_enrich_stream
from auditlens.streaming.sources import bronze_stream, write_heartbeat


def sec(n):
    return dt.timedelta(seconds=n)


def land(spark, hub, part, rows):
    spark.createDataFrame(rows, BRONZE_SCHEMA).coalesce(1).write.json(os.path.join(hub, f"p{part}"))


def replay(spark, tmp, parts, query):
    """Rows of an append-mode query; every part is a run of its own from one checkpoint."""
    hub, out, ck = str(tmp / "in"), str(tmp / "out"), str(tmp / "ck")
    for k, rows in enumerate([*parts, None]):
        if rows is None:
            write_heartbeat(spark, os.path.join(hub, f"p{k}"), max(r[0] for p in parts for r in p) + dt.timedelta(days=3))
        else:
            land(spark, hub, k, rows)
        q = (query(bronze_stream(spark, hub + "/*")).writeStream.format("parquet").option("checkpointLocation", ck)
             .trigger(availableNow=True).start(out))
        q.awaitTermination()
    return spark.read.parquet(out)


def update(t, pid, table="a.b"):
    return row(t, audit(1, "WRITE", "UPDATE", "TABLE", table, f"update {table}"), pid=pid)


SESSIONS = [
    [row(T0, conn("alice"), pid=1), *[update(T0 + sec(5 * i), 1) for i in range(4)]],
    # opened after the start; equal lines; a backend without session; a backend that connects anew
    [row(T0 + sec(50), conn("bob", "hr", "10.1.1.1"), pid=2), *[update(T0 + sec(101), 2)] * 3, update(T0 + sec(102), 3),
     row(T0 + sec(103), conn("carol"), pid=1), update(T0 + sec(104), 1), update(T0 + sec(49), 2)],
    # a connection 25 hours old no longer counts
    [update(T0 + dt.timedelta(hours=25), 2), row(T0 + dt.timedelta(hours=25), conn("dave"), pid=4),
     update(T0 + dt.timedelta(hours=25), 4)],
]


def test_lines_find_the_newest_session_of_the_stream(spark, tmp_path):
    def lines(stream):
        from auditlens.functions.timefn import above_watermark
        events = D.destructive_lines(stream.withWatermark(TS, "10 minutes"), wrap=above_watermark)
        return session_enrich_stream(events, connection_stream(stream)).select(
            TS, "processId", "FinalUser", "FinalDatabase", "FinalHost")
    got = sorted((r[0], *r[1:]) for r in replay(spark, tmp_path, SESSIONS, lines).collect())
    alice, bob, none = ("alice", "shop", "10.0.0.7"), ("bob", "hr", "10.1.1.1"), ("UNKNOWN",) * 3
    carol, dave = ("carol", *alice[1:]), ("dave", *alice[1:])
    day = dt.timedelta(hours=25)
    want = [*[(T0 + sec(5 * i), 1, *alice) for i in range(4)], (T0 + sec(49), 2, *none), *[(T0 + sec(101), 2, *bob)] * 3,
            (T0 + sec(102), 3, *none), (T0 + sec(104), 1, *carol), (T0 + day, 2, *none), (T0 + day, 4, *dave)]
    assert got == sorted(want)


def test_a_backend_that_connects_often(spark):
    """Every line finds its newest connection, and lines times connections are not formed."""
    from auditlens.streaming.session_stream import session_candidates
    rng, us = random.Random(3), dt.timedelta(microseconds=1)
    day, at = 86400, lambda s: T0 + dt.timedelta(seconds=s)
    conns = [(1, at(rng.randrange(2 * day))) for _ in range(600)] + [(2, at(5)), (3, at(3600)), (3, at(7200))]
    conns += [(1, conns[0][1]), (2, at(day + 9000))]
    lines = [(1, at(rng.randrange(2 * day))) for _ in range(300)] + [(p, c[1]) for p, c in enumerate(conns[600:603], 1)]
    lines += [(p, t + k * us) for p, t in ((2, at(day + 5)), (2, at(5)), (3, at(3600)), (3, at(7200)), (3, at(day + 7200)))
              for k in (-1, 0, 1)] + [(4, at(0)), (None, at(1))]
    c = spark.createDataFrame([("s\x1f%d" % p, t, f"u{i}", "d", "h") for i, (p, t) in enumerate(conns)],
                              "conn_backend string, ConnTime timestamp, User string, Database string, SourceHost string")
    e = spark.createDataFrame([(t, p, "s", "", "", "", i) for i, (p, t) in enumerate(lines)],
                              f"{TS} timestamp, processId long, LogicalServerName string, DirectUser string, "
                              "DirectDatabase string, DirectHost string, n long")
    got = {r.n: r.FinalUser for r in session_enrich_stream(e, c).collect()}
    for i, (p, t) in enumerate(lines):
        near = [(ct, f"u{k}") for k, (cp, ct) in enumerate(conns) if cp == p and t - dt.timedelta(days=1) <= ct <= t]
        assert got[i] == (max(near)[1] if near else "UNKNOWN")
    assert len(got) == len(lines)
    met = session_candidates(e.withColumn("LineId", F.col("n")), c)
    assert met.count() < 26 * len(lines)         # each line with every connection of a day before it: some 60,000


def test_live_detectors_equal_the_batch(spark, mk, tmp_path):
    """D2 and D4 over three micro-batches: sessions that open late, no user left UNKNOWN."""
    parts = [[row(T0, conn("alice"), pid=1), *[update(T0 + sec(i), 1) for i in range(4)]],
             [row(T0 + sec(60), conn("bob"), pid=2), *[update(T0 + sec(61 + i), 2, f"s.t{i}") for i in range(9)],
              *[row(T0 + sec(70 + i), audit(1, "ROLE", "GRANT", "", "", "GRANT r TO u"), pid=2) for i in range(4)]],
             [row(T0 + sec(4000), conn("eve"), pid=3),
              *[row(T0 + sec(4001 + i), audit(1, "ROLE", "REVOKE", "", "", "REVOKE r FROM u"), pid=3) for i in range(2)]]]
    log = mk([r for p in parts for r in p])
    for live, batch in ((DS.destructive_ops_live, D.destructive_ops), (DS.privilege_escalation_live, D.privilege_escalation)):
        got = replay(spark, tmp_path / batch.__name__, parts, live)
        want = batch(log, lookback=None, session_lookback=None)
        assert want.count() and "UNKNOWN" not in {r.User for r in got.collect()}
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


# ------------------------------------------------------------------ mergeable state
def busy_log():
    """Every detector fires; sessions open late; samples and tables exceed their caps."""
    rows, t = [], T0
    for pid, user in ((1, "alice"), (2, "bob"), (3, "azuresu")):
        at = t + sec(400 if pid == 2 else 0)     # bob's session is logged after his first lines
        rows.append(row(at, conn(user, f"db{pid}", f"10.0.0.{pid}"), pid=pid))
        for i in range(40):
            rows.append(row(t + sec(10 * i + pid), audit(
                i, "READ", "SELECT", f"TABLE{i % 14}", f"s{i % 9}.t{i % 5}", f"select {i:02d}"), pid=pid))
            rows.append(update(t + sec(10 * i + pid), pid, f"x.t{i % 4}"))
            rows.append(row(t + sec(5 * i), f'relation "r{i}" does not exist', level="ERROR", code="42P01", pid=pid))
        for i in range(7):
            rows.append(row(t + sec(100 * i), audit(1, "ROLE", "GRANT", "", "", f"GRANT r{i} TO u"), pid=pid))
            rows.append(row(t + sec(9 * i), audit(1, "READ", "SELECT", "", "", f"SELECT {i} FROM pg_catalog.pg_class"), pid=pid))
            rows.append(row(t + sec(8 * i), audit(1, "READ", "SELECT", "", "", f"SELECT {i} FROM pg_catalog.pg_roles"), pid=pid))
    for i in range(30):
        rows.append(row(t + sec(3 * i), f'password authentication failed for user "x" user=u{i % 13} host=10.9.9.9 database=d{i % 7}',
                        level="FATAL", code="28P01", pid=500 + i, backend=""))
    return rows


BATCH = {"exfiltration": D.exfiltration, "destructive_ops": D.destructive_ops, "error_spike": D.error_spike,
         "privilege_escalation": D.privilege_escalation, "cross_schema_recon": D.cross_schema_recon,
         "deep_schema_enum": D.deep_schema_enum, "brute_force": D.brute_force}


def plain(df):
    return sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def state(spark, tmp_path_factory):
    """The log in three micro-batches of mixed times, folded after the second one."""
    tmp = tmp_path_factory.mktemp("state")
    hub, rows = str(tmp / "in"), busy_log()
    emitted = []
    for k in range(3):
        land(spark, hub, k, rows[k::3])
        ST.start_detector_state(bronze_stream(spark, hub + "/*"), str(tmp / "state"), str(tmp / "ck"), fold_every=2,
                                emit=lambda name, df, b: emitted.append((name, b, df.count())),
                                trigger={"availableNow": True}).awaitTermination()
    return str(tmp / "state"), emitted


@pytest.mark.parametrize("name", list(BATCH))
def test_state_equals_the_batch_detector(spark, mk, state, name):
    """All columns and the open windows, whatever the order in which lines and sessions came."""
    log, kind = mk(busy_log()), ST.KINDS[name]
    once = {} if name == "brute_force" else {"session_lookback": None}
    whole = dict(once, lookback=None) if name == "brute_force" else dict(once, lookback=None, bucket=None)
    want = BATCH[name](log, **whole)
    got = ST.detector_table(spark, state[0], name, session_lookback=None, windowed=False)
    assert want.count() > 0 and set(got.columns) == set(want.columns)
    assert plain(got) == plain(want)
    if name != "brute_force":
        want = BATCH[name](log, lookback=None, bucket=kind.bucket, **once)
        for lookback in (None, "24h"):
            assert plain(ST.detector_table(spark, state[0], name, session_lookback=lookback)) == plain(want)


def test_every_batch_hands_on_the_rows_it_touched(state):
    names = {name for name, _, n in state[1] if n}
    assert names == set(BATCH) and {b for _, b, _ in state[1]} == set(range(3))


def test_a_batch_run_again_changes_nothing(spark, state):
    before = plain(ST.detector_table(spark, state[0], "error_spike"))
    log = spark.createDataFrame(busy_log()[2::3], BRONZE_SCHEMA)
    ST._store(ST.partial_rows(log, ST.KINDS["error_spike"]), state[0], "error_spike", 2)
    assert plain(ST.detector_table(spark, state[0], "error_spike")) == before


def test_state_forgets_old_windows_and_old_sessions_do_not_reach(spark, tmp_path):
    rows = [row(T0, conn("alice"), pid=1), *[update(T0 + sec(i), 1) for i in range(9)],
            *[update(T0 + dt.timedelta(hours=30, seconds=i), 1) for i in range(9)]]
    path, kind = str(tmp_path), ST.KINDS["destructive_ops"]
    log = spark.createDataFrame(rows, BRONZE_SCHEMA)
    ST._store(ST.session_rows(log), path, "sessions", 0)
    ST._store(ST.partial_rows(log, kind), path, "destructive_ops", 0)
    users = lambda **kw: sorted(r.OperationCount for r in ST.detector_table(spark, path, "destructive_ops", **kw).collect())
    assert users(session_lookback=None) == [9, 9]
    assert users(session_lookback="24h") == [9]          # 30 hours later the session is out of reach
    ST.compact_state(spark, path, ["destructive_ops"], 0, keep="2h", as_of=T0 + dt.timedelta(hours=30))
    assert users(session_lookback=None) == []            # the connection is forgotten, and with it the user


def test_sets_merge_without_gathering_a_key(spark):
    from auditlens.operators.sets import merge_partials
    df = spark.range(2000).selectExpr("id % 2 AS k", "id AS n", "array(concat('v', id % 700), 'w') AS many", "array('x', null) AS few")
    got = merge_partials(df, ["k"], sums=["n"], maxs=["n"][:0], sets=[("many", 4), ("few", None)])
    rows = {r.k: (r.n, r.many, r.few) for r in got.collect()}
    assert rows[0] == (999000, ["v0", "v10", "v100", "v102"], ["x"]) and rows[1][2] == ["x"]


# ------------------------------------------------------------------ bursts, ML rule
def spikes():
    """Errors of srv1 in minutes 0, 1, 2 and 40; exactly five schemas by one backend."""
    rows = [row(T0 + dt.timedelta(minutes=m, seconds=i), "boom", level="ERROR", code="XX000", pid=1)
            for m, n in ((0, 5), (1, 9), (2, 4), (40, 6)) for i in range(n)]
    rows += [row(T0 + sec(10 + i), audit(1, "READ", "SELECT", f"s{i % 5}.t", "x", "q"), pid=7) for i in range(25)]
    return sorted(rows)


def test_a_burst_is_routed_once(spark, tmp_path):
    rows, rules = spikes(), A.rules_df(spark)
    parts = [rows[:20], rows[20:]]     # cut inside a window
    once = replay(spark, tmp_path / "once", parts, lambda s: AS.alert_once_stream(s, rules, quiet="10 minutes"))
    errors = sorted(r.Burst for r in once.where("RuleName = 'Error Spike'").collect())
    assert errors == [T0, T0 + dt.timedelta(minutes=40)]
    assert once.groupBy(*once.columns).count().where("count > 1").count() == 0
    burst = replay(spark, tmp_path / "burst", parts, lambda s: AS.alert_burst_stream(s, rules, quiet="10 minutes"))
    got = sorted(tuple(r) for r in burst.where("RuleName = 'Error Spike'").select(
        "BurstStart", "BurstEnd", "Windows", "PeakValue", "Severity").collect())
    minute = dt.timedelta(minutes=1)
    assert got == [(T0, T0 + 3 * minute, 3, 9.0, "HIGH"), (T0 + 40 * minute, T0 + 41 * minute, 1, 6.0, "MEDIUM")]


def test_schemas_are_counted_exactly(spark, tmp_path):
    out = replay(spark, tmp_path, [spikes()], lambda s: AS.alert_stream(s, A.rules_df(spark)))
    assert [r.MetricValue for r in out.where("RuleName = 'Recon (Schema)'").collect()] == [5.0]


def test_ml_rule_fires_in_the_stream_as_in_the_batch(spark, mk, tmp_path):
    """Six lines every 5 minutes, gaps, and two bursts, in three micro-batches with a restart."""
    rows = []
    for step in range(300):
        n = 0 if step % 50 in (7, 8) else 90 if step in (120, 260) else 5 + step % 3
        rows += [row(T0 + dt.timedelta(minutes=5 * step, seconds=i), "line", pid=1, server=f"srv{step % 2 if step < 2 else 1}")
                 for i in range(n)]
    log, model = mk(rows), str(tmp_path / "model")
    from auditlens.operators.metrics import activity_metrics
    metrics = activity_metrics(log)
    SR.fit_baseline(metrics, lookback=None).write.parquet(model)
    hub, rules = str(tmp_path / "in"), A.rules_df(spark)
    for k, cut in enumerate((0, 500, 1100)):
        land(spark, hub, k, rows[cut:(500, 1100, len(rows))[k]])
        if k == 2:
            write_heartbeat(spark, os.path.join(hub, "hb"), rows[-1][0] + dt.timedelta(days=1))
        AS.start_ml_alerts(bronze_stream(spark, hub + "/*"), model, rules, str(tmp_path / "ml"), str(tmp_path / "ck"),
                           trigger={"availableNow": True}).awaitTermination()
    got = AS.read_ml_alerts(spark, str(tmp_path / "ml"))
    want = A.alert_rules(A.ml_candidates(SR.series_anomalies(metrics, lookback=None, report=None)), rules)
    assert plain(got) == plain(want) and got.count() >= 2


def test_model_scores_what_it_was_fitted_on_as_the_decomposition_does(spark):
    base = dt.datetime(2026, 1, 1)
    pts = [(base + dt.timedelta(minutes=5 * i), "s", 10 + 5 * (i % 12 == 3) + (40 if i == 700 else 0)) for i in range(900)]
    metrics = spark.createDataFrame(pts, "Timestamp timestamp, ServerName string, ActivityCount long")
    series = SR.make_series(metrics, lookback=None)
    columns = ["Timestamp", "v", F.round("baseline", 9).alias("baseline"), F.round("score", 9).alias("score"), "anomalies"]
    want = SR.decompose(series).select(*columns)
    model = SR.fit_baseline(metrics, lookback=None)
    assert model.first().period in (12, 288) and len(model.first().slots) == model.first().period
    got = SR.score_baseline(series, model).select(*columns)
    assert plain(got) == plain(want) and got.where("anomalies <> 0").count() > 0
    later = spark.createDataFrame([(base + dt.timedelta(minutes=5 * 1203), "s", 15), (base - dt.timedelta(minutes=5 * 285), "s", 15),
                                   (base, "new", 1)], "Timestamp timestamp, ServerName string, v long")
    scored = SR.score_baseline(later, model).collect()       # the season goes on, before and after; unknown keys have no score
    assert [r.anomalies for r in scored] == [0, 0] and abs(scored[0].baseline - 15) < 1


def test_dense_steps_fill_gaps(spark):
    at = lambda i: T0 + dt.timedelta(minutes=5 * i)
    rows = spark.createDataFrame([("a", at(3), 2), ("a", at(5), 1), ("b", at(1), 7)], "ServerName string, Timestamp timestamp, v long")
    last = spark.createDataFrame([("a", at(1))], "ServerName string, last_step timestamp")
    got = sorted(tuple(r) for r in AS.dense_steps(rows, last).collect())
    assert got == [("a", at(2), 0), ("a", at(3), 2), ("a", at(4), 0), ("a", at(5), 1), ("b", at(1), 7)]
    assert AS.dense_steps(rows, None).count() == 4


def test_sessions_of_the_batch_are_those_of_the_state(spark, mk):
    log = mk(busy_log())
    want = plain(session_info(log, lookback=None))
    got = ST.session_rows(log).groupBy("processId", "LogicalServerName").agg(*[F.max(f).alias(f) for f in ST.ALL_FIELDS])
    assert plain(got) == want
