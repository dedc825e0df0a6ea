"""The as-of session lookup against a plain loop, ties, NULLs and a backend that reconnects all the time."""

from __future__ import annotations

import datetime as dt
import random

from log_rows import T0, audit, conn, row

from auditlens.functions.timefn import TS
from auditlens.operators.sessions import session_asof

S1 = dt.timedelta(seconds=1)


def found(df):
    return sorted(((r.LogicalServerName, r.processId, r[TS], r.AsOfUser) for r in df.collect()), key=str)


def by_loop(rows):
    out = []
    for ts, msg, _, _, pid, _, srv, _ in rows:
        if "AUDIT" in msg:
            before = [(c[0], c[1].split("user=")[1].split()[0]) for c in rows if "user=" in c[1] and c[6] == srv and c[4] == pid
                      and None not in (ts, c[0], pid) and c[0] <= ts]
            out.append((srv, pid, ts, max(before)[1] if before else None))
    return sorted(out, key=str)


def test_against_a_loop(mk):
    rnd = random.Random(5)
    rows = [row(T0 + rnd.randrange(0, 7200) * S1, rnd.choice([conn(f"u{rnd.randrange(9)}"), audit(i, "READ", "SELECT")]),
                pid=rnd.choice([1, 1, 1, 2, 3]), server=rnd.choice(["a", "b"])) for i in range(400)]
    rows += [row(T0, conn("tie1"), pid=9), row(T0, conn("tie2"), pid=9), row(T0, audit(1, "READ", "SELECT"), pid=9),
             row(T0 - S1, audit(1, "READ", "SELECT"), pid=9), row(None, audit(1, "READ", "SELECT"), pid=9),
             row(None, conn("never"), pid=9), row(T0, conn("nil"), pid=None), row(T0 + S1, audit(1, "READ", "SELECT"), pid=None),
             row(T0 + dt.timedelta(days=40), audit(1, "READ", "SELECT"), pid=9)]
    log = mk(rows)
    events = log.where("message LIKE 'AUDIT%'").select(TS, "LogicalServerName", "processId")
    want = by_loop(rows)
    for bucket in ("10 minutes", "1 day", "7 seconds"):
        assert found(session_asof(events, log, bucket=bucket)) == want


def test_columns_repeated_rows_and_nothing(mk):
    log = mk([row(T0, conn(), pid=1)] + [row(T0 + S1, audit(1, "READ", "SELECT"), pid=1)] * 3)
    out = session_asof(log.where("message LIKE 'AUDIT%'"), log)
    assert out.columns == [*log.columns, "AsOfUser", "AsOfDatabase", "AsOfHost"]
    assert [(r.AsOfUser, r.AsOfDatabase, r.AsOfHost) for r in out.collect()] == [("alice", "shop", "10.0.0.7")] * 3
    assert session_asof(mk([]), log).count() == 0 and session_asof(log, mk([])).where("AsOfUser IS NULL").count() == 4


def test_no_product_of_events_and_reconnects(spark, mk):
    """3,000 reconnects and 3,000 events of one backend in one bucket: no operator makes more rows than both."""
    rows = [row(T0 + i * dt.timedelta(milliseconds=100), conn(f"u{i}") if i % 2 else audit(i, "READ", "SELECT"), pid=1)
            for i in range(6000)]
    log = mk(rows)
    out = session_asof(log.where("message LIKE 'AUDIT%'").select(TS, "LogicalServerName", "processId"), log)
    got = out.collect()
    assert len(got) == 3000 and sum(r.AsOfUser is None for r in got) == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ">= " not in "".join(x for x in plan.splitlines() if "Join" in x)
