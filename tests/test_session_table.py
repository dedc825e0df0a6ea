"""The stored session table equals the lookup derived from the log."""

from __future__ import annotations

import datetime as dt

import pytest
from log_rows import T0, audit, conn, row

from auditlens.operators.alerts import anomalies_union
from auditlens.operators.session_table import read_session_spans, session_spans, sessions_at, write_session_spans
from auditlens.operators.sessions import CONN_TERMS_AUTHORIZED, session_info

H1 = dt.timedelta(hours=1)


def log_rows():
    """A reused backend, received-only lines with a user, lines without one, on both sides of a 24 h limit."""
    return [row(T0, conn("alice"), pid=1), row(T0 - 24 * H1, conn("zoe", "old", "h9"), pid=1),
            row(T0 - 25 * H1, conn("zzz", "older", "h8"), pid=1), row(T0 - 24 * H1 - dt.timedelta(microseconds=1), conn("yyy"), pid=2),
            row(T0 - H1, "connection received: host=10.0.0.8 user=rick", pid=3), row(T0, "connection received: host=10.0.0.8", pid=4),
            row(T0, conn("bob"), pid=1, server="srv2"), row(T0, conn("nil"), pid=None), row(None, conn("timeless"), pid=5),
            row(T0, audit(1, "READ", "SELECT", query="select user=eve"), pid=6)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("lookback", [None, "24h", "1h"])
@pytest.mark.parametrize("terms", [("connection authorized", "connection received"), CONN_TERMS_AUTHORIZED])
def test_table_equals_lookup(mk, lookback, terms):
    from auditlens.operators.sessions import CONN_TERMS_ALL
    terms = CONN_TERMS_AUTHORIZED if terms == CONN_TERMS_AUTHORIZED else CONN_TERMS_ALL
    log = mk(log_rows())
    want = rows(session_info(log, T0, lookback, terms))
    assert want and rows(sessions_at(session_spans(log), T0, lookback, terms)) == want


def test_batches_add_up_and_a_repeated_one_counts_once(spark, mk, tmp_path):
    path, all_rows = str(tmp_path / "spans"), log_rows()
    assert sessions_at(read_session_spans(spark, path), lookback=None).count() == 0
    write_session_spans(mk([]), path, "b0")
    for name, part in (("b1", all_rows[:4]), ("b2", all_rows[4:]), ("b2", all_rows[4:])):
        write_session_spans(mk(part), path, name)
    table = read_session_spans(spark, path)
    assert sum(r.Connections for r in table.collect()) == 8
    assert rows(sessions_at(table, T0, "24h")) == rows(session_info(mk(all_rows), T0, "24h"))
    plan = sessions_at(table, T0, "24h")._jdf.queryExecution().executedPlan().toString()
    assert "session_date" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_a_busy_backend_is_one_row_an_hour(spark, mk):
    log = mk([row(T0 + dt.timedelta(seconds=i), conn(), pid=1) for i in range(3000)])
    assert [(r.Connections, r.LastSeen - r.FirstSeen) for r in session_spans(log).collect()] == [
        (3000, dt.timedelta(seconds=2999))]


def test_feed_with_stored_sessions_is_the_same(spark, mk, tmp_path):
    attack = [row(T0 + dt.timedelta(seconds=i), audit(i, "WRITE", "DELETE", "TABLE", f"sales.t{i}", "delete from t"), pid=1)
              for i in range(12)]
    attack += [row(T0 + dt.timedelta(seconds=i), audit(i, "READ", "SELECT", "TABLE", f"{s}.t", "select 1"), pid=3)
               for i, s in enumerate(("a", "b", "c", "d", "e", "f"))]
    log = mk(log_rows()[:8] + attack)
    path = str(tmp_path / "spans")
    write_session_spans(log, path)
    def feed(**kw):
        return rows(anomalies_union(log, as_of=T0 + dt.timedelta(seconds=30), **kw).drop("Details"))
    want = feed()
    assert {r[1] for r in want} >= {"Mass Destructive Operations"}
    assert feed(spans=read_session_spans(spark, path)) == want


def test_other_terms_are_refused(mk):
    with pytest.raises(ValueError, match="authorized"):
        sessions_at(session_spans(mk([])), lookback=None, terms=("x",))
