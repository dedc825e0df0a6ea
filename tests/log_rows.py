"""Literal log rows of the tests."""

from __future__ import annotations

import datetime as dt

T0 = dt.datetime(2026, 1, 5, 10, 0, 0)


def row(ts, message, level="LOG", code="00000", pid=100, backend="client backend", server="srv1",
        category="PostgreSQLLogs"):
    return (ts, message, level, code, pid, backend, server, category)


def audit(seq, cls, stmt, obj_type="", obj="", query="select 1"):
    return f"AUDIT: SESSION,{seq},1,{cls},{stmt},{obj_type},{obj},{query},<not logged>"


def conn(user="alice", db="shop", host="10.0.0.7"):
    return f"connection authorized: user={user} database={db} host={host} application_name=psql"
