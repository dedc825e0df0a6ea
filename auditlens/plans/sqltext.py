"""SQL-text twins of the Column helpers, for the DuckDB oracle queries.

Each function returns a SQL expression with the same semantics as the
Column helper of the same name in ``auditlens.functions.text``.
"""

from __future__ import annotations

from auditlens.functions.text import term_regex


def q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def contains(c: str, needle: str) -> str:
    return f"(strpos(lower({c}), {q(needle.lower())}) > 0)"


def contains_any(c: str, needles) -> str:
    return "(" + " OR ".join(contains(c, n) for n in needles) + ")"


def has_any(c: str, terms) -> str:
    return f"regexp_matches({c}, {q(term_regex(terms))})"


def extract(pattern: str, c: str) -> str:
    return f"regexp_extract({c}, {q(pattern)}, 1)"


def non_empty(c: str) -> str:
    return f"({c} IS NOT NULL AND {c} <> '')"


def empty(c: str) -> str:
    return f"({c} IS NULL OR {c} = '')"


def first_non_empty(*cols: str, default: str | None = None) -> str:
    parts = [f"NULLIF({c}, '')" for c in cols]
    if default is not None:
        parts.append(q(default))
    return "COALESCE(" + ", ".join(parts) + ")"


def in_list(c: str, values) -> str:
    return f"{c} IN (" + ", ".join(q(v) for v in values) + ")"


def label_case(table, default: str, msg: str = "message", code: str = "sqlerrcode") -> str:
    parts = []
    for kind, needle, label in table:
        cond = contains_any(msg, needle) if kind == "msg" else f"starts_with({code}, {q(needle)})"
        parts.append(f"WHEN {cond} THEN {q(label)}")
    return "CASE " + " ".join(parts) + f" ELSE {q(default)} END"


def severity(m: str, high, critical, medium: str = "MEDIUM", low=None, low_label: str = "LOW") -> str:
    s = f"CASE WHEN {m} > {critical} THEN 'CRITICAL' WHEN {m} > {high} THEN 'HIGH' "
    if low is not None:
        return s + f"WHEN {m} > {low} THEN {q(medium)} ELSE {q(low_label)} END"
    return s + f"ELSE {q(medium)} END"


def bin_ts(c: str, secs: int) -> str:
    return f"time_bucket(INTERVAL '{int(secs)} seconds', {c}, TIMESTAMP '1970-01-01 00:00:00')"


def iso_datetime_text(c: str) -> str:
    return f"(strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') || '0Z')"


def hms(c: str) -> str:
    return f"strftime({c}, '%H:%M:%S')"


def set_n(value: str, n: int | None, order_only: bool = False) -> str:
    """``make_set(value, n)``: sorted distinct non-empty values, first n."""
    agg = (f"list_sort(list_distinct(list({value}) FILTER (WHERE {value} IS NOT NULL AND {value} <> '')))")
    if n is None:
        return agg
    return f"list_slice({agg}, 1, {int(n)})"


def set_text(value: str, n: int | None, sep: str = ", ") -> str:
    return f"COALESCE(array_to_string({set_n(value, n)}, {q(sep)}), '')"
