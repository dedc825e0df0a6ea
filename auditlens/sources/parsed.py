"""The parsed log: message fields and term flags, computed once at ingest.

``write_bronze`` stores every column of ``EXPRESSIONS`` next to the raw log, so
queries test booleans and read short fields instead of running the same regular
expressions over every message again. ``stored(df, name)`` is the stored column
where ``df`` has it and the very expression it was computed by where it has not
(raw rows, streams): results are the same either way.

Only tables written by ``write_bronze`` carry the columns, and all their files do
(``read_bronze(normalized=True)``); an append to an older table without them leaves them out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions import patterns as P
from auditlens.functions.text import contains, contains_any, extract, has_any

MSG = "message"


def error_predicate() -> Column:
    code = F.col("sqlerrcode")
    return F.col("errorLevel").isin(*P.ERROR_LEVELS) | ((code != P.OK_CODE) & (code != ""))


def auth_failure_predicate() -> Column:
    return (contains(MSG, "authentication failed")
            | contains(MSG, "password authentication failed")
            | (F.col("sqlerrcode") == "28P01"))


def auth_code_predicate() -> Column:
    code = F.col("sqlerrcode")
    lvl = F.lower(F.col("errorLevel"))
    err = lvl.isin("error", "fatal")
    return ((code.startswith("28") & (code != "28000"))
            | ((code == "28000") & err)
            | (err & contains(MSG, "authentication")))


#: Line kinds, as stored since the first version of the table.
FLAGS: dict[str, Callable[[], Column]] = {
    "is_audit": lambda: contains(MSG, P.AUDIT_MARK),
    "is_conn": lambda: contains_any(MSG, (P.CONN_AUTHORIZED, P.CONN_RECEIVED)),
    "is_err": error_predicate,
}

#: Further line kinds, and which term lists a message matches.
KINDS: dict[str, Callable[[], Column]] = {
    "is_conn_auth": lambda: contains(MSG, P.CONN_AUTHORIZED),
    "is_auth_failure": auth_failure_predicate,
    "is_auth_code": auth_code_predicate,
    "t_select": lambda: has_any(MSG, P.USER_SELECT_TERMS),
    "t_exfil": lambda: has_any(MSG, P.EXFIL_TERMS),
    "t_destructive_pre": lambda: has_any(MSG, P.DESTRUCTIVE_PREFILTER_TERMS),
    "t_destructive": lambda: has_any(MSG, P.DESTRUCTIVE_TERMS),
    "t_privilege": lambda: has_any(MSG, P.PRIVILEGE_TERMS),
    "t_privilege_alert": lambda: has_any(MSG, P.PRIVILEGE_ALERT_TERMS),
    "t_privilege_activity": lambda: has_any(MSG, P.ACTIVITY_PRIVILEGE_TERMS),
    "t_activity_select": lambda: has_any(MSG, P.ACTIVITY_SELECT_TERMS),
    "t_activity_write": lambda: has_any(MSG, P.ACTIVITY_WRITE_TERMS),
    "t_activity_ddl": lambda: has_any(MSG, P.ACTIVITY_DDL_TERMS),
    "t_catalog": lambda: has_any(MSG, P.CATALOG_TERMS),
}

#: Message fields; '' where a message has none.
FIELDS: dict[str, Callable[[], Column]] = {
    "p_user": lambda: extract(P.USER_RE, MSG),
    "p_database": lambda: extract(P.DATABASE_RE, MSG),
    "p_host": lambda: extract(P.HOST_RE, MSG),
    "p_class": lambda: extract(P.AUDIT_CLASS_RE, MSG),
    "p_statement": lambda: extract(P.AUDIT_STATEMENT_RE, MSG),
    "p_object_type": lambda: extract(P.AUDIT_OBJECT_TYPE_RE, MSG),
    "p_object": lambda: extract(P.AUDIT_OBJECT_NAME_RE, MSG),
}

EXPRESSIONS = FLAGS | KINDS | FIELDS
MARKER = "p_class"          # a table with this column has all of them


def is_parsed(df: DataFrame) -> bool:
    return MARKER in df.columns


def flag(df: DataFrame, name: str) -> Column:
    """The stored line-kind flag if ``df`` has it, else TRUE (no pruning).

    Rows of another writer carry no flag; a NULL flag prunes nothing. Both
    halves reach the Parquet scan (``= true`` or ``IS NULL``).
    """
    return F.col(name) | F.col(name).isNull() if name in df.columns else F.lit(True)


def stored(df: DataFrame | None, name: str) -> Column:
    """A column of the parsed log: as stored, else by its expression."""
    if df is not None and is_parsed(df):
        return F.col(name)
    expr = EXPRESSIONS[name]()
    return flag(df, name) & expr if df is not None and name in FLAGS else expr


def with_parsed(df: DataFrame) -> DataFrame:
    """``df`` with all columns of the parsed log; those it has stay as they are."""
    return df.withColumns({n: e() for n, e in EXPRESSIONS.items() if n not in df.columns})
