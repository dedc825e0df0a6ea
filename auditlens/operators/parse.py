"""Message parsing: pgaudit fields (I2) and connection fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from auditlens.functions import patterns as P
from auditlens.functions.text import extract, trim_chars
from auditlens.sources.parsed import stored


def audit_fields(msg: str = "message", df: DataFrame | None = None) -> dict:
    """The pgaudit fields of an ``AUDIT: SESSION,...`` line.

    AuditClass (READ/WRITE/DDL/ROLE/MISC), AuditStatement (SELECT, DROP
    TABLE...), ObjectType (the 5th field, named TableName by some of the
    reference queries), ObjectName (6th field), QueryText (after ``,,,``).
    Those that ``df`` has stored are taken as they are.
    """
    return {
        "AuditClass": _field(df, "p_class", P.AUDIT_CLASS_RE, msg),
        "AuditStatement": _field(df, "p_statement", P.AUDIT_STATEMENT_RE, msg),
        "ObjectType": _field(df, "p_object_type", P.AUDIT_OBJECT_TYPE_RE, msg),
        "ObjectName": _field(df, "p_object", P.AUDIT_OBJECT_NAME_RE, msg),
        "QueryText": query_text(msg),
    }


def _field(df: DataFrame | None, name: str, pattern: str, msg: str) -> Column:
    return stored(df, name) if msg == "message" else extract(pattern, msg)


def query_text(msg: str = "message") -> Column:
    return trim_chars('"', extract(P.QUERY_TEXT_RE, msg))


def audit_parse(df: DataFrame, msg: str = "message") -> DataFrame:
    return df.withColumns(audit_fields(msg, df))


def conn_fields(msg: str = "message", prefix: str = "Direct", df: DataFrame | None = None) -> dict:
    return {
        f"{prefix}User": _field(df, "p_user", P.USER_RE, msg),
        f"{prefix}Database": _field(df, "p_database", P.DATABASE_RE, msg),
        f"{prefix}Host": _field(df, "p_host", P.HOST_RE, msg),
    }


def conn_parse(df: DataFrame, msg: str = "message", prefix: str = "Direct") -> DataFrame:
    """``user=``, ``database=``, ``host=`` fields; '' where absent."""
    return df.withColumns(conn_fields(msg, prefix, df))


def schema_of(obj: str | Column) -> Column:
    """Schema prefix of a qualified object name ('' if unqualified)."""
    return extract(P.SCHEMA_PREFIX_RE, obj)
