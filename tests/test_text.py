"""Text predicate semantics (has_any / contains / emptiness), on Spark and on
the DuckDB regex engine the oracle uses."""

import duckdb
import pytest
from pyspark.sql import functions as F

from auditlens.functions.text import contains, first_non_empty, has_any, is_empty, term_regex

CASES = [
    # (text, terms, expected)
    ("GRANT SELECT ON t TO bob", ("GRANT",), True),
    ("permission GRANTED to bob", ("GRANT",), False),
    ("grant select on t", ("GRANT",), True),
    ("AUDIT: SESSION,1,1,READ,SELECT,TABLE,a.b,select 1,<not logged>", (",READ,",), True),
    ("AUDIT: SESSION,1,1,WRITE,UPDATE,TABLE,a.b,q,<not logged>", (",READ,",), False),
    ("ALTER ROLE bob WITH LOGIN", ("ALTER ROLE",), True),
    ("ALTER ROLES", ("ALTER ROLE",), False),
    ("select * from pg_catalog.pg_class", ("pg_catalog",), True),
    ("select * from my_pg_catalog_x", ("pg_catalog",), True),   # '_' is a boundary
    ("select * from xpg_catalog", ("pg_catalog",), False),
    ("SELECT1", ("SELECT",), False),
    ("(SELECT)", ("SELECT",), True),
    ("DROP TABLE x", ("DROP TABLE", "DROP DATABASE"), True),
    ("DROPPED TABLE x", ("DROP TABLE",), False),
    ("", ("GRANT",), False),
]


@pytest.mark.parametrize("text,terms,expected", CASES)
def test_has_any_spark(spark, text, terms, expected):
    df = spark.createDataFrame([(text,)], "m string")
    assert df.select(has_any("m", terms).alias("h")).first().h is expected


@pytest.mark.parametrize("text,terms,expected", CASES)
def test_has_any_duckdb_same_regex(text, terms, expected):
    con = duckdb.connect()
    got = con.execute("SELECT regexp_matches(?, ?)", [text, term_regex(terms)]).fetchall()[0][0]
    assert got is expected


def test_contains_is_case_insensitive(spark):
    df = spark.createDataFrame([("Connection Authorized: user=a",), ("nothing",)], "m string")
    got = [r.c for r in df.select(contains("m", "connection authorized").alias("c")).collect()]
    assert got == [True, False]


def test_emptiness_and_first_non_empty(spark):
    df = spark.createDataFrame([(None, "", "x"), ("", "b", None), (None, None, None)], "a string, b string, c string")
    out = df.select(first_non_empty("a", "b", "c", default="UNKNOWN").alias("v"),
                    is_empty("a").alias("e")).collect()
    assert [r.v for r in out] == ["x", "b", "UNKNOWN"]
    assert all(r.e for r in out)


def test_regexp_extract_unmatched_is_empty_null_is_null(spark):
    df = spark.createDataFrame([("no user here",), (None,)], "m string")
    out = [r.u for r in df.select(F.regexp_extract("m", r"user=([^\s,]+)", 1).alias("u")).collect()]
    assert out == ["", None]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

WORDS = ["GRANT", "granted", "SELECT", "select1", ",READ,", "ALTER ROLE", "pg_catalog", "x", " ", ",", "_", "(", "."]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.lists(st.sampled_from(WORDS), max_size=8).map("".join), min_size=1, max_size=40))
def test_has_any_pretest_never_changes_the_result(spark, texts):
    terms = ("GRANT", "SELECT", ",READ,", "ALTER ROLE", "pg_catalog")
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    got = [(r.a, r.b) for r in df.select(has_any("m", terms).alias("a"),
                                         F.col("m").rlike(term_regex(terms)).alias("b")).collect()]
    assert all(a == b for a, b in got)


def test_cluster_profile_applies(spark):
    from auditlens.config import CLUSTER_CONF, ENGINE_CONF, apply_engine_conf
    saved = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        apply_engine_conf(spark, cluster=True)
        assert all(spark.conf.get(k) == v for k, v in {**ENGINE_CONF, **CLUSTER_CONF}.items())
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_datetime_text_same_on_both_engines(spark):
    import datetime as dt

    from auditlens.functions.timefn import hms, iso_datetime_text
    from auditlens.plans import sqltext as S
    ts = [dt.datetime(2024, 1, 1, 0, 0, 7, 179575), dt.datetime(2024, 12, 31, 23, 59, 59, 0)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    got = [(r.a, r.b) for r in df.select(iso_datetime_text("t").alias("a"), hms("t").alias("b")).collect()]
    con = duckdb.connect()
    want = [tuple(con.execute(f"SELECT {S.iso_datetime_text('?::TIMESTAMP')}, {S.hms('?::TIMESTAMP')}",
                              [t, t]).fetchall()[0]) for t in ts]
    assert got == want == [("2024-01-01T00:00:07.1795750Z", "00:00:07"), ("2024-12-31T23:59:59.0000000Z", "23:59:59")]
