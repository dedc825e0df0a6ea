"""Property check: the one-pass aggregation with bounded sets equals a
brute-force computation on random inputs, including a hot group."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from auditlens.operators.sets import aggregate_with_sets

keys = st.sampled_from(["hot", "hot", "hot", "a", "b", "c"])
vals = st.one_of(st.none(), st.just(""), st.text(alphabet="xyz", min_size=1, max_size=3))
rows_st = st.lists(st.tuples(keys, st.integers(0, 50), vals, st.sampled_from(["L1", "L2", ""])),
                   min_size=1, max_size=60)


def brute(rows, n):
    out = {}
    for k, t, v, lvl in rows:
        g = out.setdefault(k, {"n": 0, "lo": t, "hi": t, "lv": set(), "vs": set(), "big": 0})
        g["n"] += 1
        g["big"] += t > 25
        g["lo"], g["hi"] = min(g["lo"], t), max(g["hi"], t)
        if lvl:
            g["lv"].add(lvl)
        if v:
            g["vs"].add(v)
    return {k: (g["n"], g["lo"], g["hi"], sorted(g["lv"]), sorted(g["vs"])[:n], g["big"], len(g["vs"]))
            for k, g in out.items()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, n=st.integers(1, 4))
def test_aggregate_with_sets_matches_brute_force(spark, rows, n):
    df = spark.createDataFrame(rows, "k string, t int, v string, lvl string")
    from pyspark.sql import functions as F
    got = aggregate_with_sets(df, ["k"], [("n", "count", None), ("lo", "min", "t"), ("hi", "max", "t"),
                                          ("lv", "small_set", "lvl"), ("big", "count_if", F.col("t") > 25),
                                          ("dv", "dcount", "v")], [("vs", "v", n)]).collect()
    assert {r.k: (r.n, r.lo, r.hi, r.lv, r.vs, r.big, r.dv) for r in got} == brute(rows, n)
