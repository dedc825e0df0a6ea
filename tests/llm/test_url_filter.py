from __future__ import annotations

from pyspark.sql import functions as F

from auditlens.llm import url_filter
from auditlens.llm.url_filter import RULES, judge

URLS = ["http://a.com/", "http://a.com", "http://A.Example.COM/en/x?y=http://z", "https://www.example.com/en/1",
        "https://m.www.example.com/en/1", "http://notexample.com/en/", "http://x.net/es/1", "http://net/fr/", "x.net/es/",
        "http://x.net/en/9", "http://x.org?a=1&b=2#f", "http://x.org#/en/", None, "", "://", "http:///path", "http://com/",
        "http://ünï.example.com/en/é", "http://x.net/ES/1", "http://x.org/" + "a1/" * 100000]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[:min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fit = [(len(h + p), h + p, v) for v, h, p in RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


def test_rules_and_verdicts(spark):
    rows = list(enumerate(URLS)) + [(0, URLS[0]), (None, URLS[6])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    clash = pages.withColumns({c: F.lit(1) for c in ("host", "label", "suffix", "length", "features", "prediction")})
    for table in (pages, clash):
        got = judge(table).collect()
        assert sorted(str(r.page_id) for r in got) == sorted(str(i) for i, _ in rows)
        for r in got:
            host, path, rule, verdict = brute(URLS[6 if r.page_id is None else r.page_id])
            assert (r.host, r.path, r.rule) == (host, path, rule)
            assert r.verdict == verdict if rule else r.verdict in ("allow", "block") and 0 <= r.block_score <= 1


def test_trees_learn_the_labels(spark):
    good = [f"https://site{i}.com/page/{i}" for i in range(200)]
    bad = [f"http://s-{i}-{i * 7919}.net/es/{i * 104729}/{i * 31}?a={i}&b={i}&c={i}" for i in range(200)]
    new = [f"https://fresh{i}.org/page/{i}" for i in range(20)] + [
        f"http://t-{i}-{i * 7907}.net/de/{i * 104723}/{i * 37}?a={i}&b={i}&c={i}" for i in range(20)]
    pages = spark.createDataFrame(list(enumerate(good + bad + new)), "page_id long, url string")
    got = {r.page_id: r for r in judge(pages).where("rule IS NULL").collect()}
    assert len(got) == 40
    assert sum(got[400 + i].verdict == ("allow" if i < 20 else "block") for i in range(40)) >= 38


def test_every_labelled_url_counts(spark):
    url = F.concat(F.lit("http://s"), "id", F.when(F.col("id") < 24_000, ".com/").otherwise(".net/es/"))
    rows = spark.range(25_000).select(url.alias("url")).union(spark.createDataFrame([("http://s0.com/",)], "url string"))
    host, path = url_filter.split_url(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    model, suffixes, only = url_filter.train(
        rows.withColumn("verdict", url_filter.rule_of(F.col("host"), F.col("path"))[1]))
    assert {(r.suffix, r.seen, r.blocked) for r in suffixes.collect()} == {("com", 24_000, 0), ("net", 1_000, 1_000)}
    assert model is not None and only is None


def test_features(spark):
    import math
    row = spark.createDataFrame([("https://a-b.c.org/x/y?k=1&l=22#z", "a-b.c.org", "/x/y")], "url string, host string, path string")
    r = url_filter._lexical(row).first()
    url = row.first().url
    share = [url.count(c) / len(url) for c in set(url)]
    assert (r.length, r.depth, r.n_params, r.n_labels, r.n_hyphens, r.is_https, r.suffix) == (len(url), 2, 2, 3, 1, 1, "org")
    assert abs(r.entropy + sum(p * math.log2(p) for p in share)) < 1e-9
    assert abs(r.digit_ratio - 3 / len(url)) < 1e-9


def test_without_labels(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert judge(none).count() == 0
    one = spark.createDataFrame([(1, "http://x.org/"), (2, None)], "page_id long, url string")
    assert [r.verdict for r in judge(one).collect()] == ["allow", "allow"]
    block = spark.createDataFrame([(1, "http://x.org/"), (2, "http://x.net/es/")], "page_id long, url string")
    assert {r.verdict for r in judge(block).collect()} == {"block"}
