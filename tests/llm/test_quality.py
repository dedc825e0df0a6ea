from __future__ import annotations

import re
from collections import Counter, defaultdict

from auditlens.llm.quality import clean_texts, drop_low_quality, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(again))


def brute(rows, min_docs, max_share, min_left, max_docs=10_000):
    lines, texts = defaultdict(set), defaultdict(set)
    cut = lambda t: [" ".join(WORD.findall(x)) for x in (t or "").split("\n") if WORD.search(x)]
    low = lambda x: x.encode().lower()
    for _, t, s in rows:
        texts[s].add(t or "")
        for x in cut(t):
            lines[s, low(x)].add(t)
    out = Counter()
    for i, t, s in rows:
        m = base(t)
        frequent = lambda n: n >= min_docs and n > min(max_docs, max_share * len(texts[s]))  # noqa: B023, E731
        gone = sum(len(x.split(" ")) for x in cut(t) if frequent(len(lines[s, low(x)])))
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        out[(i, *m, failed, not failed and m[0] - gone >= min_left * m[0], gone)] += 1
    return out


def boilerplate(spark):
    rows = [(i, "shared footer line of the host\n" * 6 + f"own words {i} " + " ".join(f"v{i}x{k}" for k in range(12 if i % 4 else 90)),
             "en", "a" if i % 3 else None, None) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def run(docs, **o):
    return Counter(map(tuple, quality_rules(docs, **o).drop("host", "text_key").collect()))


def test_brute_force(spark, edge, clashing):
    rows = [(r.doc_id, r.text, r.source) for r in edge.collect()]
    for docs in (edge, clashing.drop("host")):
        assert run(docs) == brute(rows, 3, 0.1, 0.2)
    docs = boilerplate(spark)
    got = run(docs, min_docs=5, max_share=0.1)
    assert got == brute([(r.doc_id, r.text, r.source) for r in docs.collect()], 5, 0.1, 0.2)
    assert 0 < sum(k[-1] > 0 for k in got)


def test_no_host_is_too_small_or_too_large(spark):
    """A banner leaves the texts of a host of 3, 10 or 20, and of a hot host where its share is small."""
    own = lambda h, i: " ".join(f"{h}{i}w{k}" for k in range(60))
    rows = [(0, f"a banner of {h}\n" + own(h, i), h) for h, n in (("a", 3), ("b", 10), ("c", 20)) for i in range(n)]
    rows += [(0, ("rare in the hot host\n" if i < 40 else "") + own("hot", i), "hot") for i in range(1000)]
    rows += [(0, "held by two only\n" + own("two", i), "two") for i in range(2)]
    docs = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "doc_id long, text string, source string")
    for options in ({}, {"max_docs": 30}):
        assert run(docs, **options) == brute([(i, *r[1:]) for i, r in enumerate(rows)], 3, 0.1, 0.2, **options)
    removed = {h: n for h, n in quality_rules(docs, max_docs=30).groupBy("host").agg({"n_removed_words": "sum"}).collect()}
    assert removed == {"a": 12, "b": 40, "c": 80, "hot": 200, "two": 0}


def test_documents_that_stay(spark, clashing):
    kept = drop_low_quality(clashing)
    assert kept.columns == clashing.columns
    want = sum(n for k, n in run(clashing).items() if k[-2])
    assert kept.count() == want


def test_copies_do_not_make_lines_frequent(spark):
    text = "\n".join(" ".join(f"t{i}q{k}" for k in range(12)) for i in range(6))
    docs = spark.createDataFrame([(i, text, "a") for i in range(500)], "doc_id long, text string, source string")
    assert quality_rules(docs).where("kept").count() == 500


def test_empty_table(empty):
    assert quality_rules(empty).count() == 0
    assert drop_low_quality(empty).count() == 0


def test_frequent_lines_leave_the_texts(spark):
    docs = boilerplate(spark)
    own = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    odd = [(100, "Shared  FOOTER line\tof the host\n\n kept  as it is \nshared footer line of the hosts", "en", "a", 7),
           (101, None, "en", "a", None), (102, "", "en", None, 0), (103, "no footer here", "en", "a", 14)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    got = {r.doc_id: r for r in clean_texts(docs, min_docs=5, max_share=0.1).collect()}
    for i, t, s in own:
        want = t.replace("shared footer line of the host\n", "")
        assert (got[i].text, got[i].source, got[i].n_chars) == (want, s, len(want))
    want = "\n kept  as it is \nshared footer line of the hosts"
    assert (got[100].text, got[100].n_chars) == (want, len(want))
    assert [(got[i].text, got[i].n_chars) for i in (101, 102, 103)] == [(None, None), ("", 0), ("no footer here", 14)]
    rules = {r.doc_id: r for r in quality_rules(docs, min_docs=5, max_share=0.1).collect()}
    for i, t, _ in own:
        assert rules[i].n_removed_words == len(WORD.findall(t)) - len(WORD.findall(got[i].text))
    kept = {r.doc_id: r.text for r in drop_low_quality(docs, min_docs=5, max_share=0.1).collect()}
    assert kept == {i: got[i].text for i, r in rules.items() if r.kept} and kept
