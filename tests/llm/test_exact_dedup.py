from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

from auditlens.llm.exact_dedup import drop_exact_duplicates, exact_duplicates


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    out = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(t.encode()).hexdigest()
        left = 1
        for i in ids:
            kept = i == keep and left == 1
            left -= kept
            out[(i, keep, len(ids), kept, sha)] += 1
    return out


def test_brute_force(edge, clashing):
    want = brute([(r.doc_id, r.text) for r in edge.collect()])
    for docs in (edge, clashing):
        assert Counter(map(tuple, exact_duplicates(docs).collect())) == want
    assert Counter(map(tuple, exact_duplicates(edge, lanes=64, bits=2).collect())) == want
    assert Counter(map(tuple, exact_duplicates(edge, lanes=1).collect())) == want


def test_one_row_of_each_group_stays(clashing):
    rows = drop_exact_duplicates(clashing)
    assert rows.columns == clashing.columns
    texts = [normal(r.text) for r in rows.collect()]
    assert len(texts) == len(set(texts))
    assert set(texts) == {normal(r.text) for r in clashing.collect()}


def test_empty_table(empty):
    assert exact_duplicates(empty).count() == 0
    assert drop_exact_duplicates(empty).count() == 0


def test_no_lane_gathers_a_group(spark):
    from auditlens.llm.exact_dedup import _collapse, digest_rows, merge_runs
    docs = spark.range(3000).selectExpr("id AS doc_id", "'same' AS text")
    groups = merge_runs(digest_rows(docs), lanes=16, bits=2).collect()
    assert [(g.keep_id, g.group_size) for g in groups] == [(0, 3000)]
    plan = merge_runs(digest_rows(docs), lanes=16, bits=2)._jdf.queryExecution().toString()
    assert "SortAggregate" in plan and _collapse
