from __future__ import annotations

import re
from collections import Counter

import pytest
import test_exact_dedup as exact
import test_near_dedup as near
import test_quality as quality
from oracle_compare import duck, duck_digest, spark_digest

import __spark_entry__ as E
import corpus_pipeline

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def cleaned(rows, min_docs=3, max_share=0.1, min_left=0.2):
    """The rows that stay, without the lines that stand in many texts of their host."""
    word = lambda x: tuple(w.encode().lower() for w in quality.WORD.findall(x))
    texts, holders = {}, {}
    for _, t, s in rows:
        texts.setdefault(s, set()).add(t or "")
        for line in (t or "").split("\n"):
            holders.setdefault((s, word(line)), set()).add(t)
    out = Counter()
    for i, t, s in rows:
        m = quality.base(t)
        if m[0] < 50 or 100 * m[4] > 50 * m[0]:
            continue
        often = lambda line: len(holders[s, word(line)])  # noqa: B023, E731
        left = "\n".join(x for x in t.split("\n") if not word(x) or often(x) < min_docs or often(x) <= max_share * len(texts[s]))
        if quality.base(left)[0] >= min_left * m[0]:
            out[(i, left, s)] += 1
    return out


@pytest.mark.parametrize("table", ["edge", "clashing"])
def test_stages_against_brute_force(spark, request, table):
    docs = request.getfixturevalue(table)
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "exact dedup", "MinHash near-dedup", "mixing to target weights",
                            "best-fit packing"]
    rows = rows_of(docs)

    docs = stages["quality rules"](spark, docs, SF).cache()
    assert docs.columns == columns and Counter(rows_of(docs)) == cleaned(rows)

    rows, docs = rows_of(docs), stages["exact dedup"](spark, docs, SF).cache()
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(exact.normal(t), []).append(i)
    want = Counter((min((i for i in ids if i is not None), default=None), t) for t, ids in groups.items())
    assert docs.columns == columns and Counter((i, exact.normal(t)) for i, t, _ in rows_of(docs)) == want

    rows, docs = rows_of(docs), stages["MinHash near-dedup"](spark, docs, SF).cache()
    want = sum(n for k, n in near.brute([r[:2] for r in rows], corpus_pipeline.NEAR_PERCENT).items() if k[3])
    assert docs.columns == columns and docs.count() == want

    rows, docs = rows_of(docs), stages["mixing to target weights"](spark, docs, SF).cache()
    mixed = Counter(rows_of(docs))
    assert docs.columns == columns and set(mixed) <= set(rows) and max(mixed.values()) <= 3

    packed = stages["best-fit packing"](spark, docs, SF).collect()
    words, want = Counter(), Counter()
    for r in packed:
        words[r.doc_id] += r.n_words
    for (i, t, _), n in mixed.items():
        want[i] += n * len(re.findall(r"[^\x20\x09-\x0D]+", t))
    assert words == want
    bins = Counter()
    for r in packed:
        bins[r.bin_id] += r.n_words
    assert max(bins.values()) <= 2048
    same_bin = Counter((r.bin_id, r.doc_id) for r in packed)
    assert max(same_bin.values()) == 1  # copies never meet


def test_empty_table(spark, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_registered():
    names = [k for k in E.queries() if re.match(r"op\d+_|pipeline$", k)]
    assert sorted(int(re.match(r"op(\d+)", k)[1]) for k in names if k != "pipeline") == list(range(1, 11))
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).where("bin_id IS NOT NULL").count() > 0


@pytest.mark.parametrize("key", ["op4_minhash_near_dedup", "op5_warc_chunks", "op7_exact_dedup"])
def test_query_matches_sql(spark, key):
    assert spark_digest(E.queries()[key](spark, SF)) == duck_digest(duck(SF), E.oracle_sql()[key])
