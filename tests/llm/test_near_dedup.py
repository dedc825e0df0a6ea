from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

import corpus_pipeline
from auditlens.llm import near_dedup
from auditlens.llm.near_dedup import corrected, drop_near_duplicates, equal_lanes, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    n = min(5, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def brute(rows, percent=85):
    """{(doc_id, n, component, kept): rows}; identifiers are documents."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is None or j is None or not a or not b:
                continue
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return Counter((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets)


def got(docs):
    return Counter(map(tuple, near_duplicates(docs).collect()))


def test_brute_force(edge, clashing):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    want = brute(rows)
    assert got(edge) == want
    assert got(clashing) == want
    kept = drop_near_duplicates(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == sum(n for k, n in want.items() if k[3])


def chain(n, rng):
    """Texts of 80 words, each a word apart from the one before: neighbours are
    alike, the ends are not; and many that share a long passage only."""
    words = [f"a{k}" for k in range(80)]
    rows = []
    for i in range(n):
        rows.append((1000 - i, " ".join(words)))
        words[rng.randrange(80)] = f"n{i}"
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(2000 + i, passage + " " + " ".join(f"q{i}x{k}" for k in range(8))) for i in range(60)]
    return rows


def test_chains_and_passages_in_small_and_large_buckets(spark, monkeypatch):
    rows = chain(120, random.Random(3))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    assert got(docs) == want
    monkeypatch.setattr(near_dedup, "BLOCK", 3)  # every mixed bucket goes by pairs of blocks
    assert got(docs) == want


def test_estimate():
    rng = np.random.default_rng(1)
    signer = near_dedup.Signer()
    for share in (0.5, 0.8, 0.95):
        n = 4000
        common = rng.integers(0, 2**63, int(n * share), dtype=np.uint64)
        own = lambda: rng.integers(0, 2**63, (n - len(common)) // 2, dtype=np.uint64)
        a, b = np.concatenate((common, own())), np.concatenate((common, own()))
        x, y = (np.frombuffer(signer(s)[0], np.uint8)[None] for s in (a, b))
        true = len(common) / (len(common) + 2 * ((n - len(common)) // 2))
        assert abs(corrected(equal_lanes(x, y))[0] - true) < 0.14
    assert equal_lanes(x, x)[0] == near_dedup.K


def test_pipeline_links_from_80_percent(spark):
    """Pairs of 200 shingles of which the second text shares m: similarity m / (400 - m)."""
    rows = []
    for pair, m in enumerate((176, 178, 180, 183, 185, 190)):  # 0.786, 0.802, 0.818, 0.843, 0.860, 0.905
        words = [f"p{pair}x{k}" for k in range(204)]
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(words[200 - m:] + [f"n{pair}x{k}" for k in range(200 - m)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    alike = [len(a & b) / len(a | b) for a, b in zip(*(map(shingle_set, (t for _, t in rows[k::2])) for k in (0, 1)))]
    assert [x >= 0.8 for x in alike] == [False, True, True, True, True, True]
    assert [x >= 0.85 for x in alike] == [False, False, False, False, True, True]
    stays = lambda df: {r.doc_id for r in df.collect()}
    every = set(range(12))
    assert stays(dict(corpus_pipeline.STAGES)["MinHash near-dedup"](spark, docs, "")) == every - {3, 5, 7, 9, 11}
    assert stays(drop_near_duplicates(docs)) == every - {9, 11}


def test_empty_table(empty):
    assert near_duplicates(empty).count() == 0
    assert drop_near_duplicates(empty).count() == 0
