from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditlens.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every, positives=5, negatives=3, low=50, high=95):
    kept = {}
    for i, x, label in rows:
        if None in (i, label, x) or any(v is None or not math.isfinite(v) for v in x):
            continue
        whole = [math.floor(256 * v) for v in x]
        if sum(v * v for v in whole) < 2 ** 55:
            packed = np.array(whole, np.int32).tobytes()
            kept[i] = min(kept.get(i, (str(label), packed, whole)), (str(label), packed, whole))
    out = []
    for a in (i for i in kept if i % every == 0):
        scored = sorted((-sum(p * q for p, q in zip(kept[a][2], v[2])), i) for i, v in kept.items() if i != a)
        own = [(i, -s) for s, i in scored if kept[i][0] == kept[a][0]][:positives]
        for p, ps in own:
            fit = [(i, -s) for s, i in scored if kept[i][0] != kept[a][0] and low * ps <= -100 * s <= high * ps]
            out += [(a, p, k + 1, i, ps, s) for k, (i, s) in enumerate(fit[:negatives])]
    return sorted(out)


def got(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def vector_rows(seed=4, dim=24, n=700):
    """Random rows, groups of copies and near copies across labels, and edge cases."""
    rng = np.random.default_rng(seed)
    rows = [(i, [float(v) for v in rng.normal(size=dim) * rng.choice([0.2, 1, 3])], i % 4) for i in range(n)]
    base = rng.normal(size=dim)
    for i in range(n, n + 300):  # a hot group whose members have several labels
        rows.append((i, [float(v) for v in base + 0.05 * rng.normal(size=dim)], i % 5 % 4))
    for i in range(n + 300, n + 340):  # ties
        rows.append((i, rows[8][1], i % 2))
    k = n + 340
    rows += [(k, None, 0), (k + 1, rows[0][1], None), (None, rows[0][1], 1), (k + 2, [None] + rows[0][1][1:], 0),
             (k + 3, [float("nan")] * dim, 0), (k + 4, [float("inf")] * dim, 1), (k + 5, [0.0] * dim, 1), (k + 6, [], 2),
             (k + 7, rows[0][1][:7], 0), (k + 8, rows[8][1] + [5.0], 1), (k + 9, [1e30] * dim, 1),
             (20, rows[3][1], 2), (40, rows[40][1], 0), (k + 10, [2e4] * dim, 3), (k + 11, [1.9e4] * dim, 2),
             (k + 12, [-0.001] * dim, 9), (2000, [0.0] * dim, 8), (2001, [0.0] * dim, 8), (2020, [], 2)]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(vector_rows(), SCHEMA).repartition(3).cache()


def test_brute_force(vectors, monkeypatch):
    monkeypatch.setattr(H, "ROWS", 200)  # several blocks of rows and of anchors
    monkeypatch.setattr(H, "ANCHORS", 16)
    want = brute([tuple(r) for r in vectors.collect()], 20)
    assert len(want) > 300
    assert got(H.hard_negatives(vectors, anchor_every=20)) == want


def test_other_counts_and_windows(vectors):
    rows = vectors.withColumns({c: F.lit("x") for c in ("place", "rank", "score", "squares", "run", "least")})
    want = brute([tuple(r) for r in vectors.collect()], 50, positives=2, negatives=7, low=10, high=80)
    assert got(H.hard_negatives(rows, anchor_every=50, positives=2, negatives=7, low=10, high=80)) == want


def test_one_join_or_many_give_the_same(vectors, monkeypatch):
    few = got(H.hard_negatives(vectors, anchor_every=100))
    monkeypatch.setattr(H, "POSITIVE_SHARES", (None,))
    monkeypatch.setattr(H, "NEGATIVE_PERCENTS", ())
    assert got(H.hard_negatives(vectors, anchor_every=100)) == few


@pytest.mark.parametrize("share", [0.9, 0.5, 0.2, 0.0, -1.0])
def test_join_loses_no_pair(share):
    """The index with its omitted dimensions against all products."""
    rng = np.random.default_rng(5)
    rows = rng.integers(-200, 200, size=(900, 33)) * (rng.random((900, 1)) < 0.9)
    rows[:, 5:] //= 4  # most energy in a few dimensions: many rows end early
    anchors = np.concatenate((rows[:60] + rng.integers(-20, 20, size=(60, 33)), np.zeros((1, 33), int)))
    least = share * (anchors ** 2).sum(axis=1)
    allowed = rng.random((61, 900)) < 0.8
    a, r, s = H.Index(rows).join(anchors, least, allowed.copy())
    scores = anchors @ rows.T
    want = np.argwhere(allowed & (scores >= least[:, None]))
    assert sorted(zip(a.tolist(), r.tolist(), s.tolist())) == sorted((i, j, scores[i, j]) for i, j in want.tolist())


def test_empty_tables(spark, vectors):
    assert H.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert H.hard_negatives(vectors.where("vec_id % 50 <> 0")).count() == 0
    assert H.hard_negatives(vectors.where("label = 1")).count() == 0


def test_a_hot_label_passes_on_few_rows(spark):
    """All rows are alike: a unit passes on the wanted number for each anchor and window."""
    df = spark.range(4000).selectExpr("id AS vec_id", "array(1.0D, 2.0D) AS embedding", "CAST(id % 3 = 0 AS INT) AS label")
    rows = got(H.hard_negatives(df.withColumn("embedding", F.when(F.col("vec_id") % 9 == 1, F.expr("array(0.9D, 1.8D)"))
                                              .otherwise(F.col("embedding"))), anchor_every=50))
    assert rows == brute([(i, [0.9, 1.8] if i % 9 == 1 else [1.0, 2.0], int(i % 3 == 0)) for i in range(4000)], 50)
