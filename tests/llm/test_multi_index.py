from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditlens.llm import multi_index as M

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """(vec_id, n_links, component, kept) of every row, over all pairs."""
    def unit(x):
        if x is None or not len(x) or any(v is None or not np.isfinite(v) for v in x):
            return None
        x = np.array(x, np.float64)
        return x / np.sqrt((x * x).sum()) if x.any() else None

    units = [unit(r[1]) if r[0] is not None and r[2] is not None else None for r in rows]
    n, parent = [0] * len(rows), {r[0]: r[0] for r in rows}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] \
                    and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.98:
                n[i] += 1
                n[j] += 1
                lo, hi = sorted((top(rows[i][0]), top(rows[j][0])))
                parent[hi] = lo
    out = []
    for i, r in enumerate(rows):
        comp = None if r[0] is None else top(r[0])
        out.append((r[0], n[i], comp, r[0] == comp))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def vector_rows(seed=1, dim=16):
    """Random vectors, tight and loose groups, chains, copies and damaged rows."""
    rng = np.random.default_rng(seed)
    rows = []

    def add(x, label):
        rows.append((len(rows), None if x is None else [float(np.float32(v)) for v in x], label))

    for k in range(300):
        add(rng.normal(size=dim), k % 3)
    for label, n, noise in ((0, 150, 0.05), (1, 40, 0.13), (1, 40, 0.2), (2, 60, 0.16)):
        base = rng.normal(size=dim)
        for _ in range(n):
            add(base + noise * rng.normal(size=dim), label)
    x = rng.normal(size=dim)
    for _ in range(30):  # a chain of links
        x = x + 0.13 * rng.normal(size=dim)
        add(x, 2)
    for k in (3, 7, 305, 305):  # copies, and one under another label
        add(rows[k][1], rows[k][2])
    add(rows[3][1], 1)
    for bad in (None, [], [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [float("inf")] + [1.0] * (dim - 1),
                [3.0], [-3.0], [4.0], [2.0, 1.0], rows[3][1][:5]):
        add(bad, 0)
    rows.append((len(rows), [None] + [1.0] * (dim - 1), 0))
    rows.append((len(rows), rows[0][1], None))
    rows.append((None, rows[0][1], 0))
    rows += [(5, rows[5][1], 2), (5, rows[310][1], 0), (5, rows[400][1], 0)]  # an identifier again
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(vector_rows(), SCHEMA).repartition(3).cache()


def test_brute_force(vectors, monkeypatch):
    monkeypatch.setattr(M, "CELL", 12)  # a grid of several codes a half
    want = brute([tuple(r) for r in vectors.collect()])
    assert got(M.near_vectors(vectors)) == want
    assert sum(n for _, n, _, _ in want) > 10000


def test_one_cell_many_blocks(spark, vectors):
    """The rows of a label in one cell, compared in blocks, and more columns."""
    rows = vectors.withColumns({c: F.lit("x") for c in ("key", "grp", "cell", "n", "node", "vec", "block")})
    assert got(M.near_vectors(rows)) == brute([tuple(r) for r in vectors.collect()])


def test_blocks_do_not_change_links(spark, vectors, monkeypatch):
    monkeypatch.setattr(M, "CELL", 40)
    read = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND size(embedding) = 16")
    read = read.select(F.col("vec_id"), F.col("label").cast("string"), "embedding").mapInArrow(
        M._read_batches, "vec_id long, key binary, grp string, vec binary").where("key IS NOT NULL")
    classes = read.groupBy("key").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"),
                                      F.first("grp").alias("grp"), F.first("vec").alias("vec")).cache()
    sums = []
    for block in (8, 50, 5000):
        links = M.class_links(classes, block=block)
        sums.append({r.key: r.n for r in links.groupBy("key").agg(F.sum("n").alias("n")).collect()})
    assert sums[0] == sums[1] == sums[2] and len(sums[0]) > 200


def test_the_walk_reaches_every_link():
    """Recall against all pairs: 1 with the whole reach, near its target with less."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 32))
    x = M.unit_rows(np.concatenate([base, base + 0.15 * rng.normal(size=base.shape), base + 0.2 * rng.normal(size=base.shape)]))
    books = (M._means(x[:, :16], 9, 1), M._means(x[:, 16:], 9, 1))
    i, j = np.nonzero(np.triu(x @ x.T >= 0.98, 1))
    assert len(i) > 300
    found = {}
    for recall in (1, 0.99, 0.9):
        own, row, cell = M.visits(x, books, M.reach_of(0.98, recall, 32))
        seen = set(zip(row.tolist(), cell.tolist()))
        met = [own[a] == own[b] or (a, own[b]) in seen or (b, own[a]) in seen for a, b in zip(i, j)]
        found[recall] = sum(met) / len(met), len(row)
    assert found[1][0] == 1
    assert found[0.99][0] >= 0.95 and found[0.9][0] >= 0.85
    assert found[0.9][1] < found[0.99][1] < found[1][1] < len(x) * 81


def test_doubles_of_any_size(spark):
    """Neither huge nor tiny components overflow; integers are read as doubles."""
    rows = [(1, [1e200, 2e200, 0.0], "a"), (2, [1e-200, 2e-200, 0.0], "a"), (3, [1.0, 2.0, 0.01], "a"), (4, [1.0, 2.0, 0.0], "b")]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>, label string")
    assert got(M.near_vectors(df)) == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True)]
    whole = spark.createDataFrame([(1, [3, 4], 1), (2, [6, 8], 1)], "vec_id long, embedding array<int>, label int")
    assert got(M.near_vectors(whole)) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_empty_table_and_dropping(spark, vectors):
    assert M.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    left = M.drop_near_vectors(vectors)
    assert left.columns == vectors.columns
    kept = {r[0] for r in got(M.near_vectors(vectors)) if r[3]}
    assert {r.vec_id for r in left.collect()} == kept


def test_a_hot_cell_is_split(spark):
    """A group that fills a cell is compared in many units, none above two blocks."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=24) + 0.02 * rng.normal(size=(1500, 24))
    df = spark.createDataFrame([(k, [float(v) for v in r], 0) for k, r in enumerate(x)], SCHEMA)
    assert got(M.near_vectors(df)) == sorted(((k, 1499, 0, k == 0) for k in range(1500)), key=str)
