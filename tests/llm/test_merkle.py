from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from auditlens.llm.merkle import FIELDS, manifest, numbered, verify


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def leaf_of(row, text):
    values = [*row[:-1], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """The root of a run of nodes, and per node the (left, right) siblings up to it."""
    paths = [[] for _ in nodes]
    members = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, joined = [], []
        for begin in range(0, len(nodes), 8):
            run = nodes[begin:begin + 8]
            for k in range(len(run)):
                for i in members[begin + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            above.append(sha("".join(run)))
            joined.append(sum(members[begin:begin + 8], []))
        nodes, members = above, joined
    return nodes[0], paths


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        text = r[-1]
        bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        groups[r[2]].append((r[0] is not None, r[0], leaf_of(r, text), leaf_of(r, lowered) if bad else None))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        leaves = sorted(groups[lang], key=lambda x: (x[0], x[1] or 0, x[2]))
        trees.append((leaves, *climb([x[2] for x in leaves])))
    if not trees:
        return Counter()
    root, upper = climb([t[1] for t in trees])
    out = Counter()
    for (leaves, sub, paths), above in zip(trees, upper):
        for (_, i, leaf, other), path in zip(leaves, paths):
            folded = other or leaf
            for left, right in path + above:
                folded = sha(left + folded + right)
            proof = sha("".join(left + right for left, right in path + above))
            out[(i, leaf, sub, root, proof, folded, folded == root)] += 1
    return out


def result(docs):
    rows = verify(manifest(docs)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return Counter(map(tuple, rows.collect()))


def test_brute_force(edge, clashing):
    want = brute([tuple(r[c] for c in FIELDS) for r in edge.select(*FIELDS).collect()])
    assert result(edge) == want
    assert result(clashing.withColumns({c: F.lit(1) for c in ("g", "idx", "n", "h", "path", "child", "root")})) == want


def test_many_groups_and_levels(spark):
    """70 groups need a tree of three levels above; one holds a third of the rows."""
    docs = spark.range(900).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 1 THEN NULL ELSE concat('l', id % 70) END AS lang",
        "'S' AS source", "id * 7 AS n_chars", "concat('Text Ä ', id % 11) AS text")
    got = result(docs.repartition(5))
    assert got == brute([tuple(r[c] for c in FIELDS) for r in docs.select(*FIELDS).collect()])
    assert {k[-1] for k in got} == {True, False}


def test_one_row_and_no_row(spark, empty):
    docs = spark.createDataFrame([(3, "Ab", None, None, 2)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = verify(manifest(docs)).collect()
    assert row.path == [] and row.root == row.subroot == row.leaf
    assert row.proof_sha256 == sha("") and (row.folded_root == row.root) == row.verified
    assert verify(manifest(empty)).count() == 0


def test_a_changed_field_is_noticed(spark, edge):
    """Untampered rows verify; a row whose claimed text differs does not."""
    proofs = verify(manifest(edge))
    rows = proofs.collect()
    assert all(r.verified == (r.claimed == r.leaf) for r in rows)
    assert any(not r.verified for r in rows) and len({r.root for r in rows}) == 1
    other = manifest(edge.withColumn("text", F.when(F.col("doc_id") == 3, "x").otherwise(F.col("text"))))
    assert other.first().root != rows[0].root


def test_places_of_a_hot_group(spark):
    """Equal rows and one group in all: places are still 0..n-1, over several tasks."""
    df = spark.range(5000).selectExpr("'g' AS g", "CASE WHEN id < 2000 THEN 7 ELSE id END AS k").repartition(6)
    rows = numbered(df, "g", ["k"]).collect()
    assert sorted(r.idx for r in rows) == list(range(5000)) and {r.n for r in rows} == {5000}
    assert [r.k for r in sorted(rows, key=lambda r: r.idx)] == sorted(r.k for r in rows)
