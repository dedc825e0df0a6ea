"""A Merkle manifest of a dataset, by slot pivots.

1. *Leaves.* One pass over the rows hashes the fields of each; only digests and
   identifiers go on from there.
2. *Places.* The leaves are range-partitioned by (group, identifier, digest), so
   that a group of any size is spread over tasks; the row number inside a sorted
   partition plus the rows of the partitions before it is the place in the group.
3. *Levels.* Place ``// FANOUT`` names the parent, place ``% FANOUT`` the slot.
   One conditional aggregate per slot spreads a parent's children into FANOUT
   columns; their concatenation is hashed. Levels go on until every group has one
   node, its subroot; the subroots are the leaves of a tree over the groups.
4. *Proofs.* A pivoted row without a child's own slot column holds the siblings
   of that child. Going down from the root, each level appends what lies left and
   right of the own slot; a fold over this path gives the root again.

All of it is DataFrame code; every level is a written table an eighth of the size
of the one below. The driver sees one count per tree (its depth).

Defined cases: a null field enters a digest as ``-``; rows with null lang are a
group of their own, the first; null identifiers come first in their group and are
never tampered with; rows of equal identifiers are ordered by digest, equal rows
hold neighbouring places; a group of one row has its leaf as subroot, a single
group its subroot as root; without siblings the proof is the digest of the empty
text; an empty table gives no row. Extra columns are ignored. Texts of any length
are hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlens.llm.common import checked, materialise

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the parts' concatenation, nulls left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def field(c: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def group_key(c: Column) -> Column:
    """A text that is never null and sorts as the values do, null first."""
    return F.coalesce(F.concat(F.lit(":"), c.cast("string")), F.lit("-"))


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with idx, the place of a row in its group by ``order`` from 0, and
    n, the rows of the group. Rows that tie in all of ``order`` come in any order.

    No group passes through one task: rows are counted per group and range
    partition, at most partitions + groups counts."""
    keys = [group, *order, "_tie"]
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    rows = materialise(rows.withColumn("_at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_at", 33).alias("_part")
    runs = rows.groupBy(group, part).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_begin"))
    whole = Window.partitionBy(group)
    before = F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = materialise(runs.select(group, "_part", "_begin", F.coalesce(before, F.lit(0)).alias("_before"),
                                   F.sum("_n").over(whole).alias("n")), "runs")
    rows = rows.withColumn("_part", part).join(checked(runs), [group, "_part"])
    return rows.withColumn("idx", F.col("_before") + F.col("_at") - F.col("_begin")).drop(
        "_at", "_part", "_begin", "_before")


SLOTS = [f"c{k}" for k in range(FANOUT)]


def _joined(slots: list[str]) -> str:
    """SQL for the digests of some slot columns, one after the other."""
    return f"concat_ws('', {', '.join(f'{c}.h' for c in slots)})" if slots else "''"


def _pivot(nodes: DataFrame) -> DataFrame:
    """The parents (g, idx, n, c0.., h) of the nodes (g, idx, n, child), in groups
    of more than one node."""
    slots = [F.expr(f"max(CASE WHEN pmod(idx, {FANOUT}) = {k} THEN child END)").alias(c) for k, c in enumerate(SLOTS)]
    parents = nodes.where("n > 1").groupBy(
        "g", F.expr(f"idx div {FANOUT}").alias("idx"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n")).agg(*slots)
    return parents.withColumn("h", F.expr(f"sha2({_joined(SLOTS)}, 256)"))


def _children(parents: DataFrame) -> DataFrame:
    """(g, idx, child, path) of the children of pivoted rows: left and right of
    the own slot column, before the path of the parent."""
    slots = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN struct({k}L AS slot, {c} AS child, "
        f"struct({_joined(SLOTS[:k])} AS left, {_joined(SLOTS[k + 1:])} AS right) AS around) END"
        for k, c in enumerate(SLOTS))
    rows = parents.selectExpr("g", "idx", "path", f"explode(array_compact(array({slots}))) AS s")
    return rows.selectExpr("g", f"idx * {FANOUT} + s.slot AS idx", "s.child AS child",
                           "concat(array(s.around), path) AS path")


_PATH = "array<struct<left:string,right:string>>"


def tree(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From leaves (g, idx, n, child with field h): the roots (g, root) of the
    groups, and (g, child, path) of every leaf, the path up to its group's root."""
    nodes, levels, tops = leaves, [], [leaves.where("n = 1").select("g", F.col("child")["h"].alias("root"))]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        level = materialise(_pivot(nodes), "level")
        levels.append(level)
        tops.append(level.where("n = 1").select("g", F.col("h").alias("root")))
        nodes = level.select("g", "idx", "n", F.struct("h").alias("child"))
        most = -(-most // FANOUT)
    roots = tops[0]
    for t in tops[1:]:
        roots = roots.unionByName(t)
    no_path = F.array().cast(_PATH)
    below = None
    for level in reversed(levels):
        if below is None:
            level = level.withColumn("path", no_path)
        else:
            level = level.join(below.select("g", "idx", "path"), ["g", "idx"], "left").withColumn(
                "path", F.coalesce("path", no_path))
        below = _children(level)
    lone = leaves.where("n = 1").select("g", "child", no_path.alias("path"))
    return roots, lone if below is None else below.select("g", "child", "path").unionByName(lone)


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, leaf, claimed (the leaf that is to be
    verified, recomputed from the tampered text where the document is tampered
    with), tampered, subroot, root and path, the array of (left, right) siblings
    from the leaf up to the root."""
    doc = {c: F.col(c) for c in FIELDS}
    lowered = dict(doc, text=F.translate("text", UPPER, LOWER))
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    leaves = docs.select(
        group_key(doc["lang"]).alias("g"), "doc_id", "lang", tampered.alias("tampered"),
        digest(*[field(doc[c]) for c in FIELDS]).alias("h"),
        F.when(tampered, digest(*[field(lowered[c]) for c in FIELDS])).alias("other"))
    leaves = numbered(materialise(leaves, "leaves"), "g", ["doc_id", "h"])
    leaves = leaves.select("g", "idx", "n", F.struct("h", "other", "tampered", "doc_id", "lang").alias("child"))
    roots, below = tree(leaves)

    subroots = materialise(roots, "subroots")
    tops = numbered(subroots.select(F.lit("").alias("all"), "g", "root"), "all", ["g"])
    root, above = tree(tops.select(F.col("all").alias("g"), "idx", "n",
                                   F.struct(F.col("root").alias("h"), F.col("g").alias("group")).alias("child")))
    above = above.join(root.select("g", "root"), "g")
    above = materialise(above.select(F.col("child.group").alias("g"), F.col("child.h").alias("subroot"), "root",
                                     F.col("path").alias("upper")), "group-paths")
    found = below.join(checked(above), "g")
    return found.select(
        "child.doc_id", "child.lang", F.col("child.h").alias("leaf"),
        F.coalesce("child.other", "child.h").alias("claimed"), "child.tampered", "subroot", "root",
        F.concat("path", "upper").alias("path"))


def verify(proofs: DataFrame) -> DataFrame:
    """The rows of :func:`manifest` with proof_sha256, folded_root and verified."""
    folded = proofs.withColumns({"proof_sha256": proof_digest(F.col("path")),
                                 "folded_root": fold(F.col("claimed"), F.col("path"))})
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
