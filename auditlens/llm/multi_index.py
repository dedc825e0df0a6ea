"""Near duplicates among vectors by an inverted multi-index.

1. *Classes.* Rows of one label with the same components are one class from here
   on; its node is its smallest identifier, its weight its number of rows.
2. *Codebooks.* Unit vectors are cut into two halves. Each half has a codebook of
   its own (k-means over a sample of at most ``SAMPLE`` classes, the only thing
   that is sampled); a pair of codes is a cell of the product grid. The grid grows
   with the largest label, to about ``CELL`` classes a cell, ``CODES`` codes a half.
3. *Traversal.* Every class is listed in its own cell and visits others in the order
   of what a linked vector must at least be away: per half, the distance to
   the hyperplanes between a code and the codes next to the vector; for a cell, the
   sum of both squares. The sums come from two sorted lists, walked as a staircase
   (the multi-sequence algorithm), and the walk ends where the sum passes
   ``2 - 2 * threshold``: no vector beyond can be linked, so the recall is 1. With a
   lower target ``recall``, it ends where a difference of random direction
   would pass with that probability. A pair in different cells is met from the side
   of the lower one.
4. *Verification.* A cell of up to ``BLOCK`` entries is one unit of work; those of a
   larger one are pairs of a block of its own classes and a block of its own or of the
   visiting ones (visitors are not compared with each other). A unit is one matrix
   product of exact cosines. It gives each class its number of links and the smallest
   node it is connected with inside the unit, never the pairs.
5. *Components* of those connections.

A cell with ``n`` classes of its own is compared in ``(n / BLOCK) ** 2 / 2`` units and more
for its visitors, over as many tasks as there are; the work within one very large group of different vectors that are
all alike thus stays quadratic (each of its links is counted), its output does not.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite
components, and one without label or identifier, links with nothing (component: its
own identifier, null if it has none; kept). Vectors of different lengths are not
compared. Rows that repeat an identifier count as vectors of their own in n_links and
as one node in the components. An empty table gives no row; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.llm.common import checked, materialise, slices
from auditlens.llm.graph import components, least_reachable

THRESHOLD = 0.98
SAMPLE, CELL, CODES, BLOCK = 8192, 1024, 512, 1024
#: k-means rounds, and codes whose hyperplanes bound a distance.
ROUNDS, NEAREST = 8, 8


def valid_vectors(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The components of each list; None where a list is null, empty or holds
    null or non-finite components. Negative zeros become zeros."""
    wide = pa.types.is_large_list(column.type)
    _, offsets = column.buffers()[:2]
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    items = column.values
    bad = ~np.isfinite(items.fill_null(np.nan).to_numpy(zero_copy_only=False))
    values = items.fill_null(0).to_numpy(zero_copy_only=False) + 0.0
    faults = np.concatenate(([0], np.cumsum(bad)))
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    for i, null in enumerate(nulls):
        begin, end = at[i], at[i + 1]
        yield None if null or begin == end or faults[end] > faults[begin] else values[begin:end]


def unit_rows(packed: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that no square overflows."""
    x = packed.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        key, group, packed = [], [], []
        for i, label, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), valid_vectors(batch.column(2))):
            if i is None or label is None or x is None or not x.any():
                key.append(None)
                group.append(None)
                packed.append(None)
            else:
                group.append(f"{len(x)}:{label}")
                packed.append(x.tobytes())
                key.append(hashlib.blake2b(packed[-1] + group[-1].encode(), digest_size=16).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(key, pa.binary()), pa.array(group, pa.string()), pa.array(packed, pa.binary())],
            ["vec_id", "key", "grp", "vec"])


def _means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Codes of the rows ``x``: spread-out beginnings, then k-means."""
    rng = np.random.default_rng(seed)
    codes = [x[0]]
    far = ((x - x[0]) ** 2).sum(axis=1)
    while len(codes) < k and far.sum() > 0:
        codes.append(x[rng.choice(len(x), p=far / far.sum())])
        far = np.minimum(far, ((x - codes[-1]) ** 2).sum(axis=1))
    c = np.array(codes)
    for _ in range(ROUNDS):
        own = squared(x, c).argmin(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        n = np.bincount(own, minlength=len(c))[:, None]
        c = np.where(n > 0, total / np.maximum(n, 1), c)
    return c


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to codes."""
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1), 0)


def codebooks(classes: DataFrame, seed: int = 7) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vector length -> codes of the first and of the second half, from the SAMPLE
    classes of smallest hash. Lengths with too few sampled vectors have none:
    their labels are one cell."""
    largest = classes.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    k = min(CODES, int(np.ceil(np.sqrt(largest / CELL))))
    if k < 2:
        return {}
    length = F.substring_index("grp", ":", 1).cast("int")
    sample = classes.select(length.alias("d"), "vec", "key").orderBy(F.xxhash64("key"), "key").limit(SAMPLE).collect()
    books = {}
    for d in sorted({r.d for r in sample}):
        rows = [r.vec for r in sample if r.d == d]
        if d > 1 and len(rows) >= 4 * k:
            x = unit_rows(np.stack([np.frombuffer(bytes(v), f"<f{len(v) // d}") for v in rows]))
            books[d] = (_means(x[:, :d // 2], k, seed), _means(x[:, d // 2:], k, seed))
    return books


def _away(x: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own code, and for every code the least squared distance of a row to what
    lies nearer to that code than to the codes nearest to the row."""
    far = squared(x, codes)
    own = far.argmin(axis=1)
    apart = np.sqrt(squared(codes, codes))
    near = np.argpartition(far, min(NEAREST, len(codes)) - 1, axis=1)[:, :NEAREST]
    gap = far[:, :, None] - np.take_along_axis(far, near, axis=1)[:, None, :]
    between = 2 * apart[:, near].transpose(1, 0, 2)
    least = np.where(between > 0, gap / np.where(between > 0, between, 1), 0).max(axis=2)
    return own, np.maximum(least, 0) ** 2


def visits(x: np.ndarray, books: tuple[np.ndarray, np.ndarray], reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own cell of each row; rows and cells of the visits): a cell beyond the own one is
    visited if the sum of both halves' bounds is within ``reach``."""
    half = books[0].shape[1]
    (own1, away1), (own2, away2) = _away(x[:, :half], books[0]), _away(x[:, half:], books[1])
    wide = len(books[1])
    own = own1 * wide + own2
    order1, order2 = away1.argsort(axis=1), away2.argsort(axis=1)
    away1, away2 = np.take_along_axis(away1, order1, 1), np.take_along_axis(away2, order2, 1)
    rows, cells = [], []
    for step in range(away1.shape[1]):  # one column of the staircase of both sorted lists
        left = reach - away1[:, step]
        active = np.flatnonzero(left >= 0)
        if not len(active):
            break
        row, at = np.nonzero(away2[active] <= left[active, None])
        row = active[row]
        cell = order1[row, step] * wide + order2[row, at]
        beyond = cell > own[row]
        rows.append(row[beyond])
        cells.append(cell[beyond])
    return own, np.concatenate(rows), np.concatenate(cells)


ENTRY = "grp string, cell int, resident boolean, key binary, node long, weight long, vec binary"
COUNT = "grp string, cell int, own long, n long"


def reach_of(threshold: float, recall: float, length: int) -> float:
    """The squared distance at which the walk ends: all that a link can have for
    recall 1, else the share of it that the projection of a random difference on one
    direction stays within with probability ``recall``."""
    whole = (2 - 2 * threshold) * (1 + 1e-9) + 1e-12
    return whole if recall >= 1 or length < 4 else whole * (1 - (1 - recall) ** (2 / (length - 2)))


def _entry_batches(batches: Iterator[pa.RecordBatch], books: dict, threshold: float, recall: float,
                   counts: bool) -> Iterator[pa.RecordBatch]:
    """The entries of the cells, or with ``counts`` only their number by cell."""
    for batch in slices(batches):
        group = batch.column(0).to_numpy(zero_copy_only=False)
        length = np.array([int(g.split(":", 1)[0]) for g in group], np.int64)
        rows, cells, resident = [], [], []
        for d in np.unique(length):
            at = np.flatnonzero(length == d)
            if d in books:
                packed = [batch.column(4)[int(i)].as_py() for i in at]
                x = unit_rows(np.stack([np.frombuffer(v, f"<f{len(v) // d}") for v in packed]))
                own, row, cell = visits(x, books[d], reach_of(threshold, recall, d))
            else:
                own, row, cell = np.zeros(len(at), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
            rows += [at, at[row]]
            cells += [own, cell]
            resident += [np.ones(len(at), bool), np.zeros(len(row), bool)]
        if not rows:
            continue
        row, cell = np.concatenate(rows), np.concatenate(cells).astype(np.int32)
        taken = batch.take(pa.array(row))
        if counts:
            table = pa.table({"grp": taken.column(0), "cell": cell, "own": np.concatenate(resident).astype(np.int64),
                              "n": np.ones(len(row), np.int64)})
            table = table.group_by(["grp", "cell"]).aggregate([("own", "sum"), ("n", "sum")])
            table = table.select(["grp", "cell", "own_sum", "n_sum"]).rename_columns(["grp", "cell", "own", "n"])
            yield from table.combine_chunks().to_batches()
        else:
            yield pa.RecordBatch.from_arrays(
                [taken.column(0), pa.array(cell), pa.array(np.concatenate(resident)), *taken.columns[1:]],
                ["grp", "cell", "resident", "key", "node", "weight", "vec"])


LINKED = "key binary, node long, n long, low long"


def _compare(unit: pa.Table, threshold: float) -> pa.Table:
    """The linked classes of one unit: how many rows each is linked with here, and
    the smallest node it is connected with."""
    length = int(unit["grp"][0].as_py().split(":", 1)[0])
    left, right, visit = (unit[c][0].as_py() for c in ("left", "right", "visit"))
    node, weight, block = (unit[c].to_numpy() for c in ("node", "weight", "block"))
    resident = unit["resident"].to_numpy(zero_copy_only=False)
    packed = unit["vec"].combine_chunks().to_pylist()
    x = unit_rows(np.stack([np.frombuffer(v, f"<f{len(v) // length}") for v in packed]))
    if visit:
        a, b = np.flatnonzero(resident), np.flatnonzero(~resident)
    else:
        a, b = np.flatnonzero(block == left), np.flatnonzero(block == right)
    alike = x[a] @ x[b].T >= threshold
    alike &= resident[a][:, None] | resident[b][None, :]
    if left == right and not visit:
        alike = np.triu(alike, 1)
    i, j = np.nonzero(alike)
    i, j = a[i], b[j]
    n = np.zeros(len(node), np.int64)
    np.add.at(n, i, weight[j])
    np.add.at(n, j, weight[i])
    low = least_reachable(node, i, j)
    some = np.flatnonzero(n > 0)
    return pa.table({"key": unit["key"].combine_chunks().take(pa.array(some)), "node": node[some], "n": n[some],
                     "low": low[some]}, schema=pa.schema([("key", pa.binary()), ("node", pa.int64()),
                                                          ("n", pa.int64()), ("low", pa.int64())]))


def class_links(classes: DataFrame, threshold: float = THRESHOLD, recall: float = 1.0, block: int = BLOCK) -> DataFrame:
    """(key, node, n, low): for every class, from each unit in which it has links, the
    number of rows linked with and the smallest node connected with."""
    args = {"books": codebooks(classes), "threshold": threshold, "recall": recall}
    listed = classes.select("grp", "key", "node", "weight", "vec")
    counts = listed.mapInArrow(partial(_entry_batches, counts=True, **args), COUNT)
    large = counts.groupBy("grp", "cell").agg(F.sum("own").alias("own"), F.sum("n").alias("n")).where(F.col("n") > block)
    large = materialise(large.select("grp", "cell", F.ceil(F.col("own") / block).alias("own_blocks"),
                                     F.ceil((F.col("n") - F.col("own")) / block).alias("visit_blocks")), "large-cells")
    entries = listed.mapInArrow(partial(_entry_batches, counts=False, **args), ENTRY)
    rows = entries.join(checked(large), ["grp", "cell"], "left").withColumn(
        "blocks", F.when(F.col("resident"), F.col("own_blocks")).otherwise(F.col("visit_blocks")))
    rows = rows.withColumn("block", F.coalesce(F.pmod(F.xxhash64("key"), F.col("blocks")), F.lit(0)))
    # a class meets all blocks of the cell's own classes, one of the cell's own also those of visitors
    meets = F.expr("coalesce(CASE WHEN resident THEN own_blocks + visit_blocks ELSE own_blocks END, 1)")
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), meets - 1)))
    visit = F.col("own_blocks").isNotNull() & (~F.col("resident") | (F.col("with") >= F.col("own_blocks")))
    rows = rows.withColumn("visit", visit)
    units = rows.selectExpr(
        "grp", "cell", "visit",
        "CASE WHEN NOT visit THEN least(block, with) WHEN resident THEN block ELSE with END AS left",
        "CASE WHEN NOT visit THEN greatest(block, with) WHEN resident THEN with - own_blocks ELSE block END AS right",
        "block", "resident", "key", "node", "weight", "vec")

    def compare(unit: pa.Table) -> pa.Table:
        return _compare(unit, threshold)

    return units.groupBy("grp", "cell", "visit", "left", "right").applyInArrow(compare, LINKED)


def near_vectors(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                 threshold: float = THRESHOLD, recall: float = 1.0) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept. Vectors of one
    label are linked from a cosine of ``threshold`` on."""
    items = rows.schema[vector_col].dataType.elementType
    vector = F.col(vector_col) if isinstance(items, T.FloatType) else F.col(vector_col).cast("array<double>")
    read = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                       vector.alias("embedding"))
    read = materialise(read.mapInArrow(_read_batches, "vec_id long, key binary, grp string, vec binary"), "vectors")
    of = read.where("key IS NOT NULL").select("vec_id", "key")
    classes = materialise(read.where("key IS NOT NULL").groupBy("key").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight"), F.first("grp").alias("grp"),
        F.first("vec").alias("vec")), "vector-classes")
    links = materialise(class_links(classes, threshold, recall), "vector-links")

    nodes = classes.select("key", "node", "weight")
    repeated = of.groupBy("vec_id").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo <> hi")
    same = of.join(repeated.select("vec_id"), "vec_id").join(nodes, "key")
    joined = links.select(F.col("node").alias("a"), F.col("low").alias("b")).unionByName(
        same.select(F.col("vec_id").alias("a"), F.col("node").alias("b")))
    comps = components(joined)
    n = links.groupBy("key").agg(F.sum("n").alias("n"))
    found = nodes.join(n, "key", "left").join(comps, "node", "left").select(
        "key", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("comp", "node").alias("component_id"))
    with_links = of.join(materialise(found, "found-classes"), "key").select("vec_id", "n_links", "component_id")
    alone = read.where("key IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                             F.col("vec_id").alias("component_id"))
    return with_links.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def drop_near_vectors(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                      threshold: float = THRESHOLD) -> DataFrame:
    """``rows`` without the identifiers that :func:`near_vectors` does not keep; columns as they were."""
    found = near_vectors(rows, id_col, label_col, vector_col, threshold)
    gone = materialise(found.where("NOT kept").select(F.col("vec_id").alias(id_col)).distinct(), "vectors-gone")
    return rows.join(checked(gone), id_col, "left_anti")
