"""Hard negatives by threshold joins in the manner of L2AP.

Scores are integer inner products of the floors of ``SCALE`` times the components. For
every anchor the best rows of its own label are its positives; for every positive the
hard negatives are the best rows of other labels whose score lies in a window below
the positive's.

1. *Threshold joins.* Anchors (a stated set of queries) meet all rows in pairs of
   blocks. A unit holds an inverted index of its rows, dimension by dimension, the
   dimensions of most energy first. A row's entries stop where the norm of the rest
   of it times that of the rest of any anchor stays below the threshold: those
   dimensions alone can lift no pair over it. Partial scores are
   accumulated over the index, a few dimensions at a time; a pair goes as soon as
   its partial score plus the product of the remaining norms is below the anchor's
   threshold. Pairs that are left get their exact score.
2. *Lower thresholds until windows fill.* The first join asks for scores from a large
   share on. An anchor whose positives (or windows) are not full takes part in the
   next join with a lower threshold; the last one asks for all that may count. What a
   join returns is complete from its threshold on, so a full window is final.
3. *Only the best go on.* A unit passes on no more than the wanted number of rows for each
   anchor or window, so a label or a group of copies of any size is never
   gathered: best of a unit, then best of all.

Defined cases: rows with null identifier, null label, null vector, or a null or
non-finite component take no part, nor do rows whose squared integer length reaches
2^55 (components of some 700,000), whose scores a long could not hold. Of rows that
repeat an identifier the one of smallest label, then vector, takes part. An empty vector
scores 0; of vectors of different lengths the missing components count as 0. A positive of
negative score has an empty window. Ties go to the smaller identifier. An empty table
gives no row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlens.llm.common import materialise, slices

SCALE = 256
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
#: Thresholds of the joins: shares of an anchor's own squared length for the positives
#: (None: all rows), percentages of the positive's score for the negatives.
POSITIVE_SHARES, NEGATIVE_PERCENTS = (0.6, 0.35, 0.2, None), (85, 70)
#: Rows and anchors in a block, rows that a block has at least where there are
#: fewer blocks than shuffle partitions, and dimensions accumulated at a time.
ROWS, ANCHORS, FEW, STEP = 8192, 1024, 256, 8


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packed integer components and their squares' sum; null where the vector
    takes no part."""
    from auditlens.llm.multi_index import valid_vectors

    for batch in slices(batches):
        packed, length = [], []
        lists = batch.column(2)
        for x, null, empty in zip(valid_vectors(lists), lists.is_null().to_pylist(),
                                  (n == 0 for n in lists.value_lengths().fill_null(1).to_pylist())):
            if empty and not null:
                packed.append(b"")
                length.append(0.0)
                continue
            whole = None if x is None else np.floor(SCALE * x.astype(np.float64))
            fits = whole is not None and np.abs(whole).max() < 2.0 ** 28 and (whole * whole).sum() < 2.0 ** 55
            packed.append(whole.astype(np.int32).tobytes() if fits else None)
            length.append(float((whole * whole).sum()) if fits else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary()), pa.array(length, pa.float64())],
            ["vec_id", "label", "vec", "squares"])


def _matrix(packed: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(packed), width), np.int64)
    for row, v in zip(out, packed.to_pylist()):
        x = np.frombuffer(v, np.int32)
        row[:len(x)] = x
    return out


def _rest(x: np.ndarray) -> np.ndarray:
    """Norms of what remains of each row from dimension 0, 1, .. to the end on."""
    squares = np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate((squares, np.zeros((len(x), 1))), axis=1))


class Index:
    """Rows of a block, their dimensions in the order of energy."""

    def __init__(self, rows: np.ndarray):
        self.order = np.argsort(-(rows.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.whole = rows
        self.rows = rows[:, self.order].astype(np.float64)
        self.rest = _rest(self.rows)

    def join(self, anchors: np.ndarray, least: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, ...]:
        """(anchor, row, score) of the ``allowed`` pairs with a score from the
        anchor's ``least`` on."""
        n, dims = self.rows.shape
        q = anchors[:, self.order].astype(np.float64)
        rest = _rest(q)
        bar = least - 1e-6 * (1 + np.abs(least))  # nothing is lost to rounding
        if (bar > 0).all():  # a row is listed up to the dimension from which its rest can lift no pair
            cut = (self.rest * (rest / bar[:, None]).max(axis=0)[None, :] >= 1).sum(axis=1)
            at = np.argsort(-cut, kind="stable")
            at = at[cut[at] > 0]
        else:  # any score counts
            cut, at = np.full(n, dims), np.arange(n)
        cuts, alive = cut[at], allowed[:, at]
        entries = np.where(np.arange(dims)[None, :] < cuts[:, None], self.rows[at], 0)
        omitted = rest[:, cuts] * self.rest[at, cuts][None, :]
        score = np.zeros((len(q), len(at)))
        for begin in range(0, dims, STEP):
            end = min(begin + STEP, dims)
            some = int((cuts > begin).sum())  # rows that the index lists from here on
            if not some:
                break
            score[:, :some] += q[:, begin:end] @ entries[:some, begin:end].T
            if begin % (2 * STEP):  # every other time: prune by what remains
                remaining = np.maximum(rest[:, end, None] * self.rest[at, end][None, :], omitted)
                alive &= score + remaining >= bar[:, None]
                keep = alive.any(axis=0)
                if keep.sum() < 0.7 * len(keep):
                    at, cuts, entries, omitted = at[keep], cuts[keep], entries[keep], omitted[:, keep]
                    score, alive = score[:, keep], alive[:, keep]
        a, r = np.nonzero(alive & (score + omitted >= bar[:, None]))
        r = at[r]
        exact = np.empty(len(a), np.int64)
        for begin in range(0, len(a), 1 << 16):
            part = slice(begin, begin + (1 << 16))
            exact[part] = (anchors[a[part]] * self.whole[r[part]]).sum(axis=1)
        keep = exact >= least[a]
        return a[keep], r[keep], exact[keep]


def _best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Positions of the first ``n`` of each group: highest score, then smallest id."""
    order = np.lexsort((ids, -score, group))
    ranked = group[order]
    first = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(order) else np.empty(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0)) if len(order) else first
    return order[np.arange(len(order)) - start < n]


def _blocks(rows: pa.Table, anchors: pa.Table):
    """Per run of anchors: their positions, labels, joined matrix and the index of the rows."""
    packed = rows["vec"].combine_chunks(), anchors["vec"].combine_chunks()
    width = max(max(len(v) for v in p.to_pylist()) for p in packed) // 4
    index = Index(_matrix(packed[0], width))
    matrix = _matrix(packed[1], width)
    ids, own_ids = rows["vec_id"].to_numpy(), anchors["vec_id"].to_numpy()
    names = np.array(rows["label"].to_pylist() + anchors["label"].to_pylist(), object)
    number = {name: i for i, name in enumerate(dict.fromkeys(names))}
    codes = np.array([number[name] for name in names])
    labels, own = codes[:len(ids)], codes[len(ids):]
    for begin in range(0, len(matrix), 256):
        part = np.arange(begin, min(begin + 256, len(matrix)))
        yield part, index, matrix[part], own[part][:, None] == labels[None, :], own_ids[part][:, None] == ids[None, :], ids


FOUND = "anchor_id long, place int, other_id long, score long"
_FOUND = pa.schema([("anchor_id", pa.int64()), ("place", pa.int32()), ("other_id", pa.int64()), ("score", pa.int64())])


def _positives(rows: pa.Table, anchors: pa.Table, n: int) -> pa.Table:
    """Unit of a join: the best rows of the same label, from the anchor's threshold on."""
    out = []
    if rows.num_rows and anchors.num_rows:
        least = anchors["least"].to_numpy()
        anchor_id = anchors["vec_id"].to_numpy()
        for part, index, matrix, same, itself, ids in _blocks(rows, anchors):
            a, r, s = index.join(matrix, least[part], same & ~itself)
            best = _best(a, s, ids[r], n)
            out.append(pa.table([anchor_id[part][a[best]], np.zeros(len(best), np.int32), ids[r[best]], s[best]],
                                schema=_FOUND))
    return pa.concat_tables(out) if out else _FOUND.empty_table()


def _negatives(rows: pa.Table, anchors: pa.Table, n: int, low: int, high: int) -> pa.Table:
    """Unit of a join: per window of an anchor the best rows of other labels."""
    out = []
    if rows.num_rows and anchors.num_rows:
        anchor_id = anchors["vec_id"].to_numpy()
        windows = anchors["windows"].to_pylist()
        for part, index, matrix, same, itself, ids in _blocks(rows, anchors):
            mine = [windows[i] for i in part]
            least = np.array([min(w["least"] for w in ws) for ws in mine], np.float64)
            a, r, s = index.join(matrix, least, ~same & ~itself)
            for k in range(max(len(ws) for ws in mine)):
                has = np.array([len(ws) > k for ws in mine])
                window = [ws[k] if len(ws) > k else {"least": 0, "score": -1, "place": -1} for ws in mine]
                at_least, score, place = (np.array([w[f] for w in window], np.int64) for f in ("least", "score", "place"))
                fits = np.flatnonzero(has[a] & (s >= at_least[a]) & (low * score[a] <= 100 * s) & (100 * s <= high * score[a]))
                best = fits[_best(a[fits], s[fits], ids[r[fits]], n)]
                out.append(pa.table([anchor_id[part][a[best]], place[a[best]].astype(np.int32), ids[r[best]], s[best]],
                                    schema=_FOUND))
    return pa.concat_tables(out) if out else _FOUND.empty_table()


def _join(rows: DataFrame, blocks: int, anchors: DataFrame, unit, n: int, name: str) -> DataFrame:
    """One threshold join: the best ``n`` per anchor and place over all units."""
    runs = max(1, -(-anchors.count() // ANCHORS))
    anchors = anchors.withColumn("run", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(runs)))
    anchors = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    rows = rows.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(runs - 1).cast("long"))))
    found = rows.groupBy("block", "run").cogroup(anchors.groupBy("block", "run")).applyInArrow(unit, FOUND)
    order = Window.partitionBy("anchor_id", "place").orderBy(F.col("score").desc(), "other_id")
    return materialise(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n), name)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def hard_negatives(rows: DataFrame, anchor_every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, id_col: str = "vec_id", label_col: str = "label",
                   vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for
    each anchor (identifier divisible by ``anchor_every``) and each of its
    ``positives``, the best ``negatives`` rows of other labels that score between
    ``low`` and ``high`` percent of the positive."""
    read = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                       F.col(vector_col).cast("array<double>").alias("x"))
    read = read.where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    read = read.mapInArrow(_read_batches, "vec_id long, label string, vec binary, squares double").where("vec IS NOT NULL")
    one = read.groupBy("vec_id").agg(F.min(F.struct("label", "vec", "squares")).alias("r"))
    read = materialise(one.select("vec_id", "r.*"), "integer-vectors")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = read.count()
    blocks = max(1, -(-size // ROWS), min(-(-size // FEW), parts))
    anchors = read.where(F.col("vec_id") % anchor_every == 0)

    best = _fill_positives(read, blocks, anchors, positives)
    windows = best.where("score >= 0").select(
        F.col("anchor_id").alias("vec_id"), F.col("rank").alias("place"), F.col("score").alias("positive_score"),
        F.col("other_id").alias("positive_id"))
    found = _fill_windows(read, blocks, anchors, windows, negatives, low, high)
    return found.join(windows.withColumnRenamed("vec_id", "anchor_id"), ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def _fill_positives(rows: DataFrame, blocks: int, anchors: DataFrame, n: int) -> DataFrame:
    """(anchor_id, other_id, score, rank): the first ``n`` other rows of the label."""
    unit, rows, done = partial(_positives, n=n), rows.drop("squares"), []
    for share in POSITIVE_SHARES:
        least = F.lit(-1e300) if share is None else F.col("squares") * share
        found = _join(rows, blocks, anchors.withColumn("least", least), unit, n, "positives")
        if share is None:
            done.append(found)
            break
        full = found.where(F.col("rank") == n).select(F.col("anchor_id").alias("vec_id"))
        done.append(found.join(full.withColumnRenamed("vec_id", "anchor_id"), "anchor_id", "left_semi"))
        anchors = materialise(anchors.join(full, "vec_id", "left_anti"), "open-anchors")
        if anchors.isEmpty():
            break
    return materialise(_union(done), "positives")


def _fill_windows(rows: DataFrame, blocks: int, anchors: DataFrame, windows: DataFrame, n: int, low: int,
                  high: int) -> DataFrame:
    """(anchor_id, place, other_id, score, rank): the first ``n`` rows of every window."""
    unit, rows, done = partial(_negatives, n=n, low=low, high=high), rows.drop("squares"), []
    windows = windows.select("vec_id", "place", F.col("positive_score").alias("score"))
    for percent in [p for p in NEGATIVE_PERCENTS if low < p < high] + [low]:
        least = F.expr(f"({percent} * score + 99) div 100").alias("least")
        asked = windows.select("vec_id", F.struct(least, "score", "place").alias("w")).groupBy("vec_id").agg(
            F.collect_list("w").alias("windows"))
        asked = materialise(anchors.drop("squares").join(asked, "vec_id"), "asked-windows")
        found = _join(rows, blocks, asked, unit, n, "negatives")
        if percent == low:
            done.append(found)
            break
        full = found.where(F.col("rank") == n).select("anchor_id", "place")
        done.append(found.join(full, ["anchor_id", "place"], "left_semi"))
        windows = materialise(windows.join(full.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "place"], "left_anti"),
                              "open-windows")
        if windows.isEmpty():
            break
    return _union(done)
