"""Conflict-constrained best-fit packing of documents into sequences.

Documents are measured in words and cut into pieces of at most ``capacity``;
full pieces are bins of their own. The rest are packed shard by shard, longest
first. A bin carries two bitmaps: the sources and the duplicate clusters (equal
normalised texts) it holds. A piece may not enter a bin that already holds its
cluster, nor one in which its source has no place left. Open bins are kept ordered by residual;
the search takes the smallest residual that fits and goes on to its successors
until it meets a compatible bin, which is then the tightest one; if there is
none, a bin is opened.

A source has one place in a bin. A *hot* source, one with more pieces to pack
than all those pieces need bins (their words over ``capacity``, rounded up),
cannot be spread so: it has ``ceil(its pieces / bins needed)`` places, each a bit
of its own, whatever the number and the shares of the sources.

Shards are dealt by a hash of the row, about ``shard_words`` words each, so a
shard's pieces fit in one task at any input size. Equal rows travel as one row
with a count, dealt in parts of at most ``PART`` copies, so a row that is
repeated without end does not fill one shard.

Defined cases: null, empty and blank texts have no words and get one row
without a bin; a null source is one source; equal rows are packed one by one,
each into its own bin; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.llm.common import materialise, normalised, word_count

CAPACITY, SHARD_WORDS, PART = 2048, 1_000_000, 256

PACKED = "doc_id long, copy long, piece long, n_words long, bin_id long, offset long, bin_words long"


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int,
             places: list[int] | None = None) -> tuple[list[int], list[int]]:
    """Bin and offset for each piece, in the given order.

    sources, clusters: numbers, -1 for none. places: how many pieces of each
    source a bin may hold, one if not given. Pieces that equal the piece before
    them in all three go on from where its search ended, or in its bin while
    that has room: the bins passed stay too small or in conflict.
    """
    places = [1] * (max(sources, default=-1) + 1) if places is None else places
    ends = list(accumulate(places))
    masks = [(1 << end) - (1 << end - n) for end, n in zip(ends, places)]
    open_bins: list[tuple[int, int]] = []  # (residual, bin), ascending
    holds_source: list[int] = []
    holds_cluster: list[int] = []
    bins, offsets, last, after, again = [], [], None, (0, -1), None
    for size, source, cluster in zip(sizes, sources, clusters):
        s = masks[source] if source >= 0 else 0
        c = 1 << cluster if cluster >= 0 else 0
        now = (size, source, cluster)
        same = now == last and (s or c)
        at = bisect_left(open_bins, (again or after) if same else (size, -1))
        while at < len(open_bins):
            b = open_bins[at][1]
            if not (s and holds_source[b] & s == s or holds_cluster[b] & c):
                break
            at += 1
        last = now
        if at < len(open_bins):
            residual, b = found = open_bins.pop(at)
        else:
            residual, b = capacity, len(holds_source)
            found = (capacity + 1, 0)
            holds_source.append(0)
            holds_cluster.append(0)
        if not (same and again):
            after = found
        bins.append(b)
        offsets.append(capacity - residual)
        free = s & ~holds_source[b]
        holds_source[b] |= free & -free  # the lowest free place
        holds_cluster[b] |= c
        if residual > size:
            insort(open_bins, (residual - size, b))
        more = not c and free & (free - 1) and residual - size >= size
        again = (residual - size, b) if more else None
    return bins, offsets


def _numbers(values: pd.Series, places: pd.Series) -> tuple[list[int], list[int]]:
    """Numbers of the values that occur more often than they have places in a
    bin, -1 for the others, which can meet no conflict; places by number."""
    codes, _ = pd.factorize(values, use_na_sentinel=False)
    held = np.zeros(codes.max() + 1 if len(codes) else 0, np.int64)
    held[codes] = places
    often = np.bincount(codes, minlength=len(held)) > held
    number = np.where(often, np.cumsum(often) - 1, -1)
    return number[codes].tolist(), held[often].tolist()


def _pack_shard(capacity: int, hot: dict[str | None, int]):
    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["source", "cluster", "id", "first_copy"], na_position="last", kind="stable")
        times = rows["rows"].to_numpy()
        rows = rows.loc[rows.index.repeat(times)].reset_index(drop=True)
        rows["copy"] = rows["first_copy"] + np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
        full = (rows["n_words"] // capacity).to_numpy()
        rows["rest"] = rows["n_words"] % capacity
        rest = rows[rows["rest"] > 0].sort_values("rest", ascending=False, kind="stable")
        held = [hot.get(None if pd.isna(x) else x, 1) for x in rest["source"]]
        sources, places = _numbers(rest["source"], pd.Series(held, rest.index, "int64"))
        clusters, _ = _numbers(rest["cluster"], pd.Series(1, rest.index))
        bins, offsets = best_fit(rest["rest"].tolist(), sources, clusters, capacity, places)
        packed = pd.DataFrame({"doc_id": rest["id"], "copy": rest["copy"], "piece": full[rest.index],
                               "n_words": rest["rest"], "bin_id": bins, "offset": offsets})
        packed["bin_words"] = packed.groupby("bin_id")["n_words"].transform("sum")
        whole = rows.loc[rows.index.repeat(full)]
        whole = pd.DataFrame({"doc_id": whole["id"], "copy": whole["copy"],
                              "piece": np.arange(len(whole)) - np.repeat(np.cumsum(full) - full, full),
                              "n_words": capacity, "bin_id": np.arange(len(whole)) + max(bins, default=-1) + 1,
                              "offset": 0, "bin_words": capacity})
        out = pd.concat([packed, whole])
        out["bin_id"] += int(key[0]) << 32
        return out.astype({"doc_id": "Int64"})
    return pack


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_words: int = SHARD_WORDS,
         id_col="doc_id", source_col="source", text_col="text") -> DataFrame:
    """One row per piece: doc_id, copy (0, 1, ... among equal rows), piece,
    n_words, bin_id, offset (its first word's place in the bin), bin_words."""
    rows = materialise(docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("n_words"),
        F.xxhash64(F.lower(normalised(F.col(text_col)))).alias("cluster")), "pack-rows")
    rest = F.col("n_words") % capacity
    total = rows.agg(F.sum("n_words").alias("words"), F.sum(rest).alias("rest")).first()
    shards = max(1, -(-(total["words"] or 0) // shard_words))
    needed = max(1, -(-(total["rest"] or 0) // capacity))
    # a piece has a word, so there are at most ``capacity`` hot sources
    hot = {r["source"]: -(-r["count"] // needed) for r in
           rows.where(rest > 0).groupBy("source").count().where(F.col("count") > needed).collect()}
    once = rows.groupBy("id", "source", "n_words", "cluster").agg(F.count(F.lit(1)).alias("all"))
    part = (once.where("n_words > 0")
            .withColumn("first_copy", F.explode(F.expr(f"sequence(0L, all - 1, {PART}L)")))
            .withColumn("rows", F.least(F.col("all") - F.col("first_copy"), F.lit(PART)))
            .withColumn("shard", F.pmod(F.xxhash64("id", "source", "cluster", "first_copy"), F.lit(shards))))
    packed = part.groupBy("shard").applyInPandas(_pack_shard(capacity, hot), PACKED)
    none = (once.where("n_words = 0").withColumn("copy", F.explode(F.expr("sequence(0L, all - 1)")))
            .select(F.col("id").alias("doc_id"), "copy", F.lit(0).cast("long").alias("piece"), "n_words",
                    F.lit(None).cast("long").alias("bin_id"), F.lit(None).cast("long").alias("offset"),
                    F.lit(None).cast("long").alias("bin_words")))
    return packed.unionByName(none)
