"""Near duplicates by b-bit MinHash.

1. *Signatures.* One pass over the texts: the distinct word shingles are
   hashed, ``K`` independent minima taken, the low ``B`` bits of each minimum
   kept and packed, and the full minima folded into ``BANDS`` band keys of
   ``ROWS`` minima. Texts with the same words are one *class* from here on, its
   node is its smallest identifier; copies are never compared with each other.
2. *Candidates by stars.* In each band bucket every node is a candidate of the
   bucket's smallest node only: as many pairs as rows, never all pairs.
3. *Filter.* The packed signatures of a candidate pair are compared by XOR and a
   bit count; the share of equal lanes, corrected for chance collisions
   (``(m - 2^-B) / (1 - 2^-B)``), must reach the threshold less ``SIGMAS``
   standard errors.
4. *Confirm* on the full shingle sets, ``100 * both >= percent * either``.
5. *Components* of the confirmed links (alternating large and small stars, a
   written table per round).
6. *What stars can miss.* A bucket whose nodes lie in two or more components is
   looked at again, across its components. Shingles that only one of these
   nodes has are taken out; a node left with too few links with nothing (texts
   that share a passage and no more go here). The rest are compared by a bound
   that loses no link: two sets share at most the sum, over hash classes, of
   the smaller count. Pairs within the bound go through 3 and 4. A large bucket
   is compared in pairs of blocks, spread over tasks. Nothing is capped.

The threshold is the argument ``percent``: 85 in the query op4, 80 in the
pipeline's stage. A pair of exactly the threshold similarity is missed by all
bands with probability ``(1 - 0.85 ** 5) ** 25``, under one in two million, at 85
and ``(1 - 0.8 ** 5) ** 25``, about one in 20,000, at 80.

Defined cases: null, empty and blank texts have no shingle and are linked with
nothing; a text of fewer than five words has one shingle, the whole sequence; a
row without doc_id is linked with nothing, has a null component_id and is kept;
rows that repeat a doc_id count as one document (every text of that identifier
links); identifiers lie below 2^62; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.llm.common import (
    WordHasher,
    byte_views,
    checked,
    materialise,
    mix64,
    random_words,
    shingles,
    slices,
)

K, B, ROWS, BANDS = 128, 8, 5, 25
SHINGLE, PERCENT, SIGMAS = 5, 85, 6
#: Hash classes of the histograms, and nodes in a block of a large bucket.
CLASSES, BLOCK = 128, 256


class Signer:
    """Minima, packed low bits and band keys of a shingle set."""

    def __init__(self):
        self.factor = ((random_words(11, K) >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]
        self.shift = (random_words(12, K) >> np.uint64(32)).astype(np.uint32)[:, None]
        self.place = random_words(13, ROWS) | np.uint64(1)
        self.band = random_words(14, BANDS)

    def minima(self, items: np.ndarray) -> np.ndarray:
        low = np.full(K, 0xFFFFFFFF, np.uint32)
        small = (items >> np.uint64(32)).astype(np.uint32)
        for begin in range(0, len(small), 1024):
            part = small[None, begin:begin + 1024] * self.factor
            part ^= self.shift
            np.minimum(low, part.min(axis=1), out=low)
        return low

    def __call__(self, items: np.ndarray) -> tuple[bytes, np.ndarray]:
        low = self.minima(items)
        wide = mix64(low[:ROWS * BANDS].astype(np.uint64)).reshape(BANDS, ROWS)
        keys = mix64((wide * self.place).sum(axis=1, dtype=np.uint64) ^ self.band)
        return (low & np.uint32((1 << B) - 1)).astype(np.uint8).tobytes(), keys.view(np.int64)


def equal_lanes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the 8-bit lanes agree, for each row of packed signatures:
    XOR, fold every lane onto its lowest bit, count bits."""
    x = a.view(np.uint64) ^ b.view(np.uint64)
    x = x | (x >> np.uint64(4))
    x = x | (x >> np.uint64(2))
    x = (x | (x >> np.uint64(1))) & np.uint64(0x0101010101010101)
    return K - np.bitwise_count(x).sum(axis=1, dtype=np.int64)


def corrected(equal: np.ndarray) -> np.ndarray:
    """Similarity from equal lanes, less the collisions of truncated minima."""
    chance = 2.0 ** -B
    return (equal / K - chance) / (1 - chance)


SIGNED = "doc_id long, cls binary, n_shingles long, sig binary, bands array<long>"


def _sign_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, signer = WordHasher(lower=True), Signer()
    for batch in slices(batches):
        cls, count, sig, bands = [], [], [], []
        for text in byte_views(batch.column(1)):
            words = hasher(text) if text is not None else np.empty(0, np.uint64)
            items = shingles(words, SHINGLE)
            count.append(len(items))
            if len(items):
                packed, keys = signer(items)
                cls.append(hashlib.blake2b(words.tobytes(), digest_size=16).digest())
                sig.append(packed)
                bands.append(keys)
            else:
                cls.append(None)
                sig.append(None)
                bands.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(cls, pa.binary()), pa.array(count, pa.int64()),
             pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "cls", "n_shingles", "sig", "bands"])


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher(lower=True)
    for batch in slices(batches):
        sets = [shingles(hasher(t), SHINGLE).tobytes() for t in byte_views(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "items"])


def _alike_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    at_least = percent / 100 - SIGMAS * math.sqrt(percent / 100 * (1 - percent / 100) / K)
    for batch in batches:
        if batch.num_rows:
            a, b = (np.stack(list(byte_views(batch.column(i)))) for i in (2, 3))
            yield batch.filter(pa.array(corrected(equal_lanes(a, b)) >= at_least)).select([0, 1])


def _confirm_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for a, b in zip(byte_views(batch.column(2)), byte_views(batch.column(3))):
            a, b = (np.frombuffer(x.tobytes(), np.uint64) for x in (a, b))
            both = len(np.intersect1d(a, b, assume_unique=True))
            linked.append(100 * both >= percent * (len(a) + len(b) - both))
        yield batch.filter(pa.array(linked, pa.bool_())).select([0, 1])


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): the smallest node reachable, for every linked node.

    Alternating large-star and small-star; links shrink to stars in a few
    rounds. Every round is a written table; the driver sees a count and a hash.
    """
    links = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    links, before = materialise(links, "links"), None
    while True:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        links = materialise(small.select("e.*").where("a <> b").distinct(), "links")
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        before = now


def _confirm(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the signature filter and the full sets."""
    sig = nodes.select("node", "sig")
    likely = (pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
              .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")
              .select("a", "b", "sa", "sb").mapInArrow(partial(_alike_batches, percent=percent), "a long, b long"))
    return (likely.join(sets.select(F.col("node").alias("b"), F.col("items").alias("ib")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("items").alias("ia")), "a")
            .select("a", "b", "ia", "ib").mapInArrow(partial(_confirm_batches, percent=percent), "a long, b long"))


def _token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items = [np.frombuffer(x.tobytes(), np.int64) for x in byte_views(batch.column(1))]
        if items:
            nodes = np.repeat(batch.column(0).to_numpy(), [len(x) for x in items])
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate(items))], ["node", "token"])


def _profile_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Histograms of the shingles that some other node has too, over CLASSES
    hash classes; nodes too much of which is theirs alone go."""
    for batch in batches:
        node, size, histogram = [], [], []
        for i, items, alone in zip(batch.column(0).to_pylist(), byte_views(batch.column(1)), batch.column(2).to_pylist()):
            items = np.frombuffer(items.tobytes(), np.uint64)
            rest = np.setdiff1d(items, np.array(alone or [], np.int64).view(np.uint64), assume_unique=True)
            if 100 * len(rest) >= percent * len(items):
                node.append(i)
                size.append(len(items))
                counts = np.bincount((rest % np.uint64(CLASSES)).astype(np.int64), minlength=CLASSES)
                histogram.append(counts.astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(node, pa.int64()), pa.array(size, pa.int64()), pa.array(histogram, pa.binary())],
            ["node", "size", "histogram"])


def _compare(left: int, right: int, block: np.ndarray, node: np.ndarray, comp: np.ndarray, size: np.ndarray,
             histogram: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs across components that could reach the threshold: two sets share at
    most the sum of the smaller class counts."""
    a, b = [], []
    other = np.flatnonzero(block == right)
    for x in np.flatnonzero(block == left):
        y = other[comp[other] != comp[x]]
        if left == right:
            y = y[y > x]
        both = np.minimum(histogram[y], histogram[x]).sum(axis=1, dtype=np.int64)
        y = y[100 * both >= percent * (size[y] + size[x] - both)]
        a.append(np.maximum(node[y], node[x]))
        b.append(np.minimum(node[y], node[x]))
    return np.concatenate(a or [node[:0]]), np.concatenate(b or [node[:0]])


def _unit_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, left, right): each such run is a pair of blocks."""
    held: pa.Table | None = None

    def runs(table: pa.Table, last: bool):
        unit = np.stack([table.column(i).to_numpy() for i in range(3)])
        edge = np.flatnonzero((unit[:, 1:] != unit[:, :-1]).any(axis=0)) + 1
        ends = [*edge, table.num_rows] if last else list(edge)
        columns = [table.column(i).to_numpy() for i in range(1, 7)]
        packed = table.column(7).combine_chunks()
        histogram = np.stack(list(byte_views(packed))).view(np.uint32) if table.num_rows else None
        a, b = [], []
        for begin, end in zip([0, *ends], ends):
            left, right, block, node, comp, size = (c[begin:end] for c in columns)
            x, y = _compare(left[0], right[0], block, node, comp, size, histogram[begin:end], percent)
            a.append(x)
            b.append(y)
        pairs = pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c) if c else [], pa.int64()) for c in (a, b)], ["a", "b"])
        return pairs, table.slice(ends[-1] if ends else 0)

    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        pairs, held = runs(held, False)
        yield pairs
    if held is not None and held.num_rows:
        yield runs(held, True)[0]


def _across(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of one bucket that lie in different components and
    may reach the threshold.

    Shingles that no other node here has cannot be shared, so they are taken
    out first; a node that has too many links with nothing. A bucket of many
    nodes is compared in pairs of blocks, each a unit of work of its own.
    """
    items = sets.join(mixed.select("node").distinct(), "node")
    tokens = items.mapInArrow(_token_batches, "node long, token long")
    alone = (tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1")
             .groupBy("node").agg(F.collect_list("token").alias("alone")))
    profiles = materialise(items.join(alone, "node", "left").select("node", "items", "alone").mapInArrow(
        partial(_profile_batches, percent=percent), "node long, size long, histogram binary"), "profiles")
    rows = mixed.join(profiles, "node").withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("with", F.explode(F.expr("sequence(0L, blocks - 1)")))
    units = rows.select("key", F.least("block", "with").alias("left"), F.greatest("block", "with").alias("right"),
                        "block", "node", "comp", "size", "histogram")
    parts = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (units.repartition(parts, "key", "left", "right").sortWithinPartitions("key", "left", "right")
            .mapInArrow(partial(_unit_batches, percent=percent), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept. Texts of
    at least ``percent`` similarity are linked."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = materialise(texts.mapInArrow(_sign_batches, SIGNED), "signatures")
    classes = signed.where("cls IS NOT NULL AND doc_id IS NOT NULL").groupBy("cls").agg(
        F.min("doc_id").alias("node"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    nodes = materialise(classes, "nodes")

    bands = nodes.select("node", F.explode("bands").alias("key"))
    leads = bands.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("top")).where("lead < top")
    shared = materialise(bands.join(leads.select("key", "lead"), "key"), "shared-bands")
    wanted = checked(materialise(shared.select("node").distinct(), "wanted"))
    sets = materialise(texts.join(wanted, texts["doc_id"] == wanted["node"], "left_semi")
                       .where("text IS NOT NULL").mapInArrow(_set_batches, "node long, items binary"), "shingle-sets")
    stars = shared.where("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()
    links = materialise(_confirm(stars, nodes, sets, percent), "star-links")
    comps = components(links)

    placed = shared.select("key", "node").distinct().join(comps, "node", "left").select(
        "key", "node", F.coalesce("comp", "node").alias("comp"))
    several = (placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("lo"),
                                         F.max("comp").alias("hi")).where("lo < hi").select("key", "n"))
    mixed = materialise(placed.join(several, "key"), "mixed-buckets")
    pairs = _across(mixed, sets, percent).distinct().join(stars, ["a", "b"], "left_anti")
    more = materialise(_confirm(pairs, nodes, sets, percent), "more-links")
    if not more.isEmpty():
        comps = components(more.unionByName(comps.select(F.col("node").alias("a"), F.col("comp").alias("b"))))

    of = (signed.select("doc_id", "cls", "n_shingles")
          .join(nodes.select("cls", F.col("node").alias("own")), "cls", "left")
          .join(comps, F.col("own") == F.col("node"), "left"))
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "own", "doc_id"))
    return of.select("doc_id", "n_shingles", found.alias("component_id"),
                     F.coalesce(F.col("doc_id") == found, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group; columns as they were."""
    found = near_duplicates(docs, id_col, text_col, percent)
    gone = materialise(found.where("NOT kept").select(F.col("doc_id").alias(id_col)).distinct(), "near-gone")
    return docs.join(checked(gone), id_col, "left_anti")
