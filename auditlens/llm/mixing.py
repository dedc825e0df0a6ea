"""Mixing sources to target weights by a low-discrepancy schedule.

*Targets.* Sources in code-point order, null last, get the weights in turn
(5, 2, 1, 5, 2, 1, ...) and share all words by weight; a target stops at
``max_passes`` times its source's size and the excess goes to the others, by
weight, until none is above. That is one water level: ``target = min(cap,
level * weight)``.

*Blocks.* Each source's documents are shuffled by a hash of identifier and
seed and laid end to end. This stream is cut into blocks of equal words (they
differ by one word at most); a block may cut through a document.

*Schedule.* Slot ``i`` is the golden-ratio point ``i * phi mod 1``; it falls into
one source's interval of the cumulative weights, and that source's slots are
ranked: the r-th takes block ``r mod blocks`` in pass ``r div blocks``. Each
source stops at its target, in the middle of a block if need be. Any prefix of
the schedule is mixed in proportion, up to a few blocks.

Prefix sums and ranks go in two levels (sums per bucket, then inside a bucket),
so a source with a third of all rows is spread over ``BUCKETS`` tasks, and slots
are ranked in chunks. One row per source is gathered in one task; nothing else
is.

Defined cases: null, empty and blank texts have size 0 and are never taken; a
null source is one source, the last; rows that repeat doc_id or text are
separate documents; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from auditlens.llm.common import checked, fresh, materialise, word_count

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
#: Words in a block, unless a source is so small that it would have fewer than
#: MIN_BLOCKS, or the whole mix fewer than MIN_SLOTS slots.
BLOCK_WORDS, MIN_BLOCKS, MIN_SLOTS = 4096, 64, 1 << 16
BUCKETS, CHUNK, CELLS = 4096, 4096, 4096
#: Points are multiples of 2^-40; the odd step nearest 2^40 / golden ratio.
POINT_BITS = 40
STEP = int(2 ** POINT_BITS * (5 ** 0.5 - 1) / 2) | 1


def _shuffled(id_col: str, text_col: str, seed: int):
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))


def sized(docs: DataFrame, id_col="doc_id", source_col="source", text_col="text", seed: int = 0) -> DataFrame:
    """doc_id, source, skey (source, never null), size, order (the shuffle) and
    bucket (its leading bits); written once."""
    source = F.col(source_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), source.alias("source"),
                       F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("skey"),
                       word_count(F.col(text_col)).alias("size"),
                       _shuffled(id_col, text_col, seed).alias("order"))
    bucket = F.shiftright("order", 64 - (BUCKETS - 1).bit_length()).cast("int")
    return materialise(rows.withColumn("bucket", bucket), "sized")


def source_targets(per_source: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """Adds sid, weight and target to (source, source_size), one row per source;
    the only windows without a partition key are over these rows."""
    w = per_source.withColumn("sid", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = w.withColumn("weight", F.element_at(F.array(*(F.lit(float(x)) for x in weights)),
                                            (F.col("sid") % len(weights) + 1).cast("int")))
    w = w.withColumn("cap", max_passes * F.col("source_size"))
    # In order of the level at which a source is full, those before some point
    # are full and share no more; the first point whose level fills no other
    # source is the answer, and has the highest level of all such points.
    every = W.partitionBy()
    before = W.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(W.unboundedPreceding, -1)
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    w = w.withColumn("rest", rest).withColumn("open", open_weight)
    level = F.when(F.col("rest") * F.col("weight") <= F.col("cap") * F.col("open"), F.col("rest") / F.col("open"))
    w = w.withColumn("level", F.max(level).over(every))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return w.withColumn("target", target).drop("cap", "rest", "open", "level")


def _sources(rows: DataFrame, weights, max_passes: int) -> DataFrame:
    """Per source: sid, target, its blocks (n_blocks, the first ``wide`` of them
    one word longer than ``narrow``), its quota of words, and its interval
    [lo, hi) of the points; written once."""
    sizes = rows.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    s = source_targets(sizes, weights, max_passes)
    every, upto = W.partitionBy(), W.orderBy("sid")
    total = F.sum("source_size").over(every)
    block = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(total / MIN_SLOTS)))
    n_blocks = F.least("source_size", F.greatest(F.lit(MIN_BLOCKS), F.floor(F.col("source_size") / block)))
    s = s.withColumn("n_blocks", n_blocks.cast("long")).withColumn("quota", F.round("target").cast("long"))
    some = F.col("n_blocks") > 0
    s = (s.withColumn("narrow", F.when(some, F.expr("source_size div n_blocks")).otherwise(1))
         .withColumn("wide", F.when(some, F.expr("source_size % n_blocks")).otherwise(0))
         .withColumn("slots", F.when(some, F.col("target") * F.col("n_blocks") / F.col("source_size")).otherwise(0.0)))
    share = F.when(F.sum("slots").over(every) > 0, F.sum("slots").over(upto) / F.sum("slots").over(every))
    s = s.withColumn("hi", F.floor(F.coalesce(share, F.lit(0.0)) * 2 ** POINT_BITS))
    return materialise(s.withColumn("lo", F.lag("hi", 1, 0).over(upto)), "sources")


def _before(rows: DataFrame, keys: list[str], value: str, name: str, order: list[str], extra: DataFrame | None = None
            ) -> DataFrame:
    """The sum of ``value`` over the earlier rows of keys[0], where keys[1] is
    the leading part of the order; ``extra`` adds columns by keys[0]."""
    sums = rows.groupBy(*keys).agg(F.sum(value).alias("in_bucket"))
    ahead = W.partitionBy(keys[0]).orderBy(keys[1]).rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("in_bucket").over(ahead), F.lit(0))).drop("in_bucket")
    if extra is not None:
        sums = sums.join(extra, keys[0])
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (rows.join(sums, keys)
            .withColumn(name, F.col("ahead") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("ahead"))


def _slots(sources: DataFrame, max_passes: int) -> DataFrame:
    """slot, sid, pass, block, take (words of the block): every source's slots,
    up to its quota.

    Golden-ratio points hit an interval of share p once in any 3 / p of them,
    and miss their mean by a few; so the schedule goes on by 12 / p for the
    smallest p, at most as long again, and full sources take no more.
    """
    stats = sources.where("slots > 0").agg(F.sum("slots").alias("all"), F.min("slots").alias("least")).first()
    n = math.ceil(stats["all"] or 0)
    n += min(n, math.ceil(12 * n / stats["least"])) if n else 0
    low = 1 << POINT_BITS // 2
    high_part = (F.shiftright("id", POINT_BITS // 2) % low * STEP % low) * low
    point = (high_part + F.col("id") % low * STEP) % (1 << POINT_BITS)
    width = POINT_BITS - (CELLS - 1).bit_length()
    slots = (sources.sparkSession.range(n).withColumn("point", point)
             .withColumn("cell", F.shiftright("point", width)).withColumn("chunk", F.floor(F.col("id") / CHUNK)))
    cells = sources.where("hi > lo").withColumn(
        "cell", F.explode(F.sequence(F.shiftright("lo", width), F.shiftright(F.col("hi") - 1, width))))
    hit = slots.join(cells, "cell").where("point >= lo AND point < hi").withColumn("one", F.lit(1).cast("long"))
    ranked = _before(hit, ["sid", "chunk"], "one", "rank", ["id"])
    taken = (ranked.withColumn("pass", F.expr("rank div n_blocks")).where(F.col("pass") < max_passes)
             .withColumn("block", F.expr("rank % n_blocks"))
             .withColumn("begin", F.expr("pass * source_size + block * narrow + least(block, wide)"))
             .withColumn("take", F.expr("least(narrow + if(block < wide, 1, 0), quota - begin)")).where("take > 0"))
    return taken.select(F.col("id").alias("slot"), "sid", "pass", "block", "take")


def schedule(rows: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """The mix of ``sized`` rows, one row per piece of a document that a slot
    takes: slot, pass, block, from_word, n_words, beside the document's
    doc_id, source, size, order, start, source_size and target. Documents that
    no slot takes have one row with a null slot. Slot by slot, block by block,
    the rows are the mixed stream."""
    sources = _sources(rows, weights, max_passes)
    by = sources.select("skey", "sid", "source_size", "target", "n_blocks", "narrow", "wide")
    placed = _before(rows, ["skey", "bucket"], "size", "start", ["order", "doc_id", "size"], by)
    at = "if({0} < wide * (narrow + 1), {0} div (narrow + 1), wide + ({0} - wide * (narrow + 1)) div narrow)"
    blocks = F.when(F.col("size") > 0, F.expr(f"sequence({at.format('start')}, {at.format('(start + size - 1)')})"))
    piece = (placed.withColumn("block", F.explode_outer(blocks))
             .withColumn("block_start", F.expr("block * narrow + least(block, wide)"))
             .withColumn("block_end", F.expr("block_start + narrow + if(block < wide, 1, 0)"))
             .withColumn("first", F.greatest("start", "block_start"))
             .withColumn("words", F.least(F.expr("start + size"), F.col("block_end")) - F.col("first")))
    mixed = piece.join(_slots(sources, max_passes), ["sid", "block"], "left")
    n_words = F.expr("greatest(0L, least(coalesce(take, 0L) - (first - block_start), words))")
    return mixed.select("slot", "pass", "block", F.expr("first - start").alias("from_word"), n_words.alias("n_words"),
                        "doc_id", "source", "size", "order", "sid", "start", "source_size", "target")


def mix(docs: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES, id_col="doc_id", source_col="source",
        text_col="text", seed: int = 0) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, source
    and order (the shuffle)."""
    pieces = schedule(sized(docs, id_col, source_col, text_col, seed), weights, max_passes)
    # a document is known by its place in its source's stream; empty ones by
    # their hash too (equal rows of size 0 keep their number)
    some = pieces.where("size > 0").groupBy("sid", "start").agg(
        *(F.first(c).alias(c) for c in ("doc_id", "source", "order", "size", "source_size", "target")),
        F.sum(F.coalesce("n_words", F.lit(0).cast("long"))).alias("taken"))
    none = pieces.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    columns = ["doc_id", "size", "source_size", "target", "taken", "source", "order"]
    return some.select(columns).unionByName(none.select(columns))


def mixed_documents(docs: DataFrame, id_col="doc_id", source_col="source", text_col="text", seed: int = 0,
                    **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its words were
    taken, to the nearest whole number; columns as they were.

    A source's blocks are taken in turn from the first, so all its documents
    are taken n or n + 1 times, the more often ones first; one row per source
    (n and the last hash of those) says it all, and the texts are not shuffled.
    """
    found = mix(docs, id_col=id_col, source_col=source_col, text_col=text_col, seed=seed, **options)
    times = (found.where("size > 0").withColumn("times", F.floor(F.col("taken") / F.col("size") + 0.5).cast("int"))
             .groupBy("source", "times").agg(F.max("order").alias("last")))
    times = times.groupBy("source").agg(
        F.min("times").alias("least"), F.max("times").alias("most"), F.max_by("last", "times").alias("last"))
    times = checked(materialise(times, "mix-times"))
    order, again = fresh(docs, "order"), fresh(docs, "again")
    out = docs.withColumn(order, _shuffled(id_col, text_col, seed)).alias("d").join(
        times.alias("t"), F.col(f"d.{source_col}").cast("string").eqNullSafe(F.col("t.source")))
    copies = F.when(F.col(f"d.{order}") <= F.col("t.last"), F.col("t.most")).otherwise(F.col("t.least"))
    copies = F.when(word_count(F.col(f"d.{text_col}")) > 0, copies).otherwise(0)
    every = F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array())
    return out.select("d.*", F.explode(every).alias(again)).select(*docs.columns)
