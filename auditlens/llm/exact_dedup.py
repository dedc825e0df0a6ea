"""Exact duplicates by a tree-merge of sorted digest runs.

Every row becomes ``(digest, byte length, second fingerprint, doc_id)``. The
rows start in *lanes* dealt by identifier, so that a group of copies, however
large, is spread over all lanes. Each lane holds one run, sorted by digest and
collapsed to ``(digest, smallest identifier, rows)``. In each binomial round
the lanes that differ only in the next few bits exchange their runs: a lane
receives the runs of ``2 ** bits`` lanes, restricted to the digests whose lane
bits equal its own, sorts them together and collapses them again. After
``log(lanes) / bits`` rounds a digest lives in one lane only, and no lane ever
received more than ``2 ** bits`` rows of one digest, or gathered a whole group.

"Verified" means that rows merge only if the SHA-256 digest, the byte length
and an independent 64-bit fingerprint of the normalised text all agree, at
every level.

Defined cases: null text counts as empty; empty texts are equal to one another;
a null doc_id is never the one that stays unless the whole group has none;
rows that repeat both doc_id and text count one by one, and one of them stays;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.llm.common import checked, fresh, materialise, normalised

KEY = ["sha", "n_bytes", "check"]


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct (identifier, text) with its number of rows."""
    text = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("t"))
    keyed = text.select("id", F.unhex(F.sha2("t", 256)).alias("sha"),
                        F.octet_length("t").cast("long").alias("n_bytes"), F.xxhash64("t").alias("check"))
    return keyed.groupBy("id", *KEY).agg(F.count(F.lit(1)).alias("rows"))


def _collapse(runs: DataFrame, lanes: int) -> DataFrame:
    """Send each lane's rows to it, sort, and merge equal digests in order
    (a streaming sort aggregation over the sorted runs)."""
    return (runs.repartitionById(lanes, F.col("lane").cast("int"))
            .sortWithinPartitions("lane", *KEY)
            .groupBy("lane", *KEY)
            .agg(F.min("least").alias("least"), F.sum("rows").alias("rows")))


def merge_runs(rows: DataFrame, lanes: int | None = None, bits: int = 3) -> DataFrame:
    """``digest_rows`` -> one row per digest: KEY, keep_id, group_size.

    lanes: a power of two; by default the next one from the session's number
    of shuffle partitions. bits: a round merges ``2 ** bits`` runs.
    """
    if lanes is None:
        lanes = 1 << (int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    home = F.xxhash64(F.col("sha")).bitwiseAND(F.lit(lanes - 1))
    runs = rows.select(*KEY, "rows", F.struct(F.col("id").isNull().alias("none"), "id").alias("least"),
                       F.xxhash64("id", "sha").bitwiseAND(F.lit(lanes - 1)).alias("lane"))
    runs = _collapse(runs, lanes)
    for low in range(0, (lanes - 1).bit_length(), bits):
        own = ((1 << bits) - 1) << low
        lane = F.col("lane").bitwiseAND(F.lit((lanes - 1) & ~own)).bitwiseOR(home.bitwiseAND(F.lit(own)))
        runs = _collapse(runs.withColumn("lane", lane), lanes)
    return runs.select(*KEY, F.col("least.id").alias("keep_id"), F.col("rows").alias("group_size"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     lanes: int | None = None, bits: int = 3) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = materialise(digest_rows(docs, id_col, text_col), "exact-rows")
    groups = merge_runs(rows, lanes, bits).where("group_size > 1")
    found = rows.join(groups, KEY, "left")
    stays = F.when(F.col("group_size").isNull(), F.lit(True)).otherwise(F.col("id").eqNullSafe(F.col("keep_id")))
    return (found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
            .select(F.col("id").alias("doc_id"),
                    F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                    (stays & (F.col("copy") == 1)).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that do not stay; columns as they were.

    The rows to drop are found by identifier. Only rows that repeat an
    identifier, or have none, need their text's digest to tell them apart.
    """
    found = materialise(exact_duplicates(docs, id_col, text_col, **options), "exact-found")
    gone = materialise(found.where("NOT kept").select(F.col("doc_id").alias(id_col)).distinct(), "exact-gone")
    unclear = materialise(found.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select("doc_id"),
                          "exact-unclear")
    clear = docs.join(checked(gone), id_col, "left_anti")
    if unclear.isEmpty():
        return clear
    match = F.col(f"d.{id_col}").eqNullSafe(F.col("u.doc_id"))
    sha = fresh(docs, "sha")
    odd = docs.alias("d").join(unclear.alias("u"), match, "left_semi")
    odd = odd.withColumn(sha, F.sha2(normalised(F.col(text_col)), 256))
    stay = F.col(f"d.{id_col}").eqNullSafe(F.col("s.doc_id")) & (F.col(f"d.{sha}") == F.col("s.text_sha256"))
    odd = (odd.alias("d").join(found.where("kept").alias("s"), stay, "left_semi")
           .dropDuplicates([id_col, sha]).select(*docs.columns))
    return clear.alias("d").join(unclear.alias("u"), match, "left_anti").unionByName(odd)
