"""Chat formatting by perspective rotation.

For every participant of a conversation the dialogue is rendered once with that
speaker as the assistant, the others as named users, and masks over the
assistant's words. System turns are the setting: rendered in every perspective,
participants in none.

A conversation is cut into segments of ``turns`` turns, in turn order, so a
conversation of any length is rendered by many tasks; a segment's text and mask
offsets are its own, and segments follow one another by number. Turns are
ranked in two levels (counts per bucket of turn numbers, then inside one).

Defined cases: a null or empty role is the participant ``unknown``; a null text
is an empty turn; a null turn number comes last; turns of one number are ordered
by role and text; repeated rows are turns of their own; null conv_id is one
conversation; a conversation of system turns only has no perspective and gives
no row; extra columns are ignored. ``<|`` in names or texts is written ``< |``, so
a text cannot pose as a marker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from auditlens.llm.common import materialise

SYSTEM = ("system",)
TURNS, BUCKET = 64, 256
END = "<|end|>\n"


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _ranked(rows: DataFrame) -> DataFrame:
    """Adds rank, the number of the conversation's turns before this one."""
    at = F.struct(F.col("turn").isNull().alias("none"), F.floor(F.col("turn") / BUCKET).alias("b"))
    rows = rows.withColumn("bucket", at)
    counts = rows.groupBy("conv", "bucket").agg(F.count(F.lit(1)).alias("n"))
    ahead = W.partitionBy("conv").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0).cast("long"))).drop("n")
    inside = W.partitionBy("conv", "bucket").orderBy("turn", "role", "text")
    same = F.expr("r.conv = c.conv AND r.bucket <=> c.bucket")
    placed = rows.withColumn("inside", F.row_number().over(inside) - 1).alias("r").join(counts.alias("c"), same)
    return placed.select("r.*", (F.col("ahead") + F.col("inside")).alias("rank"))


def perspectives(conversations: DataFrame, turns: int = TURNS, system: tuple[str, ...] = SYSTEM, id_col="conv_id",
                 turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """One row per (conversation, participant, segment): conv_id, perspective,
    segment, n_turns, n_own_turns, text, masks (start and end, in characters of
    the segment, of what the assistant says, end marker included)."""
    role = F.coalesce(F.nullif(F.col(role_col), F.lit("")), F.lit("unknown"))
    rows = conversations.select(
        F.col(id_col).alias("conv_id"), F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))
        .alias("conv"), F.col(turn_col).alias("turn"), _plain(role).alias("role"),
        _plain(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    rows = materialise(_ranked(rows).withColumn("segment", F.floor(F.col("rank") / turns)), "chat-turns")
    speaker = F.when(~F.col("role").isin(*system), F.col("role"))
    people = rows.where(speaker.isNotNull()).select("conv", F.col("role").alias("perspective")).distinct()
    segments = rows.groupBy("conv", "segment").agg(
        F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(F.struct("rank", "role", "text"))).alias("said"))

    def header(t: Column) -> Column:
        user = F.concat(F.lit("<|user name="), t["role"], F.lit("|>\n"))
        return (F.when(t["role"].isin(*system), F.lit("<|system|>\n"))
                .when(t["role"] == F.col("perspective"), F.lit("<|assistant|>\n")).otherwise(user))

    def part(t: Column) -> Column:
        head = header(t)
        return F.struct(F.concat(head, t["text"], F.lit(END)).alias("text"), F.length(head).alias("head"),
                        (t["role"] == F.col("perspective")).alias("own"))

    def step(state: Column, p: Column) -> Column:
        end = state["at"] + F.length(p["text"])
        span = F.struct((state["at"] + p["head"]).alias("start"), (end - 1).alias("end"))
        return F.struct(end.alias("at"), F.when(p["own"], F.concat(state["masks"], F.array(span)))
                        .otherwise(state["masks"]).alias("masks"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("masks"))
    shown = segments.join(people, "conv").withColumn("parts", F.transform("said", part))
    shown = shown.withColumn("masks", F.aggregate("parts", empty, step, lambda s: s["masks"]))
    return shown.select(
        "conv_id", "perspective", "segment", F.size("said").alias("n_turns"), F.size("masks").alias("n_own_turns"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"), "masks")
