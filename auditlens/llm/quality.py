"""Quality rules with cross-document line frequency.

Every text is cut into lines; a line is normalised to its lower-cased words,
one space apart, and hashed. For each host (the ``source`` column) the
*distinct texts* that hold a line are counted: a document counts once however
often it is copied, else every copy of a page, the one to be kept too, would be
rejected for its own lines. A line is boilerplate from ``min_docs`` texts on if it stands in
more than ``max_share`` of the host's or in more than ``max_docs``, whichever comes first: the
share decides on hosts of any size, the count ends it on hosts of millions. It is removed: the cleaned text is the other lines, as they were and in their
order. A document is rejected when less than ``min_left`` of its words remain in
the cleaned text, or when a base rule fails.

Counting goes in two steps, distinct (host, line, text) and then (host, line),
each with partial aggregation, so neither a line that a third of all documents
share nor a host with a third of them is gathered in one task. Only the hashes
of a text's frequent lines travel back to the documents; texts without any are
not touched.

Defined cases: null and empty texts have no words and fail the base rule; a
null source is a host of its own; rows that repeat a text get equal results;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from auditlens.llm.common import (
    BROADCAST_KEYS,
    WordHasher,
    byte_views,
    checked,
    fresh,
    materialise,
    slices,
    windows,
    word_count,
)

SYMBOLS = b"#*$%&|<>"
BLANK = b"\x20\t\n\x0b\x0c\r"

#: When a line is frequent: texts it takes at least, share of the host's texts, count on any host.
MIN_DOCS, MAX_SHARE, MAX_DOCS = 3, 0.1, 10_000

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCHEMA = ("id long, host string, text_key binary, " + ", ".join(f"{m} long" for m in MEASURES)
          + ", lines array<struct<line: long, words: long>>")
_LINES = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))


def repeated_words(words: np.ndarray, size: int = 3) -> int:
    """Words covered by ``size``-word windows that occur twice or more."""
    grams = windows(words, size, 3)
    if len(grams) < 2:
        return 0
    _, inverse, counts = np.unique(grams, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[inverse] > 1)
    covered = np.zeros(len(words), bool)
    for k in range(size):
        covered[again + k] = True
    return int(covered.sum())


def line_key(parts: list[bytes]) -> int:
    """Hash of a line's lower-cased words, signed."""
    key = xxhash.xxh3_64_intdigest(b" ".join(parts).lower())
    return key - ((key >> 63) << 64)


def measure(text: np.ndarray, hasher: WordHasher, code: np.ndarray) -> tuple[list[int], dict[int, int]]:
    """The five measures of a text, and {line hash: words on such lines}."""
    words = hasher(text)
    kinds = np.bincount(code[text], minlength=4)  # 0 other, 1 white space, 2 symbol, 3 continuation byte
    seen, lines, dup = set(), {}, 0
    for raw in text.tobytes().split(b"\n"):
        parts = raw.split()
        if not parts:
            continue
        if raw in seen:
            dup += 1
        else:
            seen.add(raw)
        key = line_key(parts)
        lines[key] = lines.get(key, 0) + len(parts)
    return [len(words), int(kinds[0] + kinds[2]), int(kinds[2]), dup, repeated_words(words)], lines


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher(lower=False)
    code = np.zeros(256, np.uint8)
    code[list(BLANK)] = 1
    code[list(SYMBOLS)] = 2
    code[0x80:0xC0] = 3
    for batch in slices(batches):
        measures, lines = [], []
        for text in byte_views(batch.column(3)):
            text = np.empty(0, np.uint8) if text is None else text
            m, of = measure(text, hasher, code)
            measures.append(m)
            lines.append([{"line": k, "words": n} for k, n in of.items()])
        columns = list(zip(*measures)) if measures else [[]] * len(MEASURES)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *(pa.array(c, pa.int64()) for c in columns), pa.array(lines, _LINES)],
            ["id", "host", "text_key", *MEASURES, "lines"])


def text_key(text: Column) -> Column:
    """Tells texts apart; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def line_profile(docs: DataFrame, id_col="doc_id", host_col="source", text_col="text") -> DataFrame:
    """Measures and line hashes of every row, written once."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(host_col).cast("string").alias("host"),
                       text_key(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text"))
    return materialise(rows.mapInArrow(_measure_batches, SCHEMA), "line-profile")


def frequent_lines(profile: DataFrame, min_docs: int, max_share: float, max_docs: int) -> DataFrame:
    """(host, line) held by more distinct texts of the host than the limit."""
    texts = profile.select("host", "text_key", F.explode("lines.line").alias("line"))
    counts = (texts.groupBy("host", "line", "text_key").agg(F.lit(1).alias("one"))
              .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs))
    sizes = (profile.select("host", "text_key").groupBy("host", "text_key").agg(F.lit(1).alias("one"))
             .groupBy("host").agg(F.count(F.lit(1)).alias("host_texts")))
    return (counts.alias("c").join(sizes.alias("s"), F.expr("c.host <=> s.host"))
            .where((F.col("n") > max_share * F.col("host_texts")) | (F.col("n") > max_docs)).select("c.host", "c.line", "n"))


def frequent_of_texts(profile: DataFrame, min_docs: int, max_share: float, max_docs: int) -> DataFrame:
    """(host, text_key, gone): the frequent lines of each distinct text that
    has any, written."""
    frequent = materialise(frequent_lines(profile, min_docs, max_share, max_docs), "frequent-lines")
    # per distinct (host, text): copies have the same lines
    texts = profile.groupBy("host", "text_key").agg(F.first("lines.line").alias("lines"))
    on_lines = texts.select("host", "text_key", F.explode("lines").alias("line"))
    return materialise(
        on_lines.alias("t").join(checked(frequent).alias("f"), F.expr("t.host <=> f.host AND t.line = f.line"))
        .groupBy("t.host", "text_key").agg(F.collect_list("t.line").alias("gone")), "lines-of-texts")


@F.pandas_udf(StringType())
def _without(text: pd.Series, gone: pd.Series) -> pd.Series:
    """Texts without the lines of these hashes; null where there are none."""
    out = []
    for t, lines in zip(text, gone):
        if lines is None:
            out.append(None)
            continue
        lines = set(lines.tolist())
        out.append(b"\n".join(raw for raw in t.encode().split(b"\n")
                              if not (parts := raw.split()) or line_key(parts) not in lines).decode())
    return pd.Series(out, dtype=object)


def _cleaned(docs: DataFrame, gone: DataFrame, host_col: str, text_col: str, how: str) -> tuple[DataFrame, str, str]:
    """``docs`` joined with the frequent lines of its texts; the names of the
    added columns with the text's key and the cleaned text (null: nothing to remove)."""
    key = fresh(docs, "text_key")
    clean = fresh(docs, "clean_text")
    lines = fresh(docs, "gone")
    size = gone.agg(F.sum(F.size("gone"))).first()[0] or 0
    side = F.broadcast(gone) if size <= BROADCAST_KEYS else gone
    match = (F.col(f"d.{host_col}").cast("string").eqNullSafe(F.col("g.host"))
             & (F.col(f"d.{key}") == F.col("g.text_key")))
    rows = (docs.withColumn(key, text_key(F.col(text_col))).alias("d").join(side.alias("g"), match, how)
            .select("d.*", F.col("g.gone").alias(lines)))
    text = F.when(F.col(lines).isNotNull(), F.col(text_col))  # other texts do not go to Python
    return rows.withColumn(clean, _without(text, lines)).drop(lines), key, clean


def _rules(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_docs: int = MAX_DOCS,
           min_left: float = 0.2, min_words: int = 50, max_repeat: int = 50, id_col="doc_id", host_col="source", text_col="text") -> tuple[DataFrame, DataFrame]:
    """The rows of ``quality_rules`` and the table of ``frequent_of_texts``."""
    profile = line_profile(docs, id_col, host_col, text_col)
    gone = frequent_of_texts(profile, min_docs, max_share, max_docs)
    texts = docs.select(F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text"))
    cleaned, key, clean = _cleaned(texts, gone, "host", "text", "inner")
    left = cleaned.select("host", key, word_count(F.col(clean)).alias("left")).groupBy("host", key).agg(
        F.min("left").alias("n_left"))
    found = profile.drop("lines").alias("p").join(
        left.alias("r"), F.expr(f"p.host <=> r.host AND p.text_key = r.{key}"), "left")
    n_left = F.coalesce("n_left", "n_words")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return found.select(
        F.col("id").alias("doc_id"), *MEASURES, failed.alias("base_failed"),
        (~failed & (n_left >= min_left * F.col("n_words"))).alias("kept"),
        (F.col("n_words") - n_left).alias("n_removed_words"), "p.host", "p.text_key"), gone


def quality_rules(docs: DataFrame, **options) -> DataFrame:
    """One row per input row: doc_id, the measures, base_failed, kept, and
    n_removed_words (words of the text that its cleaned text lacks)."""
    return _rules(docs, **options)[0]


def _put(rows: DataFrame, columns: list[str], clean: str, text_col: str, chars_col: str) -> DataFrame:
    """The cleaned texts in place of the texts, and their lengths."""
    changed = {text_col: F.coalesce(clean, text_col),
               chars_col: F.when(F.col(clean).isNotNull(), F.length(clean)).otherwise(F.col(chars_col))}
    return rows.select(*(changed[c].cast(rows.schema[c].dataType).alias(c) if c in changed else c for c in columns))


def clean_texts(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_docs: int = MAX_DOCS,
                id_col="doc_id", host_col="source", text_col="text", chars_col="n_chars") -> DataFrame:
    """``docs`` with every text without its frequent lines; ``chars_col``, if
    there, is the new length of the texts that changed."""
    gone = frequent_of_texts(line_profile(docs, id_col, host_col, text_col), min_docs, max_share, max_docs)
    rows, _, clean = _cleaned(docs, gone, host_col, text_col, "left")
    return _put(rows, docs.columns, clean, text_col, chars_col)


def drop_low_quality(docs: DataFrame, host_col="source", text_col="text", chars_col="n_chars", **options) -> DataFrame:
    """``docs`` without the rejected rows, the others with their cleaned texts
    (see ``clean_texts``); columns as they were.

    The verdict depends on host and text only, so rows are matched by these.
    """
    found, lines = _rules(docs, host_col=host_col, text_col=text_col, **options)
    gone = materialise(found.where("NOT kept").select("host", "text_key").distinct(), "quality-gone")
    key = fresh(docs, "text_key")
    match = (F.col(f"d.{host_col}").cast("string").eqNullSafe(F.col("g.host"))
             & (F.col(f"d.{key}") == F.col("g.text_key")))
    kept = (docs.withColumn(key, text_key(F.col(text_col))).alias("d")
            .join(checked(gone).alias("g"), match, "left_anti").select(*docs.columns))
    rows, _, clean = _cleaned(kept, lines, host_col, text_col, "left")
    return _put(rows, docs.columns, clean, text_col, chars_col)
