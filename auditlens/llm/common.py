"""Helpers shared by the operators: written tables, and vectorised hashing of
the words of a text straight from Arrow buffers.

A *word* is a run of bytes outside ``[\\x20\\x09-\\x0D]``. Every hash is 64 bits
wide. Texts are walked in segments of at most ``SEGMENT`` bytes, so a very long
text needs memory for its word hashes (8 bytes a word) but not for 8 bytes a
character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.config import shared_dir

#: What separates words, as a Java and RE2 pattern.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

SEGMENT = 1 << 20
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts
    the lineage with files every executor can reach."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows up to which a table of keys is broadcast (some 30 MB in memory).
BROADCAST_KEYS = 500_000


def checked(keys: DataFrame, rows: int = BROADCAST_KEYS) -> DataFrame:
    """A written table of a few narrow key columns, marked for broadcast if its
    size, counted now, is at most ``rows``; else left to the join strategy of
    the session, which shuffles."""
    return F.broadcast(keys) if keys.count() <= rows else keys


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def normalised(text: Column) -> Column:
    """Null as empty; every run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words."""
    return mix64(np.arange(n, dtype=np.uint64) + np.uint64((seed * 0x632BE59BD9B4E019) & MASK))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``: bounds what a task holds of
    its results."""
    for batch in batches:
        for begin in range(0, max(batch.num_rows, 1), rows):
            yield batch.slice(begin, rows)


def byte_views(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The UTF-8 bytes of each row as views of the Arrow buffer; None for null."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    if offsets is None:
        yield from (None if x else np.empty(0, np.uint8) for x in nulls)
        return
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    for i, null in enumerate(nulls):
        yield None if null else raw[at[i]:at[i + 1]]


class WordHasher:
    """Hashes of the words of a text; ``lower`` folds A-Z first."""

    def __init__(self, lower: bool):
        byte = np.arange(256)
        if lower:
            byte = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
        self.value = random_words(1, 256)[byte]
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 1 << 14)
            for name, base in (("power", BASE), ("inverse", pow(BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def __call__(self, text: np.ndarray) -> np.ndarray:
        parts, carried, carried_len = [], 0, 0
        for begin in range(0, len(text), SEGMENT):
            seg = text[begin:begin + SEGMENT]
            n = len(seg)
            self._powers(n)
            inside = ~self.space[seg]
            edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
            first, last = bool(inside[0]), bool(inside[-1])
            edge = np.concatenate(([0] if first else [], edge, [n] if last else [])).astype(np.int64)
            start, end = edge[0::2], edge[1::2]
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(self.value[seg] * self.power[:n], out=total[1:])
            words = (total[end] - total[start]) * self.inverse[start]
            if carried_len:  # a word that began in the segment before
                if first:
                    words[0] = np.uint64((carried + int(words[0]) * pow(BASE, carried_len, 1 << 64)) & MASK)
                else:
                    parts.append(np.array([carried], np.uint64))
            more = last and begin + SEGMENT < len(text)
            if more:
                begun_before = carried_len if first and len(words) == 1 else 0
                carried, carried_len = int(words[-1]), begun_before + int(end[-1] - start[-1])
                words = words[:-1]
            else:
                carried_len = 0
            parts.append(words)
        if not parts:
            return np.empty(0, np.uint64)
        return mix64(parts[0] if len(parts) == 1 else np.concatenate(parts))


def windows(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash for each run of ``size`` consecutive words."""
    n = max(len(words) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for k, factor in enumerate(random_words(seed, size) | np.uint64(1)):
        out += words[k:k + n] * factor
    return mix64(out)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct ``size``-word shingles, sorted; with fewer words the whole
    sequence is the only one; without words there is none."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    return np.unique(windows(words, min(size, n), 7 + min(size, n)))
