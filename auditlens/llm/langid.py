"""Language identification with a string kernel.

The blended-spectrum presence kernel of two texts is the weighted sum, over
n = 1, 2, 3, of the n-grams both hold, over the root of the product of how many
each holds. N-grams are over lower-cased characters, everything but letters as
a space, hashed into fixed classes. Training takes a bounded sample (PER_LANG
rows a language, MAX_ROWS in all, in the order of a hash), chooses LANDMARKS of
them, maps all through Nystroem features ``K(x, Z) K(Z, Z)^-1/2`` and solves one
ridge regression against the one-versus-rest targets. Scoring is two matrix
products per batch of texts: with the landmarks, then with the folded weights.
The bounded model (a few MB) goes to the workers; every text is scored whole, in
one pass without a shuffle.

Defined cases: a null text or one without a letter is ``und`` with score 0; so is
every text if there is no row to learn from; rows with null doc_id are scored,
not learned from, and not held out; equal rows give equal rows; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from auditlens.llm.common import mix64, random_words

#: n-gram length -> (hash classes, weight)
SPECTRUM = {1: (1024, 0.2), 2: (4096, 0.3), 3: (8192, 0.5)}
WIDTH = sum(size for size, _ in SPECTRUM.values())
PER_LANG, MAX_ROWS, LANDMARKS, RIDGE = 512, 2048, 256, 1e-3
#: Characters walked at once, and texts in one matrix.
SEGMENT, ROWS = 1 << 20, 256
LETTER = regex.compile(r"\p{L}")


def presence(text: str) -> np.ndarray:
    """Which n-gram classes a text holds."""
    held = np.zeros(WIDTH, bool)
    blank = np.arange(128)
    blank[(blank < 97) | (blank > 122)] = 32
    for begin in range(0, max(len(text), 1), SEGMENT):
        part = text[begin:begin + SEGMENT + 2].lower()
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        code = np.where(code < 128, blank[np.minimum(code, np.uint64(127)).astype(np.intp)].astype(np.uint64), code)
        at = 0
        for n, (size, _) in SPECTRUM.items():
            if len(code) >= n:
                gram = np.zeros(len(code) - n + 1, np.uint64)
                for k, factor in enumerate(random_words(20 + n, n) | np.uint64(1)):
                    gram += code[k:len(code) - n + 1 + k] * factor
                held[at + (mix64(gram) % np.uint64(size)).astype(np.intp)] = True
            at += size
    return held


def normed(held: np.ndarray) -> np.ndarray:
    """Rows of presences as vectors whose products are the kernel."""
    out = held.astype(np.float32)
    at = 0
    for size, weight in SPECTRUM.values():
        block = out[:, at:at + size]
        block *= np.sqrt(weight / np.maximum(block.sum(axis=1, keepdims=True), 1))
        at += size
    return out


def fit(held: np.ndarray, langs: list[str]) -> dict:
    """Landmarks in turn from each language; folded ridge weights."""
    known = sorted(set(langs))
    rows = {k: [i for i, x in enumerate(langs) if x == k] for k in known}
    turns = sorted((place, k, i) for k in known for place, i in enumerate(rows[k]))
    z = normed(held[[i for _, _, i in turns[:LANDMARKS]]])
    x = normed(held)
    value, vector = np.linalg.eigh((z @ z.T).astype(np.float64))
    root = vector * (1 / np.sqrt(np.maximum(value, 1e-6))) @ vector.T
    features = np.hstack([(x @ z.T).astype(np.float64) @ root, np.ones((len(x), 1))])
    target = np.array([[lang == k for k in known] for lang in langs], np.float64)
    weights = np.linalg.solve(features.T @ features + RIDGE * len(x) * np.eye(features.shape[1]) / 100,
                              features.T @ target)
    return {"langs": known, "landmarks": z, "weights": (root @ weights[:-1]).astype(np.float32),
            "bias": weights[-1].astype(np.float32)}


def _presence_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = [np.packbits(presence(t or "")).tobytes() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], ["lang", "bits"])


def train(labelled: DataFrame) -> dict | None:
    """A model from (lang, text, order) rows, order being a hash: the sample is
    the first PER_LANG texts of each language, and the first MAX_ROWS of these.

    The order is ranked without the texts, in 64 parts of a language and then
    among the parts' first; only the sample's texts are fetched.
    """
    once = labelled.groupBy("lang", "order").agg(F.count(F.lit(1)).alias("n"))
    by_part = W.partitionBy("lang", F.shiftright("order", 58)).orderBy("order")
    some = once.withColumn("place", F.row_number().over(by_part)).where(F.col("place") <= PER_LANG)
    by_lang = W.partitionBy("lang").orderBy("order")
    first = (some.withColumn("place", F.row_number().over(by_lang)).where(F.col("place") <= PER_LANG)
             .orderBy("place", "lang").limit(MAX_ROWS).select("lang", "order"))
    sample = (labelled.join(F.broadcast(first), ["lang", "order"]).dropDuplicates(["lang", "order"])
              .orderBy("order", "lang").select("lang", "text"))
    rows = sample.mapInArrow(_presence_batches, "lang string, bits binary").collect()
    if not rows:
        return None
    held = np.unpackbits(np.stack([np.frombuffer(r["bits"], np.uint8) for r in rows]), axis=1)[:, :WIDTH]
    return fit(held.astype(bool), [r["lang"] for r in rows])


def _scorer(model):
    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            langs, scores = [], []
            for begin in range(0, batch.num_rows, ROWS):
                texts = batch.column(2).slice(begin, ROWS).to_pylist()
                some = [i for i, t in enumerate(texts) if m and t and LETTER.search(t)]
                lang, score = ["und"] * len(texts), [0.0] * len(texts)
                if some:
                    kernel = normed(np.stack([presence(texts[i]) for i in some])) @ m["landmarks"].T
                    margin = kernel @ m["weights"] + m["bias"]
                    best = margin.argmax(axis=1)
                    for i, b, s in zip(some, best, np.clip(margin[np.arange(len(some)), best], 0, 1)):
                        lang[i], score[i] = m["langs"][b], float(s)
                langs += lang
                scores += score
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])
    return score_batches


def predict(rows: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, held_out, text) -> doc_id, held_out, lang_pred, score."""
    spark: SparkSession = rows.sparkSession
    sent = spark.sparkContext.broadcast(model)
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        _scorer(sent), "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """Learn from the rows whose crc32(doc_id) mod 4 is not 2, score all rows."""
    fold = F.crc32(F.col(id_col).cast("string")) % 4
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
                       F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    labelled = rows.where("doc_id IS NOT NULL AND NOT held_out AND lang IS NOT NULL AND text IS NOT NULL")
    return predict(rows, train(labelled.select("lang", "text", F.xxhash64("text").alias("order"))))
