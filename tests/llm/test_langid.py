from __future__ import annotations

import random
import zlib

from pyspark.sql import functions as F

from auditlens.llm import langid

SYLLABLES = {"en": "the and ing th er on re ed wh ly", "de": "der und sch ung ein ich ß ü tz keit",
             "fr": "le les eau oi é è que tion ou aux", "es": "el los ción ñ rr ado ez ó que as"}


def text(rng, lang, n):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def corpus(spark):
    rng = random.Random(9)
    rows = [(i, text(rng, lang := rng.choice(list(SYLLABLES)), rng.randrange(4, 120)), lang) for i in range(600)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


def test_held_out_accuracy_and_folds(spark):
    rows, docs = corpus(spark)
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert len(got) == len(rows)
    held = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert sum(got[i].lang_pred == lang for i, lang in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_held_out_labels_and_other_columns_are_not_used(spark):
    _, docs = corpus(spark)
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, "xx").otherwise(F.col("lang")))
    other = other.withColumns({c: F.lit("en") for c in ("source", "order", "held_out", "place")})
    assert sorted(langid.identify(docs).collect()) == sorted(langid.identify(other).collect())


def test_defined_cases(spark, empty):
    _, docs = corpus(spark)
    odd = [(9001, None, "en"), (9002, "", "en"), (9003, "123 ... 4", "en"), (9005, "x² ½"[1:], "en"), (None, "the and thering", None),
           (9004, "le les eau " * 200000, None), (9004, "le les eau", None), (9004, "le les eau", None)]
    got = langid.identify(docs.unionByName(spark.createDataFrame(odd, docs.schema))).collect()
    of = [r for r in got if r.doc_id is None or r.doc_id > 9000]
    assert len(of) == len(odd)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in of if r.doc_id in (9001, 9002, 9003, 9005))
    assert {r.lang_pred for r in of if r.doc_id == 9004} == {"fr"}
    assert [(r.lang_pred, r.held_out) for r in of if r.doc_id is None] == [("en", False)]
    assert langid.identify(empty).count() == 0
    blank = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.identify(blank).collect()] == [("und", 0.0)]


def test_kernel_counts_shared_grams():
    import numpy as np
    a, b = langid.presence("the then"), langid.presence("then they")
    k = langid.normed(np.stack([a, b]))
    want, at = 0.0, 0
    for size, weight in langid.SPECTRUM.values():
        x, y = a[at:at + size], b[at:at + size]
        want += weight * (x & y).sum() / np.sqrt(x.sum() * y.sum())
        at += size
    assert abs(float(k[0] @ k[1]) - want) < 1e-5
    assert abs(float(k[0] @ k[0]) - 1) < 1e-5
