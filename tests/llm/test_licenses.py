from __future__ import annotations

import re
from collections import Counter

import pytest

from auditlens.llm.licenses import BASE, evaluate, license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = []
    for phrase, label in BASE.items():
        p = phrase.split()
        at += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    places = [i for i, _ in at]
    return (len(words), len(at), min(places, default=None), max(places, default=None),
            ",".join(sorted({x for _, x in at})))


TEXTS = ["Released under the MIT License.", "under the mit license under the MIT-license, CC BY-NC 4.0",
         "cc by nc cc by nc by nc", "Apache License, Version 2.0 and apache license version 22", "xunder the mit license",
         "été under the mit licenseé", "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0",
         "SPDX-License-Identifier: MIT AND\nnext line", "All rights reserved.", None, "", "...",
         "filler " * 50000 + "under the MIT license" + " filler" * 50000]


def test_base_against_brute_force(spark, edge, clashing):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(0, TEXTS[0]), (None, TEXTS[1])], "doc_id long, text string")
    for table in (docs, edge, clashing):
        want = Counter((r.doc_id, *brute(r.text)) for r in table.collect())
        got = license_scan(table).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
        assert Counter(map(tuple, got.collect())) == want


def test_labels_and_scores(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan(docs).collect()}
    assert got[6].labels == "apache-2,gpl-2,mit" and got[6].score == 1 and got[6].license_class == "weak-copyleft"
    assert got[7].score == 0.5 and got[7].n_tags == 1
    assert got[8].labels == "all-rights-reserved" and got[8].score == 0.3
    assert got[0].license_class == "permissive" and got[2].license_class == "restricted"
    assert got[9].score == 0 and got[9].labels == "" and got[9].license_class is None
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
               for r in got.values())


@pytest.mark.parametrize("text, value", [
    ("MIT", (0, {"mit"})), ("MIT or GPL-3.0-only", (0, {"mit", "gpl-3"})), ("MIT and GPL-3.0+", (2, {"mit", "gpl-3"})),
    ("MIT OR GPL-2.0 AND CC-BY-NC-4.0", (0, {"mit", "gpl-2", "cc-by-nc"})),
    ("(MIT OR GPL-2.0) AND CC-BY-NC-4.0 */", (3, {"mit", "gpl-2", "cc-by-nc"})),
    ("GPL-2.0 WITH Linux-syscall-note OR MPL-2.0", (1, {"gpl-2", "mpl-2"})),
    ("", None), ("MIT OR", None), ("(MIT", None), ("MIT)", None), ("MIT GPL-2.0", None), ("AND MIT", None), ("()", None)])
def test_expressions(text, value):
    got = evaluate(text)
    assert got == (value and (value[0], frozenset(value[1])))


def test_empty_table(empty):
    assert license_scan(empty).count() == 0
