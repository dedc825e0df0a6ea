from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("node", "key", "lane", "sha", "order", "times", "text_key", "size", "id", "cluster", "b", "host")


def sentence(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def edge_rows():
    """Prose, copies, near copies, nulls, blanks, a long text, repeated rows."""
    rng = random.Random(5)
    rows = []
    for i in range(120):
        text = "\n".join(sentence(rng, rng.randrange(5, 40), 5000) for _ in range(rng.randrange(1, 6)))
        rows.append((i, text, "en", f"s{i % 5}" if i % 3 else "hot"))
    base = rows[3][1].split(" ") + sentence(rng, 60, 5000).split(" ")
    for i in range(120, 140):  # near copies of one another
        words = list(base)
        words[rng.randrange(len(words))] = f"edit{i}"
        rows.append((i, " ".join(words), "en", "hot"))
    for i in range(140, 150):  # exact copies, other white space
        rows.append((i, rows[7][1].replace(" ", " \t "), "en", "hot"))
    rows += [(200, None, None, None), (201, "", "en", "s1"), (202, " \n\t ", None, "s2"), (203, "one", "en", "s1"),
             (204, "one two", "en", None), (205, "ONE  two", "de", ""), (206, "a b c d e", "en", "s1"),
             (207, "word " * 30000, "en", "s3"), (208, sentence(rng, 20000, 9000), "en", "s3"),
             (None, rows[7][1], "en", "s1"), (None, None, None, None), (7, rows[7][1], "en", "s2"),
             (7, rows[7][1], "en", "s2"), (9, "another text under a used identifier", "en", "s4"),
             (210, "größer über straße été ñandú " * 12, "de", "s4")]
    return [(*r, None) for r in rows]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(edge):
    from pyspark.sql import functions as F
    return edge.withColumns({c: F.lit("x") for c in CLASHES})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
