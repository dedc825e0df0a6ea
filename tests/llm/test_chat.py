from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from auditlens.llm.chat import END, perspectives

ROWS = ([("a", i, "system" if i == 0 else ("ann", "bob", "cy")[i % 3], f"turn {i} é<|x|>") for i in range(150)]
        + [("b", 1, "user", "hi"), ("b", 1, "assistant", None), ("b", None, "user", "late"), ("b", 1, "user", "hi"),
           ("c", 0, "system", "alone"), (None, 3, None, "who"), (None, 2, "", ""), ("d", 5, "user", "w " * 50000)])


def brute(rows, size):
    talks = defaultdict(list)
    for c, t, r, x in rows:
        talks[c].append((t is None, t or 0, (r or "unknown").replace("<|", "< |"), (x or "").replace("<|", "< |")))
    out = Counter()
    for c, said in talks.items():
        said.sort()
        for me in {s[2] for s in said} - {"system"}:
            for k in range(0, len(said), size):
                text, masks = "", []
                for _, _, who, x in said[k:k + size]:
                    text += ("<|system|>\n" if who == "system" else "<|assistant|>\n" if who == me
                             else f"<|user name={who}|>\n")
                    start = len(text)
                    text += x + END
                    if who == me:
                        masks.append((start, len(text) - 1))
                out[(c, me, k // size, len(said[k:k + size]), len(masks), text, tuple(masks))] += 1
    return out


def test_brute_force(spark):
    talks = spark.createDataFrame(ROWS, "conv_id string, turn long, role string, text string").repartition(3)
    clash = talks.withColumns({c: F.lit("x") for c in ("conv", "rank", "bucket", "segment", "n", "perspective")})
    for table, size in ((talks, 64), (clash, 7)):
        got = Counter((*tuple(r)[:6], tuple((m.start, m.end) for m in r.masks))
                      for r in perspectives(table, turns=size).collect())
        assert got == brute(ROWS, size)


def test_masks_cover_the_assistant_only(spark):
    talks = spark.createDataFrame(ROWS, "conv_id string, turn long, role string, text string")
    for r in perspectives(talks).where("conv_id = 'a'").collect():
        for m in r.masks:
            assert r.text[:m.start].endswith("<|assistant|>\n") and r.text[m.start:m.end].endswith("<|end|>")
        assert r.text.count("<|assistant|>") == len(r.masks) == r.n_own_turns


def test_empty_table(spark):
    assert perspectives(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0
