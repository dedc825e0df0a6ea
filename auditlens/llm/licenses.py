"""License scan: phrases by Aho-Corasick, expressions by a shunting yard.

A text is lower-cased (A-Z) and cut into words; one automaton over " word word
word " finds every phrase whose words stand consecutively, overlaps included.
Where it finds an identifier tag, the rest of that line is read as a licence
expression (``or`` < ``and`` < ``with``, parentheses) by a shunting yard that
evaluates as it goes: ``or`` takes the freer side, ``and`` the stricter one,
``with`` makes a copyleft licence one step freer.

score: 1 for a well-formed tag, 0.9 for a base phrase, 0.7 for another notice,
0.5 for a malformed tag, 0.3 for a bare reservation of rights, else 0.

Defined cases: null, empty and wordless texts have no places and score 0; a
null doc_id stays null; equal rows give equal rows; extra columns are ignored.
Every row is handled by itself in one pass, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.llm.common import byte_views, slices

# The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Further notices and their labels.
NOTICES = {
    "permission is hereby granted free of charge": "mit", "mit license": "mit",
    "apache license": "apache", "bsd license": "bsd", "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause", "isc license": "isc", "public domain": "public-domain",
    "cc0": "cc0", "cc by": "cc-by", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by", "mozilla public license": "mpl",
    "gnu general public license": "gpl", "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3", "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl", "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
TAG_LINE = re.compile(r"spdx-license-identifier[ \t]*:?[ \t]*([^\r\n]*)", re.I)

#: From free to strict; a label's class is that of its longest prefix here.
CLASSES = ["permissive", "weak-copyleft", "copyleft", "restricted", "unknown"]
CLASS_OF = {
    "mit": 0, "apache": 0, "bsd": 0, "0bsd": 0, "isc": 0, "zlib": 0, "unlicense": 0, "cc0": 0, "cc-by": 0,
    "public-domain": 0, "lgpl": 1, "mpl": 1, "epl": 1, "gpl": 2, "agpl": 2, "cc-by-sa": 2,
    "cc-by-nc": 3, "cc-by-nd": 3, "all-rights-reserved": 3,
}
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, n_tags long, license_class string")

#: ASCII letters lower-cased, digits and non-ASCII bytes kept, the rest blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32
             for b in range(256))


def license_rank(label: str) -> int:
    while label:
        if label in CLASS_OF:
            return CLASS_OF[label]
        label = label.rpartition("-")[0]
    return len(CLASSES) - 1


def label_of(identifier: str) -> str:
    """``Apache-2.0`` -> apache-2, ``GPL-3.0-or-later`` -> gpl-3, ``CC-BY-4.0`` -> cc-by."""
    label = re.sub(r"(-only|-or-later|\+)$", "", identifier.lower())
    label = re.sub(r"-\d+(\.\d+)*$", "", label) if label.startswith("cc-by") else label
    return re.sub(r"(\d)\.0$", r"\1", label)


def evaluate(expression: str) -> tuple[int, frozenset[str]] | None:
    """(class, labels) of a licence expression; None if it is malformed."""
    tokens = re.findall(r"[()]|[A-Za-z0-9.+-]+|\S", re.sub(r"(\*/|-->|#\}).*$", "", expression))
    values: list[tuple[int, frozenset[str]]] = []
    operators: list[str] = []

    def apply() -> bool:
        op = operators.pop()
        if op == "(" or len(values) < 2:
            return False
        right, left = values.pop(), values.pop()
        if op == "or":
            values.append((min(left[0], right[0]), left[1] | right[1]))
        elif op == "and":
            values.append((max(left[0], right[0]), left[1] | right[1]))
        else:  # an exception is no licence of its own
            values.append((left[0] - 1 if left[0] in (1, 2) else left[0], left[1]))
        return True

    operand = True  # what may come next
    for token in tokens:
        low = token.lower()
        if low in PRECEDENCE:
            if operand:
                return None
            while operators and PRECEDENCE.get(operators[-1], 0) >= PRECEDENCE[low]:
                if not apply():
                    return None
            operators.append(low)
            operand = True
        elif token == "(":
            if not operand:
                return None
            operators.append(token)
        elif token == ")":
            if operand:
                return None
            while operators and operators[-1] != "(":
                if not apply():
                    return None
            if not operators:
                return None
            operators.pop()
        elif re.fullmatch(r"[A-Za-z0-9.+-]+", token) and operand:
            label = label_of(token)
            values.append((license_rank(label), frozenset([label])))
            operand = False
        else:
            return None
    while operators:
        if not apply():
            return None
    return values[0] if len(values) == 1 and not operand else None


def automaton(base: dict[str, str], notices: dict[str, str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in {**notices, **base, TAG: None}:
        found.add_word(f" {phrase} ", (len(phrase) + 2, phrase))
    found.make_automaton()
    return found


def scan(text: bytes, phrases: ahocorasick.Automaton, base: dict[str, str], notices: dict[str, str]) -> tuple:
    words = text.translate(FOLD).split()
    line = f" {b' '.join(words).decode()} "
    hits = sorted((end - length + 1, phrase) for end, (length, phrase) in phrases.iter(line))
    first = last = None
    n_base = tags = at = word = 0
    base_labels, labels, ranks, score = set(), set(), [], 0.0
    for start, phrase in hits:
        if phrase in base:
            word += line.count(" ", at, start)
            at = start
            first = word if first is None else first
            last = word
            n_base += 1
            base_labels.add(base[phrase])
            score = max(score, 0.9)
        label = base.get(phrase) or notices.get(phrase)
        if label:
            labels.add(label)
            ranks.append(license_rank(label))
            score = max(score, 0.3 if label == "all-rights-reserved" else 0.7)
        tags += phrase == TAG
    stated = []
    if tags:
        for tag in TAG_LINE.finditer(text.decode()):
            value = evaluate(tag[1])
            score = max(score, 0.5 if value is None else 1.0)
            if value:
                labels |= value[1]
                stated.append(value[0])
    rank = max(stated or ranks, default=None)
    return (len(words), n_base, first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, tags,
            None if rank is None else CLASSES[rank])


def _scanner(base: dict[str, str], notices: dict[str, str]):
    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = automaton(base, notices)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.int64(), pa.string()]
        names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
        for batch in slices(batches):
            rows = [scan(b"" if t is None else t.tobytes(), phrases, base, notices)
                    for t in byte_views(batch.column(1))]
            columns = list(zip(*rows)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)
    return scan_batches


def license_scan(docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES,
                 id_col="doc_id", text_col="text") -> DataFrame:
    """One row per input row: the columns of SCHEMA."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_scanner(base, notices), SCHEMA)
