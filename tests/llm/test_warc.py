from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditlens.llm import warc

FENCED = "\r\n\r\nWARC/1.0\r\n"
ROWS = [(1, "http://a/", "x" * 1200), (2, "http://b/", "x" * 1200), (5, None, "x" * 1200), (3, "http://c/", "short"),
        (4, "http://c/\r\nX: y", "short"), (6, "u", None), (7, "u", ""), (8, "u", FENCED * 300 + "é" * 4000),
        (9, "u", "WARC/1.0\r\n" + FENCED[:-2]), (10, "u", "\r\nWARC/1.0 \r\n\r\n"), (None, "n", "x" * 1200),
        (None, "n", "y" * 1300), (5, "again", "x" * 1200), (11, "long", "".join(chr(200 + i % 5000) for i in range(90000))),
        (12, "u", "\r\n\r\n"), (13, "u", "WARC/1.0"), (14, "u", "\r\n\r\nWARC/1.0")]


def brute(rows):
    groups = defaultdict(list)
    for i, _, t in rows:
        groups[t or ""].append(i)
    out = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        top = max(known) if known and len(ids) > 1 and len(t.encode()) >= 1000 else None
        for i in ids:
            again = top is not None and i != top
            out[(i, len(t.encode()), hashlib.sha1(t.encode()).hexdigest(), "revisit" if again else "response",
                 top if again else None)] += 1
    return out


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3)


@pytest.mark.parametrize("chunk", [4, 37, 1 << 16])
def test_round_trip(pages, chunk):
    clash = pages.withColumns({c: F.lit("x") for c in ("digest", "payload", "n", "value", "largest")})
    for table in (pages, clash):
        got = warc.archive_round_trip(table, chunk_bytes=chunk)
        assert Counter(tuple(r)[:5] for r in got.collect()) == brute(ROWS)


def test_the_files_are_warc(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(pages.coalesce(1), path, chunk_bytes=1000)
    raw = b"".join(r[0] for r in spark.read.format("binaryFile").load(path).select("content").collect())
    import gzip
    data, payload, n = gzip.decompress(raw), {}, 0
    while data:  # a plain reader that goes by Content-Length
        head, _, rest = data.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.0\r\n")
        field = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        length = int(field["Content-Length"])
        block, end = rest[:length], rest[length:length + 4]
        assert end == b"\r\n\r\n"
        data, n = rest[length + 4:], n + 1
        if field["WARC-Type"] == "response":
            payload[field["WARC-Record-ID"]] = block.partition(b"\r\n\r\n")[2]
        elif field["WARC-Type"] == "continuation":
            payload[field["WARC-Segment-Origin-ID"]] += block
    want = Counter(d for (_, _, d, kind, _), k in brute(ROWS).items() for _ in range(k) if kind == "response")
    assert Counter(hashlib.sha1(p).hexdigest() for p in payload.values()) == want
    assert n > len(ROWS)


def test_chunks_join_to_the_payload():
    for text in ("é" * 50, FENCED * 9, "WARC/1.0" * 20, "", "\r\n" * 30 + "WARC/1.0"):
        block = np.frombuffer(text.encode(), np.uint8)
        for size in (1, 5, 64):
            parts = list(warc.chunks(block, b"HTTP\r\n\r\n", size))
            assert b"".join(p for _, p, _ in parts) == text.encode()
            assert [last for *_, last in parts] == [False] * (len(parts) - 1) + [True]
            for head, piece, _ in parts:
                assert warc.FENCE not in warc.END + head + piece
                piece.decode()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_round_trip(docs).count() == 0


@pytest.mark.parametrize("revisits", [True, False])
def test_record_ends_anywhere_in_a_buffer(spark, tmp_path, revisits):
    """Spark's reader has buffers of 64 KB: the end of one falls on each byte of a
    record's end, after a revisit or a page that ends in a line break."""
    def table(lengths):
        rows = [(100 + i, "u" * n, "x" * 1200) if revisits else (100 + i, "u", "x" * (n - 2) + "\r\n")
                for i, n in enumerate(lengths)]
        rows.append((200, "last", "x" * 1200))
        pages = spark.createDataFrame(rows, "page_id long, url string, html string")
        written = warc.plan_records(pages).mapInArrow(warc._writer(1 << 20, "d"), "value string").collect()
        return rows, sorted((r[0].encode() for r in written), key=len)

    rest = len(table([60000])[1][-1]) - 60000
    rows, (last, *records) = table([(1 << 16) - rest - i for i in range(18)])
    assert [len(r) - (1 << 16) for r in records] == [*range(-17, 1)]
    import gzip
    for i, record in enumerate(records):
        (tmp_path / f"{i}.gz").write_bytes(gzip.compress(record + warc.END + last + warc.END))
    want = brute(rows)
    want = Counter({r: n * (18 if r[0] == 200 else 1) for r, n in want.items()})
    assert Counter(tuple(r)[:5] for r in warc.read_archives(spark, str(tmp_path)).collect()) == want


def test_a_version_line_in_a_page_or_an_address(spark):
    rows = [(i, u, t) for i, (u, t) in enumerate((u, t) for u in ("http://h/WARC/1.0", "x\nWARC/1.0\r\n") for t in (
        "WARC/1.0\r\n", "\nWARC/1.0", "a\nWARC/1.0\r\nWARC/1.0\r\n", "\n" * 9, "\r\n\r", "WARC/1.0\n\nWARC/1.0\r"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for chunk in (4, 1 << 16):
        got = warc.archive_round_trip(pages, chunk_bytes=chunk)
        assert Counter(tuple(r)[:5] for r in got.collect()) == brute(rows)


def test_revisits_are_handed_over_in_batches(monkeypatch):
    """A long run of copies is no longer one list of a task."""
    import pyarrow as pa
    monkeypatch.setattr(warc.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda _: 0})())
    monkeypatch.setattr(warc, "BATCH_BYTES", 1 << 16)
    n = 2000
    rows = pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int64()), pa.array(["u"] * n), pa.array([1200] * n, pa.int64()),
         pa.array(["ab" * 20] * n), pa.array([n] * n, pa.int64()), pa.array([None] * n, pa.string())],
        ["page_id", "url", "n_bytes", "digest", "refers_to", "payload"])
    sizes = [(b.num_rows, b.nbytes) for b in warc._writer(1 << 16, "d")(iter([rows]))]
    assert sum(k for k, _ in sizes) == n
    assert max(size for _, size in sizes) < 1 << 17 and len(sizes) > 5
