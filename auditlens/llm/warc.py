"""WARC archives as a table of chunks.

Writing. A page becomes one ``response`` record, or, if a page with a larger
identifier has the same payload of at least ``min_revisit`` bytes, a ``revisit``
record that refers to the page with the largest. Payloads over ``chunk_bytes``
are cut: the rows (record, chunk number) become the record's segments, a
``response`` and then ``continuation`` records, as the WARC standard has it. Each
segment carries the digest of the payload up to its end, updated chunk by
chunk, so neither side builds a whole record. Rows go to Spark's text writer, one
file per partition, with the record end (two line breaks) as separator.

Reading. Spark's text reader splits at a version line, taken with the line break
before it; a record's last line break goes with it. A chunk never holds that
sequence: the writer cuts any occurrence in two. The sequence does not overlap
itself before its end, which the reader needs: where a buffer of it ends in the first
bytes of a separator that turn out to be something else, it does not look at
them again (``record end + version line`` gets lost there if a line break
precedes it, as after a revisit or a page that ends in one). The archives
are gzipped, so a file is read by one task in order, and its segments arrive in
turn; the reader keeps one running digest, checks it at each segment, and emits
a row when a record ends.

Equal payloads are those of equal SHA-1 and length.

Defined cases: null html is an empty payload, a null url has no target header;
a null page_id is never referred to unless its whole group has none (then all
are responses); rows that repeat the referred page are responses too; an empty
table gives archives without records; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.config import shared_dir
from auditlens.llm.common import byte_views, slices

CHUNK_BYTES, MIN_REVISIT = 1 << 16, 1000
#: Bytes of segments a task hands over at once.
BATCH_BYTES = 1 << 22

VERSION, END = b"WARC/1.0\r\n", b"\r\n\r\n"
#: Where the reader cuts.
SEPARATOR = END[-1:] + VERSION
#: A block may not hold this, nor begin with it less its first byte, which a
#: header's end has: it would read as the end of a record.
FENCE = END[-1:] + b"WARC/1.0"

RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "url string, n_segments long")


def plan_records(pages: DataFrame, min_revisit: int = MIN_REVISIT, id_col="page_id", url_col="url",
                 payload_col="html") -> DataFrame:
    """page_id, url, n_bytes, digest, refers_to (null: a response), payload
    (null for revisits). Groups of equal payloads are aggregated before the
    join, and payloads of single pages are not looked up by value."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("n_bytes"), F.sha1("payload").alias("digest"))
    groups = (rows.where(F.col("n_bytes") >= min_revisit).groupBy("digest", "n_bytes")
              .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    found = rows.join(groups, ["digest", "n_bytes"], "left")
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return found.select("page_id", "url", "n_bytes", "digest", F.when(revisit, F.col("largest")).alias("refers_to"),
                        F.when(~revisit, F.col("payload")).alias("payload"))


def chunks(block: np.ndarray, head: bytes, chunk_bytes: int) -> Iterator[tuple[bytes, bytes, bool]]:
    """(head, chunk, last): the pieces of a payload; none holds or begins a
    FENCE, none ends inside a character. ``head`` stands before the first."""
    at, n = 0, len(block)
    while True:
        end = min(n, at + chunk_bytes)
        while at < end < n and block[end] & 0xC0 == 0x80:
            end -= 1
        if end == at and n:  # a character longer than a chunk
            end = min(n, at + 4)
        piece = block[at:end].tobytes()
        cut = (FENCE[:1] + head + piece).find(FENCE)
        if cut >= 0:  # keep its first six bytes, less those before the piece
            end = at + cut + 6 - 1 - len(head)
            piece = block[at:end].tobytes()
        yield head, piece, end >= n
        if end >= n:
            return
        at, head = end, b""


def _b32(digest: "hashlib._Hash") -> str:
    return base64.b32encode(digest.digest()).decode()


def _header(fields: list[tuple[str, object]]) -> bytes:
    clean = lambda v: "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(v))
    return VERSION + "".join(f"{k}: {clean(v)}\r\n" for k, v in fields if v is not None).encode() + b"\r\n"


def _segments(page, url, n_bytes: int, digest: str, refers_to, payload: np.ndarray, record: str, chunk_bytes: int,
              date: str) -> Iterator[bytes]:
    """The segments of a record, without their end."""
    whole = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    common = [("WARC-Date", date), ("WARC-Target-URI", url), ("X-Page-Id", page),
              ("X-Payload-Length", n_bytes), ("WARC-Payload-Digest", whole)]
    if refers_to is not None:
        yield _header([("WARC-Type", "revisit"), ("WARC-Record-ID", record), *common, (
            "WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
            ("X-Refers-To-Page-Id", refers_to), ("Content-Length", 0)])
        return
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n_bytes
    so_far = hashlib.sha1()
    for k, (before, piece, last) in enumerate(chunks(payload, head, chunk_bytes), 1):
        so_far.update(piece)
        whole_record = k == 1 and last
        kind = [("WARC-Type", "response" if k == 1 else "continuation")]
        kind += [("WARC-Record-ID", record if k == 1 else f"{record[:-1]}/{k}>")]
        if not whole_record:
            kind += [("WARC-Segment-Number", k), ("WARC-Segment-Origin-ID", record if k > 1 else None),
                     ("WARC-Segment-Total-Length", len(head) + n_bytes if last else None)]
        yield _header([*kind, *common, ("X-Digest-So-Far", _b32(so_far)), (
            "Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(before) + len(piece))]) + before + piece


def _writer(chunk_bytes: int, date: str):
    def lines(segments: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(segments, pa.binary()).cast(pa.string())], ["value"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, out, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in slices(batches, 64):
            rows = zip(*(batch.column(i).to_pylist() for i in range(5)), byte_views(batch.column(5)))
            for page, url, n_bytes, digest, refers_to, payload in rows:
                record = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}:{digest}:{part}:{count}')}>"
                count += 1
                for segment in _segments(page, url, n_bytes, digest, refers_to, payload, record, chunk_bytes, date):
                    out.append(segment)
                    held += len(segment)
                    if held >= BATCH_BYTES:  # revisits count too: a group of copies is a long run of them
                        yield lines(out)
                        out, held = [], 0
        yield lines(out)
    return write


def write_archives(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, min_revisit: int = MIN_REVISIT,
                   date: str = "2024-01-01T00:00:00Z", **columns) -> None:
    """Gzipped WARC files under ``path``, one per partition."""
    records = plan_records(pages, min_revisit, **columns).mapInArrow(_writer(chunk_bytes, date), "value string")
    records.write.option("lineSep", END.decode()).option("compression", "gzip").text(path)


def _read_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split(" ")[0] for c in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    so_far, n_bytes, record = hashlib.sha1(), 0, None
    for batch in slices(batches):
        rows = []
        for view in byte_views(batch.column(0)):
            raw = view.tobytes()
            head, _, block = raw.removeprefix(VERSION).partition(END)
            field = dict(x.split(": ", 1) for x in head.decode().split("\r\n") if ": " in x)
            length = int(field["Content-Length"])
            if len(block) < length or block[length:] not in (END, END[:-1]):
                raise ValueError(f"record {field['WARC-Record-ID']}: {len(block)} bytes, {length} stated")
            block = block[:length]
            page = int(field["X-Page-Id"]) if "X-Page-Id" in field else None
            if field["WARC-Type"] == "revisit":
                digest = base64.b32decode(field["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                rows.append((page, int(field["X-Payload-Length"]), digest, "revisit",
                             int(field["X-Refers-To-Page-Id"]), field.get("WARC-Target-URI"), 1))
                continue
            number = int(field.get("WARC-Segment-Number", 1))
            if number == 1:
                so_far, n_bytes, record = hashlib.sha1(), 0, field["WARC-Record-ID"]
                block = block.partition(END)[2]
            elif field["WARC-Segment-Origin-ID"] != record:
                raise ValueError(f"segment {number} of {field['WARC-Segment-Origin-ID']} is out of place")
            so_far.update(block)
            n_bytes += len(block)
            if _b32(so_far) != field["X-Digest-So-Far"]:
                raise ValueError(f"segment {number} of {record}: the digest differs")
            if "WARC-Segment-Number" not in field or "WARC-Segment-Total-Length" in field:
                if n_bytes != int(field["X-Payload-Length"]) or "sha1:" + _b32(so_far) != field["WARC-Payload-Digest"]:
                    raise ValueError(f"record {record}: the payload differs")
                rows.append((page, n_bytes, so_far.hexdigest(), "response", None, field.get("WARC-Target-URI"), number))
        columns = list(zip(*rows)) if rows else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record (segments joined): the columns of RECORDS."""
    text = spark.read.option("lineSep", SEPARATOR.decode()).text(path)
    return text.mapInArrow(_read_segments, RECORDS)


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages to the shared folder, and read the archives back."""
    path = shared_dir(pages.sparkSession, "warc")
    write_archives(pages, path, **options)
    return read_archives(pages.sparkSession, path)
