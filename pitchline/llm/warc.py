"""WARC archives: one gzip member a record, read back sequentially.

Writing: payloads' SHA-256 digests are counted first; of equal payloads of at least `least` bytes the smallest page_id is
the response and the others are revisit records that name it and repeat its digest and length but not its bytes.
Each task writes its rows as one archive, under a temporary name and then renamed.

Reading: one pass over the compressed stream. zlib inflates it by blocks, a member at a time; Content-Length frames the
record's block, and a response's payload is checked against its digest. Memory is one record and one block.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, lean, maybe_broadcast, open_fs, shared_dir, table, tune, unique_documents, write_file

LEVEL, BLOCK = 4, 1 << 18
_ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _clean(value: str) -> str:
    return "".join(c for c in value if c >= " " and c != "\x7f")


def record(page_id: int, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}",
        f"Content-Length: {len(block)}",
    ]
    if url:
        head.insert(3, f"WARC-Target-URI: {_clean(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def _fields(head: bytes) -> dict[str, str]:
    out, last = {}, None
    for line in head.split(b"\r\n")[1:]:
        text = line.decode()
        if text[:1] in (" ", "\t") and last:
            out[last] += " " + text.strip()
        elif ":" in text:
            k, _, v = text.partition(":")
            last = k.strip().lower()
            out[last] = v.strip()
    return out


def read_records(stream, block: int = BLOCK):
    """(fields, block bytes) of each record of a gzip stream, from front to back."""
    raw = b""

    def more(z, n=65536):
        """The next inflated bytes of this member; b'' at its end."""
        nonlocal raw
        while not z.eof:
            if not raw:
                raw = stream.read(block)
                if not raw:
                    raise ValueError("WARC: the archive ends within a record")
            out = z.decompress(raw, n)
            raw = z.unused_data if z.eof else z.unconsumed_tail
            if out:
                return out
        return b""

    while True:
        if not raw:
            raw = stream.read(block)
            if not raw:
                return
        z, held = zlib.decompressobj(31), bytearray()
        while (end := held.find(b"\r\n\r\n")) < 0:
            x = more(z)
            if not x:
                raise ValueError("WARC: a member without a whole header")
            held += x
        if not held.startswith(b"WARC/1."):
            raise ValueError("WARC: not a record")
        fields = _fields(bytes(held[:end]))
        size = int(fields["content-length"])
        del held[: end + 4]
        while len(held) < size + 4:
            x = more(z)
            if not x:
                raise ValueError("WARC: a record is shorter than its Content-Length")
            held += x
        if more(z) or len(held) != size + 4 or held[size:] != b"\r\n\r\n":
            raise ValueError("WARC: a record is longer than its Content-Length")
        yield fields, bytes(held[:size])


def parse_record(fields: dict[str, str], block: bytes):
    """(page_id, payload bytes, digest, type, refers_to, payload or None); a response's digest and length are verified."""
    head, _, payload = block.partition(b"\r\n\r\n")
    said, size = fields["warc-payload-digest"].removeprefix("sha256:"), int(_fields(head)["content-length"])
    page, kind = int(fields["warc-record-id"][len("<urn:page:") : -1]), fields["warc-type"]
    if kind == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != said:
            raise ValueError(f"WARC: page {page} does not match its digest")
        return page, size, said, kind, None, payload
    return page, size, said, kind, int(fields["warc-refers-to"][len("<urn:page:") : -1]), None


def _write(path: str, date: str):
    def run(batches):
        ctx, n = TaskContext.get(), 0
        name = f"{path}/part-{ctx.partitionId():06d}.warc.gz"

        def records():
            nonlocal n
            for b in batches:
                for page, url, html, ref in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
                    n += 1
                    yield record(page, url, html.as_buffer().to_pybytes() if html.is_valid else b"", ref, date)

        write_file(name, records(), f"{ctx.stageId()}-{ctx.taskAttemptId()}")
        yield pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([n], pa.int64())})

    return run


def write_warc(pages: DataFrame, path: str, least: int = 100, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write all pages as archives below path; returns (file, records).

    Null html is an empty payload, null url leaves the URI out. Rows without page_id are left out; for a repeated
    page_id see unique_documents. An empty table gives archives without records.
    """
    rows = unique_documents(pages, "html", "url", key="page_id").select("page_id", "url", "html")
    body = F.coalesce(F.col("html"), F.lit(""))
    seen = cut(rows.select("page_id", F.octet_length(body).alias("size"), F.sha2(body.cast("binary"), 256).alias("digest")).where(F.col("size") >= least).select("page_id", "digest"), "digests")
    first = cut(seen.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n"), "repeated")
    again = cut(seen.join(first, "digest").where("page_id <> refers_to").select("page_id", "refers_to"), "revisits")
    laid = rows.join(maybe_broadcast(again), "page_id", "left").select("page_id", "url", "html", "refers_to")
    return cut(laid.mapInArrow(lean(_write(path, date)), "file string, records long"), "archives")


def read_warc(files: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all records of the archives in column file."""

    def run(batches):
        for b in batches:
            for uri in b.column(0).to_pylist():
                fs, p = open_fs(uri)
                with fs.open_input_stream(p, compression=None) as stream:
                    rows = []
                    for fields, block in read_records(stream):
                        rows.append(parse_record(fields, block)[:5])
                        if len(rows) == 4096:
                            yield _batch(rows)
                            rows = []
                    if rows:
                        yield _batch(rows)

    names = files.select("file")
    return names.repartition(max(1, names.count()), "file").mapInArrow(lean(run), _ROWS)  # a number: else few rows, of much work, meet in one task


def _batch(rows):
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return read_warc(write_warc(table(spark, sf_dir, "pages"), shared_dir(spark, "warc")))


OP8_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT d.page_id, CAST(d.payload_bytes AS BIGINT) AS payload_bytes, d.payload_digest,
       CASE WHEN f.first_id IS NULL OR f.first_id = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first_id <> d.page_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f ON f.payload_digest = d.payload_digest AND d.payload_bytes >= 100
"""
