"""WARC archives: a writer with revisits and segments, and a reader that
reassembles segments and decodes chunked transfer framing.

Writer: one record per page. The payload is carried as an HTTP message in
chunked transfer encoding; a block longer than ``SEGMENT_BYTES`` is split into
a first record (WARC-Segment-Number 1) and continuation records that name its
record id (WARC-Segment-Origin-ID), the last with WARC-Segment-Total-Length.
Every record is a gzip member of its own. A task writes to file names of its
own attempt in the shared folder and returns them, so leftovers of lost
attempts are never read.

Reader: the names of the archives (``RECORDS_PER_FILE`` records at most each)
are dealt to tasks, which read them as streams from the shared folder, parse
records, and send these on compressed; they are grouped by origin id, ordered by segment number, checked for gaps and
against the total length, and their chunked framing is decoded. Revisits take
the payload's length from the response they refer to.

Defined results: null html is the empty payload; null ids are always written as
responses (nothing can refer to them); of rows that repeat the smallest id with
an equal payload each is a response; an empty table gives an empty result; null
urls are written as an empty target; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulaframe.llm.common import cut, shared_folder, shared_fs, table

SEGMENT_BYTES, RECORDS_PER_FILE, CHUNK_BYTES, LEAST_REVISIT = 64 << 10, 1000, 16 << 10, 100
_RECORDS = ("record_id string, origin_id string, segment int, total_length long, warc_type string, page_id long, "
            "target string, refers_to long, payload_digest string, block binary")


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer coding (RFC 9112, section 7.1)."""
    parts = [b"%x\r\n%b\r\n" % (len(payload[i:i + size]), payload[i:i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """Payload of a chunked body; raises on broken framing."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("chunk without its end")
        out.append(body[at:at + size])
        at += size + 2


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(block)}\r\n\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


def _page_records(page_id, url, payload: bytes, digest: str, refers_to, date: str):
    rid = f"<urn:uuid:{uuid.uuid4()}>"
    own = [("WARC-Target-URI", (url or "").replace("\r", "").replace("\n", "")), ("WARC-Date", date),
           ("X-Page-ID", "" if page_id is None else str(page_id)), ("WARC-Payload-Digest", f"sha256:{digest}")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers_to is not None:
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", rid), *own, ("X-Refers-To-Page-ID", str(refers_to)),
                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                       ("Content-Type", "application/http; msgtype=response")], http)
        return
    block = http + chunked(payload)
    parts = [block[i:i + SEGMENT_BYTES] for i in range(0, len(block), SEGMENT_BYTES)]
    for k, part in enumerate(parts, 1):
        fields = [("WARC-Type", "response" if k == 1 else "continuation"),
                  ("WARC-Record-ID", rid if k == 1 else f"<urn:uuid:{uuid.uuid4()}>"), *own,
                  ("Content-Type", "application/http; msgtype=response")]
        if len(parts) > 1:
            fields.append(("WARC-Segment-Number", str(k)))
            if k > 1:
                fields.append(("WARC-Segment-Origin-ID", rid))
            if k == len(parts):
                fields.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _record(fields, part)


def _write(folder: str, date: str):
    def run(batches):
        out, name, n = None, "", 0

        def done():
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["file", "records"])

        for b in batches:
            for page, url, html, digest, refers in zip(*(c.to_pylist() for c in (b.column(0), b.column(1), b.column(2).cast(pa.binary()), b.column(3), b.column(4)))):
                for rec in _page_records(page, url, html, digest, refers, date):
                    if out is None:
                        fs, path = shared_fs(folder)
                        name, n = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{path}/{name}", compression=None)
                        out.write(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                                           ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    out.write(rec)
                    n += 1
                    if n >= RECORDS_PER_FILE:
                        yield done()
                        out = None
        if out is not None:
            yield done()

    return run


def write_warc(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
               least_revisit: int = LEAST_REVISIT, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes the pages; the manifest: file, records. Of equal payloads of at
    least ``least_revisit`` bytes the smallest id is the response."""
    fs, path = shared_fs(folder)
    fs.create_dir(path, recursive=True)
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    src = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("html")) \
        .withColumn("digest", F.sha2("html", 256))
    first = src.filter(F.octet_length("html") >= least_revisit).groupBy("digest") \
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").select("digest", "first_id")
    refers = F.when(F.col("page_id") > F.col("first_id"), F.col("first_id"))
    told = src.join(first, "digest", "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))
    return cut(told.mapInArrow(_write(folder, date), "file string, records long"))


def parse_warc(stream) -> list[dict]:
    """Records of an uncompressed WARC stream: header fields (lower case) and
    ``block``."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/1."):
            raise ValueError("not a WARC record")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode("utf-8").partition(":")
            fields[k.strip().lower()] = v.strip()
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError("a record ends before its length")
        yield fields | {"block": block}


def _parse(folder: str):
    """Records of the archives that a task is given by name, read from the
    shared folder as streams."""
    number = lambda x: int(x) if x else None

    def records(name):
        fs, path = shared_fs(folder)
        with fs.open_input_stream(f"{path}/{name}", compression=None) as raw:
            yield from parse_warc(io.BufferedReader(gzip.GzipFile(fileobj=raw)))

    def run(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                rows, held = [], 0
                for f in records(name):
                    if f["warc-type"] == "warcinfo":
                        continue
                    rows.append((f["warc-record-id"], f.get("warc-segment-origin-id") or f["warc-record-id"],
                                 int(f.get("warc-segment-number", 1)), number(f.get("warc-segment-total-length")), f["warc-type"],
                                 number(f.get("x-page-id")), f.get("warc-target-uri"), number(f.get("x-refers-to-page-id")),
                                 f.get("warc-payload-digest", "").partition(":")[2], zlib.compress(f["block"], 3)))  # shuffled compressed
                    held += len(f["block"])
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return run


def _batch(rows):
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in _RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _payloads(batches):
    for b in batches:
        cols = [b.column(i).to_pylist() for i in range(b.num_columns)]
        rows = []
        for page, target, kind, refers, digest, numbers, total, blocks in zip(*cols):
            block = b"".join(map(zlib.decompress, blocks))
            if numbers != list(range(1, len(numbers) + 1)) or len(numbers) > 1 and total is None:
                raise ValueError(f"page {page}: segments {numbers} aren't complete")
            if total is not None and total != len(block):
                raise ValueError(f"page {page}: {len(block)} bytes, not {total}")
            head, _, body = block.partition(b"\r\n\r\n")
            payload = None
            if kind == "response":
                payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
                if hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"page {page}: its payload has another digest")
            rows.append((page, target, kind, refers, digest, payload))
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 6, kinds)],
                                         ["page_id", "target", "record_type", "refers_to", "payload_digest", "payload"])


def read_warc(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per whole record: page_id, target, record_type, refers_to,
    payload_digest, payload (null for revisits)."""
    # names are dealt to tasks, contents are read there: archives aren't shuffled
    names = manifest.select("file").repartition(max(1, manifest.count()), "file")
    records = names.mapInArrow(_parse(folder), _RECORDS)
    part = F.struct("segment", "block", "total_length", "warc_type", "page_id", "target", "refers_to", "payload_digest")
    whole = records.groupBy("origin_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    first = F.col("parts")[0]
    return whole.select(first["page_id"].alias("page_id"), first["target"].alias("target"), first["warc_type"].alias("kind"),
                        first["refers_to"].alias("refers_to"), first["payload_digest"].alias("digest"),
                        F.col("parts.segment").alias("numbers"), F.array_max("parts.total_length").alias("total"),
                        F.col("parts.block").alias("blocks")) \
        .mapInArrow(_payloads, "page_id long, target string, record_type string, refers_to long, payload_digest string, payload binary")


def op5_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    manifest = write_warc(table(spark, sf_dir, "pages"), folder)
    got = read_warc(spark, folder, manifest) \
        .select("page_id", F.octet_length("payload").cast("long").alias("n"), "payload_digest", "record_type", "refers_to")
    got = cut(got)
    known = got.filter("record_type = 'response'").groupBy("payload_digest").agg(F.max("n").alias("payload_bytes"))
    return got.join(known, "payload_digest").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM f
"""
