"""WARC archives: write pages as records, read them back, put segmented records together again.

Writing. A page's payload is its html in UTF-8, sent as an HTTP response with chunked framing. A block longer than ``SEGMENT``
bytes is cut into a first record and continuation records, each naming its origin and number, the last one the
total length. Of equal payloads of ``MIN_REVISIT`` bytes or more the smallest ``page_id`` is written in full and the others as
revisits. A WARC record ends with two line ends, so Spark's text writer with that separator writes
valid archives, gzip-compressed, of at most ``FILE_RECORDS`` records each.

Reading. Each archive is parsed by one task, record by record. Continuation records are grouped by their origin,
ordered by segment number and joined; the total length is checked, the chunked framing decoded and the payload's digest
compared. A group is the segments of one page.

Equal payloads are found by counting digests with partial aggregation; the table of repeated digests is broadcast only if its
measured size allows it, and is joined with skew handling otherwise.

Defined cases: null html is an empty payload; pages without an id are responses unless a page with an id has the same payload,
and are never referred to; repeated rows of the smallest id are all responses; a null url is left out of the record;
a record whose length or digest does not fit has ``complete`` false and no payload.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import run_dir
from .text import slices

MIN_REVISIT = 100
SEGMENT = 64 << 10
CHUNK = 8 << 10
FILE_RECORDS = 1_000
BROADCAST_DIGESTS = 100_000
# Fixed values of the format.
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GAP = b"\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def _pieces(data: bytes, size: int) -> Iterator[bytes]:
    """Pieces of about ``size`` bytes that do not cut a character."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def chunked(payload: bytes) -> bytes:
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in _pieces(payload, CHUNK)) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[end + 2: end + 2 + size])
        if body[end + 2 + size: end + 4 + size] != b"\r\n":
            raise ValueError("broken chunk")
        at = end + 4 + size


def _record(kind: str, block: bytes, **fields) -> bytes:
    head = {"WARC-Type": kind, "WARC-Date": DATE, **fields, "Content-Length": len(block)}
    lines = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def records_of(page_id, url, payload: bytes, digest: str, refers_to) -> Iterator[bytes]:
    """The records of one page, without the two line ends after each."""
    name = f"<urn:uuid:{uuid.uuid4()}>"
    uri = None if url is None else "".join(c if c > " " and c != "\x7f" else "%{:02X}".format(ord(c)) for c in url)
    common = {"WARC_Record_ID": name, "WARC_Target_URI": uri, "WARC_Payload_Digest": f"sha256:{digest}",
              "X_Page_Id": page_id, "Content_Type": "application/http;msgtype=response"}
    if refers_to is not None:
        block = _HTTP + b"Content-Length: %d\r\n\r\n" % len(payload)
        yield _record("revisit", block, **common, WARC_Profile=PROFILE, X_Refers_To_Page_Id=refers_to)
        return
    block = _HTTP + b"Transfer-Encoding: chunked" + _GAP + chunked(payload)
    if len(block) <= SEGMENT:
        yield _record("response", block, **common)
        return
    parts = list(_pieces(block, SEGMENT))
    yield _record("response", parts[0], **common, WARC_Segment_Number=1)
    for number, part in enumerate(parts[1:], 2):
        yield _record("continuation", part, WARC_Record_ID=f"<urn:uuid:{uuid.uuid4()}>", WARC_Segment_Origin_ID=name,
                      WARC_Segment_Number=number,
                      WARC_Segment_Total_Length=len(block) if number == len(parts) else None)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, 64):
        columns = [part[c].to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r for row in zip(*columns) for r in records_of(*row)], pa.binary())], names=["record"])


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``."""
    spark = pages.sparkSession
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    path = run_dir(spark, "digests")
    (rows.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest")
     .agg(F.min("page_id").alias("first"), F.count("*").alias("pages")).where("pages > 1 and first is not null")
     .select("digest", "first").write.parquet(path))
    repeated = spark.read.schema("digest string, first bigint").parquet(path)
    if repeated.count() <= BROADCAST_DIGESTS:
        repeated = F.broadcast(repeated)
    revisit = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") != F.col("first")))
    return rows.join(repeated, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str) -> None:
    records = with_revisits(pages).mapInArrow(_write, "record binary").select(F.col("record").cast("string"))
    records.write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", FILE_RECORDS).text(path)


def parse(stream) -> Iterator[tuple[dict, bytes]]:
    """Header fields (names in lower case) and block of each record."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode().partition(":")
            fields[key.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if stream.read(4) != _GAP:
            raise ValueError("record does not end where its length says")
        yield fields, block


_RAW = pa.schema([("kind", pa.string()), ("origin", pa.string()), ("number", pa.int64()), ("total", pa.int64()),
                  ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("refers_to", pa.int64()),
                  ("block", pa.binary())])
RAW = ("kind string, origin string, number bigint, total bigint, page_id bigint, url string, digest string, "
       "refers_to bigint, block binary")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = lambda fields, key: int(fields[key]) if key in fields else None
    for batch in batches:
        for content in batch["content"]:
            rows, held = [], 0
            for f, block in parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                rows.append({
                    "kind": f["warc-type"], "origin": f.get("warc-segment-origin-id", f["warc-record-id"]),
                    "number": number(f, "warc-segment-number"), "total": number(f, "warc-segment-total-length"),
                    "page_id": number(f, "x-page-id"), "url": f.get("warc-target-uri"),
                    "digest": f.get("warc-payload-digest", "").removeprefix("sha256:"),
                    "refers_to": number(f, "x-refers-to-page-id"), "block": block})
                held += len(block)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RAW)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_RAW)


def _http(block: bytes) -> tuple[dict, bytes]:
    head, _, body = block.partition(_GAP)
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}, body


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads of whole records: ``parts`` in order, ``total`` where the record was segmented."""
    for part in slices(batches, 64):
        payloads, sizes, complete = [], [], []
        for kind, total, digest, parts in zip(part["kind"].to_pylist(), part["total"].to_pylist(),
                                              part["digest"].to_pylist(), part["parts"]):
            block = b"".join(p.as_py() for p in parts)
            fields, body = _http(block)
            payload, size, fits = None, None, total is None or total == len(block)
            if kind == "revisit":
                size = int(fields[b"content-length"])
            elif fits:
                payload = unchunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body
                fits = hashlib.sha256(payload).hexdigest() == digest
                payload, size = (payload, len(payload)) if fits else (None, None)
            payloads.append(payload)
            sizes.append(size)
            complete.append(fits)
        kept = ["page_id", "url", "kind", "digest", "refers_to", "segments"]
        yield pa.RecordBatch.from_arrays(
            [*[part[c] for c in kept], pa.array(payloads, pa.binary()), pa.array(sizes, pa.int64()),
             pa.array(complete, pa.bool_())], names=[*kept, "payload", "payload_bytes", "complete"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, url, kind, digest, refers_to, segments, payload, payload_bytes, complete`` per page."""
    raw = spark.read.format("binaryFile").load(path).select("content").mapInArrow(_read, RAW)
    named = ["page_id", "url", "kind", "digest", "refers_to"]
    whole = raw.where("number is null").select(
        *named, "total", F.array("block").alias("parts"), F.lit(1).cast("long").alias("segments"))
    first = F.col("number") == 1
    joined = raw.where("number is not null").groupBy("origin").agg(
        *[F.max(F.when(first, F.col(c))).alias(c) for c in named],
        F.coalesce(F.max("total"), F.lit(-1).cast("long")).alias("total"),
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("found"))
    # A missing or repeated segment leaves the numbers other than 1, 2, 3 ...; the record is then incomplete.
    in_order = F.expr("transform(found, x -> x.number) = transform(sequence(1, size(found)), i -> cast(i as bigint))")
    joined = joined.select(*named, F.when(in_order, F.col("total")).otherwise(-1).alias("total"),
                           F.col("found.block").alias("parts"), F.size("found").cast("long").alias("segments"))
    return whole.unionByName(joined).mapInArrow(
        _decode, "page_id bigint, url string, kind string, digest string, refers_to bigint, segments bigint, "
                 "payload binary, payload_bytes bigint, complete boolean")


def report(pages: DataFrame) -> DataFrame:
    """Write all pages, read them back; ``digest`` has been checked against the decoded payload where there is one."""
    path = run_dir(pages.sparkSession, "warc")
    write_archives(pages.select("page_id", "url", "html"), path)
    return read_archives(pages.sparkSession, path).select(
        "page_id", "payload_bytes", F.when(F.col("complete"), F.col("digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"), "refers_to")


REPORT_SQL = r"""
with p as (select page_id, coalesce(html, '') as h from pages),
g as (select *, min(page_id) over (partition by h) as first from p)
select page_id, cast(octet_length(encode(h)) as bigint) as payload_bytes, sha256(h) as payload_digest,
       case when octet_length(encode(h)) >= 100 and first is not null and page_id is distinct from first then 'revisit'
            else 'response' end as record_type,
       case when octet_length(encode(h)) >= 100 and page_id is distinct from first then first end as refers_to
from g
"""
