"""WARC archives written from pages and read back, records in segments included.

Writing: of equal payloads the smallest id gets a response record, the others revisit
records that refer to it.  A response is an HTTP message in chunked transfer framing.  A
block longer than ``segment_bytes`` is cut into a first record and continuation records.

Reading: archive files are parsed by their content lengths.  Continuations are grouped by
the id of the record they continue, ordered by segment number, checked against the total
length, joined, and then the chunks are decoded.  A group is one record, so it is no
larger than a page; records that are whole never leave the task that parsed them.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.scratch import scratch_folder, written
from .common import ship_package, utf8

SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4 * 1024
PAGES_AT_ONCE = 128
BLOCKS_AT_ONCE = 4 << 20  # bytes of segments that are passed on together
DATE = "2024-01-01T00:00:00Z"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    b"Transfer-Encoding: chunked\r\n\r\n"
)
PARSED = (
    "record_id string, kind string, page string, digest string, refers string, origin string, "
    "segment int, total long, length long, block binary"
)


# -- records -------------------------------------------------------------------


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def hex_to_base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Payload in chunked transfer framing."""
    parts = [payload[at : at + size] for at in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """Payload of a body in chunked framing; chunk extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(parts)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk ends early")
        parts.append(body[at : at + size])
        at += size + 2


def record(fields: dict[str, str | int | None], block: bytes) -> bytes:
    """One record without the two line ends that close it.  Fields of None are left out."""
    lines = [f"{name}: {clean(value)}" for name, value in fields.items() if value is not None]
    head = "\r\n".join([VERSION.decode(), *lines, f"Content-Length: {len(block)}", "", ""])
    return head.encode() + block


def clean(value: str | int) -> str:
    """A header value on one line."""
    return " ".join(str(value).split())


def response_records(
    name: str, page: str, url: str | None, payload: bytes, segment_bytes: int, digest: str | None = None
) -> list[bytes]:
    """The response for a page: one record, or a first segment and its continuations."""
    block = HTTP_HEAD + chunked(payload)
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    own = {
        "WARC-Type": "response",
        "WARC-Record-ID": f"<urn:page:{name}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": url,
        "Page-ID": page,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest or sha1_base32(payload)}",
        "WARC-Segment-Number": 1 if len(parts) > 1 else None,
    }
    found = [record(own, parts[0])]
    for number, part in enumerate(parts[1:], 2):
        follows = {
            "WARC-Type": "continuation",
            "WARC-Record-ID": f"<urn:page:{name}:{number}>",
            "WARC-Date": DATE,
            "WARC-Segment-Origin-ID": f"<urn:page:{name}>",
            "WARC-Segment-Number": number,
            "WARC-Segment-Total-Length": len(block) if number == len(parts) else None,
        }
        found.append(record(follows, part))
    return found


def revisit_record(name: str, page: str, url: str | None, digest: str, refers: str) -> bytes:
    own = {
        "WARC-Type": "revisit",
        "WARC-Record-ID": f"<urn:page:{name}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": url,
        "Page-ID": page,
        "WARC-Profile": REVISIT_PROFILE,
        "WARC-Refers-To": f"<urn:page:{refers}>",
        "WARC-Payload-Digest": f"sha1:{digest}",
    }
    return record(own, b"")


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an archive."""
    data = gzip.decompress(archive) if archive[:2] == b"\x1f\x8b" else archive
    at = 0
    while at < len(data):
        if not data.startswith(VERSION[:5], at):
            raise ValueError(f"no record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        start, length = end + 4, int(head["content-length"])
        if len(data) < start + length:
            raise ValueError(f"the record at byte {at} ends early")
        yield head, data[start : start + length]
        at = start + length + 4


def _sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Small parts of batches, so that few copies of payloads are held at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


# -- writing -------------------------------------------------------------------


def _resolved(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int) -> DataFrame:
    """Each page with its payload and the page that holds an equal one."""
    payload = utf8(F.col(payload_col))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).alias("size"),
        F.crc32(payload).alias("crc"),
    )
    same = ["digest", "size", "crc"]
    # Only digests are grouped; the join takes those of payloads that occur twice.
    groups = rows.groupBy(*same).agg(F.min("page_id").alias("holder"), F.count(F.lit(1)).alias("copies"))
    shared = groups.filter((F.col("copies") > 1) & (F.col("size") >= least)).select(*same, "holder")
    # Written, so that the join can split a payload that a large part of all pages have.
    shared = written(shared, f"{scratch_folder(pages.sparkSession)}/shared")
    return rows.join(shared, same, "left").withColumn(
        "refers",
        F.when(~F.col("page_id").eqNullSafe(F.col("holder")) & F.col("holder").isNotNull(), F.col("holder")),
    )


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    segment_bytes: int = SEGMENT_BYTES,
    least_revisit_bytes: int = 0,
) -> None:
    """Write one record (or its segments) for each page as gzip archives under ``path``.

    Equal payloads of at least ``least_revisit_bytes`` bytes are held once, by the
    smallest id; rows that repeat that id are responses too.  A null payload counts as
    empty.  A null id is written without a number and takes part in groups of equal
    payloads, where it revisits.  Spark's text writer puts the files on any storage; the
    two line ends after a record are its line separator.
    """
    ship_package(pages.sparkSession)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches, PAGES_AT_ONCE):
            records: list[bytes] = []
            for page, url, payload, sha1, refers in zip(*(c.to_pylist() for c in batch.columns)):
                text, digest = "" if page is None else str(page), hex_to_base32(sha1)
                name = f"{text or 'none'}:{digest}"
                if refers is not None:
                    records.append(revisit_record(name, text, url, digest, f"{refers}:{digest}"))
                else:
                    records += response_records(name, text, url, payload, segment_bytes, digest)
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    rows = _resolved(pages, id_col, url_col, payload_col, least_revisit_bytes)
    # A record's name is its page and payload: rows that repeat both are the same record.
    rows = rows.select(
        "page_id",
        "url",
        F.when(F.col("refers").isNull(), F.col("payload")).alias("payload"),
        "digest",
        "refers",
    )
    (
        rows.mapInArrow(written, "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.mode("overwrite")
        .option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        .text(path)
    )


# -- reading -------------------------------------------------------------------


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``, as it stands in the files.

    A task holds one archive file at a time; writers keep these to the size of a
    partition.  Records whose block can be decoded alone come with the payload's length
    and digest, and without the block.
    """
    ship_package(spark)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows, size = [], 0
                for head, block in parse(archive.as_py()):
                    row = _described(head, block)
                    rows.append(row)
                    size += len(row[-1] or b"")
                    if len(rows) >= 2000 or size > BLOCKS_AT_ONCE:
                        yield _records(rows)
                        rows, size = [], 0
                if rows:
                    yield _records(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parsed, PARSED)


def _described(head: dict[str, str], block: bytes) -> tuple:
    kind, segment = head["warc-type"], head.get("warc-segment-number")
    payload = payload_of(block) if kind == "response" and segment is None else None
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if payload is not None and sha1_base32(payload) != digest:
        raise ValueError(f"the payload of {head['warc-record-id']} has another digest")
    return (
        head["warc-record-id"], kind, head.get("page-id"), digest, head.get("warc-refers-to"),
        head.get("warc-segment-origin-id") or head["warc-record-id"],
        int(segment) if segment else None,
        int(head["warc-segment-total-length"]) if "warc-segment-total-length" in head else None,
        len(payload) if payload is not None else None,
        block if segment else None,
    )


def _records(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string()] * 6 + [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    names = [part.split()[0] for part in PARSED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP message, its chunks decoded."""
    head, _, body = block.partition(b"\r\n\r\n")
    framed = any(
        line.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for line in head.split(b"\r\n")
    )
    return dechunked(body) if framed else body


def _joined(numbers: pa.Array, totals: pa.Array, blocks: pa.Array) -> pa.Array:
    """Length and digest of each segmented record's payload; None where it is not whole."""
    found = []
    for row in range(len(numbers)):
        order, total = numbers[row].as_py(), totals[row].as_py()
        block = b"".join(blocks[row].as_py())
        if order != list(range(1, len(order) + 1)) or total != len(block):
            found.append(None)
            continue
        payload = payload_of(block)
        found.append({"length": len(payload), "digest": sha1_base32(payload)})
    return pa.array(found, pa.struct([("length", pa.int64()), ("digest", pa.string())]))


def reassembled(records: DataFrame) -> DataFrame:
    """``origin, length, digest, whole`` of the records that were cut into segments.

    A record is whole if its segments are numbered from 1 without a gap and their blocks
    have the total length that the last one states.  Segments that an archive repeats
    count once.
    """
    ship_package(records.sparkSession)
    parts = records.filter("segment IS NOT NULL").dropDuplicates(["origin", "segment"])
    ordered = F.sort_array(F.collect_list(F.struct("segment", "block")))
    grouped = parts.groupBy("origin").agg(ordered.alias("parts"), F.max("total").alias("total"))
    joined = F.arrow_udf(_joined, "struct<length: long, digest: string>")(
        F.col("parts.segment"), F.col("total"), F.col("parts.block")
    )
    return grouped.select("origin", joined.alias("found")).select(
        "origin", "found.length", "found.digest", F.col("found").isNotNull().alias("whole")
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, whole``, a row a page.

    Digests are computed from the payloads that were read, those of revisits looked up at
    the response they refer to.  A record whose segments are not whole has nulls there.
    No archives, no rows.
    """
    records = read_records(spark, path)
    page = F.expr("try_cast(page AS long)")
    alone = records.filter("kind = 'response' AND segment IS NULL").select(
        page.alias("page_id"), "length", "digest", F.lit(True).alias("whole")
    )
    first = records.filter("kind = 'response' AND segment = 1").select("origin", page.alias("page_id"))
    joined = first.join(reassembled(records), "origin").select("page_id", "length", "digest", "whole")
    responses = alone.unionByName(joined)
    revisits = records.filter("kind = 'revisit'").select(
        page.alias("page_id"),
        F.col("digest").alias("stated"),
        F.regexp_extract("refers", r"<urn:page:(-?\d+):", 1).cast("long").alias("refers_to"),
    )
    held = responses.groupBy(F.col("page_id").alias("refers_to"), F.col("digest").alias("stated")).agg(
        F.max("length").alias("length"), F.max("whole").alias("whole")
    )
    revisits = revisits.join(held, ["refers_to", "stated"], "left").select(
        "page_id",
        "length",
        F.when(F.col("whole"), F.col("stated")).alias("digest"),
        F.coalesce("whole", F.lit(False)).alias("whole"),
        F.lit("revisit").alias("record_type"),
        "refers_to",
    )
    responses = responses.select(
        "*", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")
    )
    return responses.unionByName(revisits).select(
        "page_id",
        F.col("length").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
        "whole",
    )
