"""WARC archives: a writer of gzip members and a splittable reader that owns byte ranges."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylens.llm.common import map_arrow, stored

MAGIC = b"\x1f\x8b\x08"
SPLIT_BYTES = 8 << 20
FIRST_BYTES = 1 << 13
READ_BYTES = 1 << 18
MIN_BYTES = 0
DATE = "2000-01-01T00:00:00Z"
# An empty gzip member: what the text sink puts between blobs, so archives stay valid gzip files.
SEPARATOR = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + b"\x00" * 8


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: object, url: str | None, payload: bytes, refers_to: object, level: int = 6) -> bytes:
    """One gzip member holding a response, or a revisit without payload if ``refers_to`` is given.

    The HTTP block of a revisit keeps the length of the full payload.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_BYTES
) -> None:
    """Write one record per row below ``path``, through Spark's own sink and commit protocol.

    Of rows with equal payloads of at least ``min_bytes`` bytes, the one with the smallest id is
    the response and the others are revisits of it; rows that repeat the smallest id, and null
    ids, are responses.  A null payload is empty; a null URL leaves its header out.
    """
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload")
    ).withColumn("same", F.sha2("payload", 256))
    groups = rows.where(F.length("payload") >= min_bytes).groupBy("same").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    # Stored, so the planner knows its true size: groups of one page need no answer.
    groups = stored(groups.where("n > 1").select(F.col("same").alias("of"), "first"), "warc-groups")
    joined = rows.join(groups, F.col("same") == F.col("of"), "left").select(
        "id", "url", "payload", F.when(F.col("id") != F.col("first"), F.col("first")).alias("refers_to")
    )

    def blob(batch: pa.RecordBatch) -> pa.RecordBatch:
        members = [record(*row.values()) for row in batch.to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.large_binary())], names=["blob"])

    blobs = map_arrow(joined, blob, "blob binary")
    sink = blobs.select(F.col("blob").cast("string").alias("value")).write
    sink.option("encoding", "ISO-8859-1").option("lineSep", SEPARATOR.decode("latin-1")).text(path)


def open_input(path: str) -> pa.NativeFile:
    """A seekable file in any store that the worker can reach."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return pa.OSFile(unquote(parts.path) if parts.scheme else path)
    system, inner = pyarrow.fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


class Buffered:
    """Reads of any size and place over one buffer that moves forward."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.base, self.data = file, 0, b""

    def __call__(self, at: int, size: int) -> bytes:
        if at < self.base or at + size > self.base + len(self.data):
            self.file.seek(at)
            self.base, self.data = at, self.file.read(max(size, 4 * READ_BYTES))
        return self.data[at - self.base : at - self.base + size]


def members(read: Callable[[int, int], bytes], start: int, end: int) -> Iterator[bytes]:
    """Contents of the WARC members that begin in [start, end); reads past ``end`` to finish one.

    Every gzip magic is a candidate.  It counts when its first bytes inflate to a WARC header;
    else the search goes on one byte later.  ``read(offset, size)`` is short only at the end.
    """
    at = start
    while at < end:
        window = read(at, min(FIRST_BYTES, end - at + len(MAGIC) - 1))
        found = window.find(MAGIC)
        if found < 0:
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        at += found
        if at >= end:
            return
        size, content = _inflate(read, at)
        if content is None:
            at += 1
            continue
        at += size
        if content:
            yield content


def _inflate(read: Callable[[int, int], bytes], at: int) -> tuple[int, bytes | None]:
    """Size in the file and content of the member at ``at``; no content if it is not WARC."""
    unzip, parts, fed, checked = zlib.decompressobj(31), [], 0, b""
    while not unzip.eof:
        block = read(at + fed, min(READ_BYTES, max(FIRST_BYTES, fed)))
        if not block:
            if checked.startswith(b"WARC/"):
                raise ValueError(f"the member at byte {at} is cut off")
            return 0, None
        fed += len(block)
        try:
            parts.append(unzip.decompress(block))
        except zlib.error:
            if checked.startswith(b"WARC/"):
                raise
            return 0, None
        checked = checked if len(checked) >= 5 else (checked + parts[-1])[:5]
        if len(checked) >= 5 and checked != b"WARC/":
            return 0, None
    if checked and checked != b"WARC/":
        return 0, None
    return fed - len(unzip.unused_data), b"".join(parts)


def _headers(block: bytes) -> tuple[dict[str, str], int]:
    """Header fields in lower case after the first line, and where the body begins."""
    end = block.find(b"\r\n\r\n")
    end = len(block) if end < 0 else end
    lines = block[:end].decode("utf-8", "replace").split("\r\n")[1:]
    fields = (line.partition(":") for line in lines)
    return {k.strip().lower(): v.strip() for k, _, v in fields}, min(len(block), end + 4)


def records(content: bytes) -> Iterator[dict[str, object]]:
    """Records of one member, mostly one."""
    while content.startswith(b"WARC/"):
        head, body = _headers(content)
        size = int(head.get("content-length", 0))
        block, content = content[body : body + size], content[body + size + 4 :]
        is_http = head.get("content-type", "").startswith("application/http")
        http, begin = _headers(block) if is_http else ({}, 0)
        kind, payload = head.get("warc-type"), block[begin:]
        known = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
        length = int(http["content-length"]) if kind == "revisit" and "content-length" in http else len(payload)
        yield {
            "record_id": head.get("warc-record-id"),
            "record_type": kind,
            "target_uri": head.get("warc-target-uri"),
            "refers_to": head.get("warc-refers-to"),
            "payload": payload,
            "payload_bytes": length,
            "payload_digest": known if kind == "revisit" else digest(payload),
        }


RECORD = (
    "record_id string, record_type string, target_uri string, refers_to string, payload binary, "
    "payload_bytes bigint, payload_digest string"
)


def read_archives(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``.

    Files are cut into ranges of ``split_bytes``; a task owns the members that begin in its range.
    Ranges are dealt out one by one to as many tasks: a range is a few bytes for the planner, which
    would otherwise join them all in one task.
    ``payloads=False`` leaves that column null.  Digests of responses are those of the payload
    read, of revisits those in the header.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(split_bytes).cast("bigint"))
    ranges = files.where("length > 0").select("path", "length", F.explode(starts).alias("start"))
    ranges = ranges.repartition(max(1, ranges.count()))
    names = ["record_id", "record_type", "target_uri", "refers_to", "payload", "payload_bytes", "payload_digest"]
    kinds = [pa.string()] * 4 + [pa.binary(), pa.int64(), pa.string()]
    schema = pa.schema(list(zip(names, kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                kept, size = [], 0
                with open_input(row["path"]) as file:
                    for content in members(Buffered(file), row["start"], min(row["start"] + split_bytes, row["length"])):
                        for found in records(content):
                            size += len(found["payload"])
                            kept.append(found if payloads else {**found, "payload": None})
                        if size > SPLIT_BYTES:
                            yield pa.RecordBatch.from_pylist(kept, schema)
                            kept, size = [], 0
                yield pa.RecordBatch.from_pylist(kept, schema)

    return ranges.mapInArrow(run, RECORD)


def page_of(urn: str) -> Column:
    """The id in ``<urn:page:ID>``, as text."""
    return F.nullif(F.regexp_extract(urn, r"^<urn:page:(.*)>$", 1), F.lit(""))
