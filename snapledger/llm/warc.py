"""WARC archives: a writer with revisit records and a splittable reader.

Every record is a gzip member of its own. A reading task gets a byte range, scans it for the gzip
magic number, takes a place for a member only if its first bytes decode to a WARC header, and owns
the records that start inside its range; the last of them may end beyond it.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapledger.llm.common import as_text, small_side, written
from snapledger.session import new_dir

#: First bytes of a gzip member with deflate (fixed values of RFC 1952).
MAGIC = b"\x1f\x8b\x08"
#: Line that WARC records begin with, without the minor version (fixed value of ISO 28500).
VERSION = b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REVISIT_FROM = 100
SPLIT_BYTES = 8 << 20
STEP = 1 << 16
LEVEL = 6

MANIFEST_SCHEMA = "path string, bytes long, records long"
RECORD_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, "
    "payload_bytes long, payload binary, path string, position long"
)
RECORD_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
        ("path", pa.string()), ("position", pa.int64()),
    ]
)


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member. A revisit has the HTTP header alone, which names the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # White space, controls and the percent sign would not survive as a header value.
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$&'()*+,/:;=?@[]~"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def with_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """page_id, url, html, digest, refers_to: the smallest id with an equal payload, NULL for that page itself."""
    html = as_text(html_col)
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        html.alias("html"),
        F.sha2(F.encode(html, "UTF-8"), 256).alias("digest"),
    )
    long_enough = F.octet_length("html") >= REVISIT_FROM
    # Partial aggregation takes a payload that a third of the pages share down to a row per task.
    groups = rows.filter(long_enough).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    groups = written(groups.filter("n > 1").select("digest", "first"), "payloads")
    # Few repeated payloads are broadcast and the pages stay where they are; beyond the bound a skewed
    # payload is split at run time.
    joined = rows.join(small_side(groups, groups.count()), "digest", "left")
    refers = F.when(F.col("page_id").isNotNull() & (F.col("page_id") != F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2020-01-01T00:00:00Z"
) -> DataFrame:
    """Write each page as a record below ``path``, one archive per task; return the manifest of the archives.

    Of pages with equal payloads of 100 bytes or more the one with the smallest id is a response and
    the others revisit it. NULL html is an empty payload. Pages with a NULL id are responses; pages
    that repeat the smallest id and its payload are all responses. An archive counts only if the
    manifest names it: a repeated task leaves a file that nobody reads.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(path)
        target, out, records = f"{root}/{uuid.uuid4().hex}.warc.gz", None, 0
        size = 0
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(batch.column(i) for i in range(5))):
                member = record(
                    page_id.as_py(), url.as_py(), html.as_buffer().to_pybytes(), digest.as_py(), refers_to.as_py(), date
                )
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(target, compression=None)
                out.write(member)
                size += len(member)
                records += 1
        if out is not None:
            out.close()
            full = f"{path.rstrip('/')}/{target.rpartition('/')[2]}"
            yield pa.RecordBatch.from_pydict({"path": [full], "bytes": [size], "records": [records]})

    return written(with_revisits(pages, id_col, url_col, html_col).mapInArrow(write, MANIFEST_SCHEMA), "manifest")


class Window:
    """Bytes of a file from a start on, read further only as far as they are asked for."""

    def __init__(self, file, start: int, size: int, first: int):
        self.file, self.size, self.end = file, size, start
        self.start, self.data = start, bytearray()
        file.seek(start)
        self.upto(start + first)

    def upto(self, end: int) -> None:
        end = min(end, self.size)
        while self.end < end:
            got = self.file.read(end - self.end)
            if not got:
                break
            self.data += got
            self.end += len(got)

    def piece(self, at: int, length: int) -> bytes:
        self.upto(at + length)
        return bytes(self.data[at - self.start : at - self.start + length])


def member_at(window: Window, at: int) -> tuple[bytes, int] | None:
    """The decoded member that starts here and where it ends; None if none does, or it isn't a WARC record."""
    unpack, parts, place, known = zlib.decompressobj(31), [], at, False
    while not unpack.eof:
        piece = window.piece(place, STEP if known else 1024)
        if not piece:
            return None
        place += len(piece)
        try:
            parts.append(unpack.decompress(piece))
        except zlib.error:
            return None
        if not known:
            head = b"".join(parts)[: len(VERSION)]
            if not VERSION.startswith(head):
                return None
            known = len(head) == len(VERSION)
    if not known:
        return None
    return b"".join(parts), place - len(unpack.unused_data)


def fields(block: bytes) -> tuple[dict[str, str], int]:
    """Header fields with lower-case names, and where the block after the empty line begins."""
    end = block.find(b"\r\n\r\n")
    if end < 0:
        return {}, len(block)
    pairs = (line.partition(":") for line in block[:end].decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}, end + 4


def page_number(value: str | None) -> int | None:
    digits = (value or "").strip("<>").rpartition(":")[2]
    return int(digits) if digits.lstrip("-").isdigit() else None


def parsed(member: bytes) -> tuple | None:
    head, start = fields(member)
    if not head.get("content-length", "").isdigit():
        return None
    block = member[start : start + int(head["content-length"])]
    if len(block) < int(head["content-length"]):
        return None
    kind, digest = head.get("warc-type"), head.get("warc-payload-digest", "").rpartition(":")[2] or None
    payload, length = block, None
    if head.get("content-type", "").startswith("application/http"):
        http, body = fields(block)
        payload = block[body:]
        length = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
    if kind == "revisit":
        payload = None
    else:
        digest, length = hashlib.sha256(payload).hexdigest(), len(payload)
    url = head.get("warc-target-uri")
    return page_number(head.get("warc-record-id")), url and unquote(url), kind, page_number(head.get("warc-refers-to")), digest, length, payload


def records_in(window: Window, start: int, end: int) -> Iterator[tuple[int, tuple]]:
    """Position and fields of the records whose members start in [start, end)."""
    at = start
    while at < end:
        window.upto(end + len(MAGIC) - 1)
        found = window.data.find(MAGIC, at - window.start, end + len(MAGIC) - 1 - window.start)
        if found < 0:
            return
        at = found + window.start
        got = member_at(window, at)
        if got is None:
            at += 1
            continue
        row = parsed(got[0])
        if row is not None:
            yield at, row
        at = got[1]


def read_archives(spark: SparkSession, manifest: DataFrame, payloads: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records of the archives that ``manifest`` (path, bytes) names, one row each.

    Digest and length of a response are taken from the bytes read, those of a revisit from its
    headers. Members that are no WARC records or don't decode are passed over, and so are bytes
    between members. Without ``payloads`` that column is NULL. An empty manifest gives no rows.
    """
    ranges = manifest.filter("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start")
    )
    tasks = manifest.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, name = filesystem(row["path"])
                rows, held = [], 0
                with store.open_input_file(name) as file:
                    window = Window(file, row["start"], row["bytes"], split_bytes)
                    for at, found in records_in(window, row["start"], min(row["start"] + split_bytes, row["bytes"])):
                        found = found if payloads else (*found[:6], None)
                        rows.append((*found, row["path"], at))
                        held += len(found[6] or b"")
                        if held > SPLIT_BYTES or len(rows) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD_ARROW)], schema=RECORD_ARROW)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RECORD_ARROW)], schema=RECORD_ARROW)

    return ranges.repartition(int(tasks), "path", "start").mapInArrow(read, RECORD_SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    return read_archives(spark, write_archives(pages, new_dir(spark, "warc")), payloads=False)
