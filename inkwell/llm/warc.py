"""WARC archives: one gzip member per record, written and read back in splits.

Writer. Each task writes archive files of its own below a new folder; the table of files
that Spark commits names those of successful attempts only, so a repeated task leaves at
most an unlisted file. Of rows with equal payloads the first (smallest page_id, null last)
is a `response` that holds the payload, the others are `revisit` records with its digest
and length that refer to it; payloads below a size limit are always responses.

Reader. A task gets a byte range of a file. It looks for the gzip magic, decodes the member
there and takes it for a record if it starts with a WARC version, its header parses, its
block has the announced length, and the file ends or another member follows. A record
belongs to the range in which it starts; it may end beyond it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, functions as F

from inkwell.llm.common import small_batches, work_path, written

MAGIC = b"\x1f\x8b\x08"
FILE_BYTES = 1 << 30
SPLIT_BYTES = 64 << 20
CHUNK = 1 << 18
MIN_PAYLOAD = 0
LAST = 2**63 - 1
RECORD = "path string, start long, record_type string, record_id string, page_id long, uri string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, row: int) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{row}').urn}>"


def _clean(value: str) -> str:
    """Header values are one line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(kind: str, page_id: int | None, row: int, uri: str | None, payload: bytes, digest: str, first: tuple[int | None, int], date: str) -> bytes:
    """An uncompressed record; a revisit carries the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id, row)}", f"WARC-Date: {date}"]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_clean(uri)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(*first)}"]
        if first[0] is not None:
            lines.append(f"X-Refers-To-Page-Id: {first[0]}")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_first(pages: DataFrame, least_bytes: int = MIN_PAYLOAD) -> DataFrame:
    """page_id, url, payload, row, and the page_id and row of the first row with an equal payload.

    Only digests are grouped, combined before the shuffle; the payload joins by digest. The
    rows are written with their numbers first, so that later jobs cannot number them anew.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"), F.monotonically_increasing_id().alias("row"),
    )
    rows = written(rows.withColumn("digest", F.sha1("payload")), "warc-rows")
    order = F.struct(F.coalesce("page_id", F.lit(LAST)).alias("at"), F.col("page_id").isNull().alias("no_id"), "row")
    first = written(rows.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"), "warc-first")
    out = rows.join(first, "digest", "left")
    large = F.octet_length("payload") >= least_bytes
    own = F.col("first").isNull() | ~large
    return out.select(
        "page_id", "url", "payload", "row",
        F.when(own, F.col("page_id")).when(~F.col("first.no_id"), F.col("first.at")).alias("first_page"),
        F.when(own, F.col("row")).otherwise(F.col("first.row")).alias("first_row"),
    )


def write_archives(pages: DataFrame, folder: str, least_bytes: int = MIN_PAYLOAD, file_bytes: int = FILE_BYTES, level: int = 1) -> DataFrame:
    """Write the records below ``folder``; a written table (path, bytes, records) of the files."""
    small_batches(pages.sparkSession)
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        out, name, size, records = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.record_batch([pa.array([f"{folder}/{name}"]), pa.array([size], pa.int64()), pa.array([records], pa.int64())], ["path", "bytes", "records"])

        for batch in batches:
            for page_id, url, payload, row, first_page, first_row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    store.create_dir(base, recursive=True)
                    name, size, records = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                kind = "response" if row == first_row else "revisit"
                data = record_bytes(kind, page_id, row, url, payload, base32_sha1(payload), (first_page, first_row), date)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = packer.compress(data) + packer.flush()
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= file_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return written(with_first(pages, least_bytes).mapInArrow(write, "path string, bytes long, records long"), "warc-files")


def _decode(f, size: int, at: int) -> tuple[bytes, int] | None:
    """The member that starts at ``at`` and where it ends; None if there is no complete one."""
    unpack = zlib.decompressobj(31)
    parts, pos = [], at
    f.seek(at)
    try:
        while not unpack.eof:
            chunk = f.read(CHUNK)
            if not chunk:
                return None
            pos += len(chunk)
            parts.append(unpack.decompress(chunk))
            if sum(map(len, parts[:2])) >= 5 and not b"".join(parts[:2]).startswith(b"WARC/"):
                return None
    except zlib.error:
        return None
    return b"".join(parts), pos - len(unpack.unused_data)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header fields (lower-case names) and block of a whole record, or None."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not re.fullmatch(r"WARC/\d+\.\d+", lines[0]):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = fields.get("content-length", "")
    if not length.isdigit() or rest[int(length) :] != b"\r\n\r\n":
        return None
    return fields, rest[: int(length)]


def records_in(f, size: int, low: int, high: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(start, fields, block) of the records that start in [low, high)."""
    pos, trusted = low, low == 0
    while pos < high:
        f.seek(pos)
        window = f.read(min(CHUNK, high - pos) + len(MAGIC) - 1)
        found = window.find(MAGIC)
        if found < 0:
            pos, trusted = pos + max(1, len(window) - len(MAGIC) + 1), False
            continue
        pos, trusted = pos + found, trusted and not found
        member = _decode(f, size, pos)
        record = member and parse_record(member[0])
        if record and not trusted and member[1] < size:
            f.seek(member[1])
            record = record if f.read(len(MAGIC)) == MAGIC else None
        if not record:
            pos, trusted = pos + 1, False
            continue
        yield pos, *record
        pos, trusted = member[1], True


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row per record of the files (path, bytes); the payload is null for revisits.

    A response whose payload does not have the announced digest is an error. Fields that a
    record lacks are null; records that are no HTTP exchange keep their block as payload.
    """
    small_batches(files.sparkSession)
    total = files.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / split_bytes)), F.lit(0))).first()[0]
    splits = files.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("low"))
    splits = splits.repartition(min(max(1, total), 100_000))
    names = [x.split(" ")[0] for x in RECORD.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def number(x: str | None) -> int | None:
        return int(x) if x and re.fullmatch(r"-?\d+", x) else None

    def rows(path: str, size: int, low: int) -> Iterator[tuple]:
        store, name = pafs.FileSystem.from_uri(path)
        with store.open_input_file(name) as f:
            for start, fields, block in records_in(f, size, low, min(size, low + split_bytes)):
                http, gap, payload = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
                digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                kind = fields.get("warc-type")
                length = len(payload)
                if kind == "revisit":
                    m = re.search(rb"(?im)^Content-Length:\s*(\d+)", http)
                    length, payload = (int(m[1]) if m else None), None
                elif digest and base32_sha1(payload) != digest:
                    raise ValueError(f"payload digest differs in {path} at {start}")
                yield (path, start, kind, fields.get("warc-record-id"), number(fields.get("x-page-id")), fields.get("warc-target-uri"), number(fields.get("x-refers-to-page-id")), length, digest, payload)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for split in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for row in rows(*split):
                    held.append(row)
                    n += len(row[-1] or b"")
                    if len(held) >= 1000 or n > 16 << 20:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)
                        held, n = [], 0
        if held:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)

    return splits.mapInArrow(read, RECORD)


def warc_query(pages: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each page, as read back.

    A null html is an empty payload. Of rows repeated with one page_id the first in the table
    is the response. A null page_id comes last among equal payloads; revisits of such a row
    refer to null.
    """
    files = write_archives(pages, work_path(pages.sparkSession, "warc"))
    out = read_archives(files, split_bytes)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
