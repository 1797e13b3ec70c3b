"""Zstandard WARC archives: a writer with revisit records and a validating reader.

An archive starts with a skippable frame that holds the dictionary; every
record is one frame after it.  The reader loads that dictionary, decodes frame
by frame in bounded memory, and checks header lines, block lengths, and the
payload digests and lengths that a record states; an invalid archive is an
``Invalid`` error.

Records of other writers and types are read too.  The payload of a ``response``
or ``revisit`` with HTTP content is what follows its HTTP headers, and its length
the stated one or, without that, the payload's own; a length that a transfer or
content encoding makes another matter is not held against it.  Every other
record's payload is its block.  Digests by another hash than SHA-1 are kept and
not checked; a missing one is computed.  Header lines may be folded; headers that
are no UTF-8 are ``Invalid``.  ``id`` and ``refers_to`` are NULL for record ids that
this writer did not make; ``record_id`` is the id as it stands.

Tasks write archives to the shared folder under names of their own attempt and
return them as manifest rows; only manifest rows are read, so a lost task's
files are never read twice.

Of records with equal payloads of at least ``min_bytes``, the one with the
smallest id is the response and the others revisit it; a revisit keeps the HTTP
headers, and so the payload's length, but no payload.  A NULL payload is empty;
a NULL URL is an empty target; rows with a NULL id, and rows that repeat the
smallest id, stay responses when no smaller id has their payload; an empty
table writes no archive.  Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetops.llm.common import whole
from assetops.storage import cut, run_folder

DICT_SAMPLES, DICT_SAMPLE_CHARS, DICT_BYTES = 400, 4096, 32 << 10  # bound what the dictionary is trained on
ARCHIVE_BYTES = 32 << 20  # an archive ends with the record that passes this
LEVEL = 3
DATE = "2020-01-01T00:00:00Z"  # records carry no wall clock
SKIPPABLE, FRAME = 0x184D2A5D, 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
_RECORDS = pa.schema(
    [
        ("id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
        ("record_id", pa.string()),
    ]
)
_RECORDS_SQL = (
    "id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary, "
    "record_id string"
)


def train(payloads: DataFrame) -> bytes:
    """A dictionary from a bounded sample; empty where that is too small."""
    sample = payloads.where("payload != ''").select(F.substring("payload", 1, DICT_SAMPLE_CHARS)).limit(DICT_SAMPLES)
    texts = [row[0].encode() for row in sample.collect()]
    if len(texts) < 20:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b""


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(record: int | None) -> str:
    return f"<urn:page:{'none' if record is None else record}>"


def record_bytes(record: int | None, url: str, payload: bytes, first: int | None, revisit: bool) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {urn(record)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}",
        f"WARC-Payload-Digest: sha1:{digest32(payload)}",
        f"WARC-Block-Digest: sha1:{digest32(block)}",
        *([f"WARC-Refers-To: {urn(first)}", f"WARC-Profile: {PROFILE}"] if revisit else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _writer(folder: str, dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        attempt, number, out, records, size = uuid.uuid4().hex, 0, None, 0, 0

        def ended() -> pa.RecordBatch:
            out.close()
            row = [[f"{folder}/{attempt}-{number}.warc.zst"], [records], [size]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, _MANIFEST)], schema=_MANIFEST)

        for batch in batches:
            for i in range(batch.num_rows):
                record, url, payload, first, revisit = (c[i].as_py() for c in batch.columns)
                frame = compressor.compress(record_bytes(record, url, payload.encode(), first, revisit))
                if out is None:
                    out = system.open_output_stream(f"{base}/{attempt}-{number}.warc.zst", compression=None)
                    records = size = 0
                    if dictionary:
                        out.write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
                out.write(frame)
                records, size = records + 1, size + len(frame)
                if size >= ARCHIVE_BYTES:
                    yield ended()
                    out, number = None, number + 1
        if out is not None:
            yield ended()

    return run


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Writes the archives below ``folder`` and returns their manifest.  Archives
    are written and read through Arrow's file systems (local, HDFS, S3, GCS, Azure);
    a folder that they do not know is an error before any task runs."""
    fs.FileSystem.from_uri(folder)
    payload = whole(F.col(payload_col))
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("id"),
        whole(F.col(url_col)).alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
    )
    dictionary = train(rows)
    # Copies, however many, meet only as partial minima.  Written out, so that
    # the join reads two plain exchanges and a hot payload's side is split.
    firsts = cut(
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
    )
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    placed = rows.join(firsts, "digest", "left").select("id", "url", "payload", "first", revisit.alias("revisit"))
    return cut(placed.mapInArrow(_writer(folder, dictionary), "archive string, records bigint, bytes bigint"))


class Invalid(ValueError):
    """An archive that breaks the format."""


def frames(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of one archive: one frame each, after the dictionary's."""
    head = stream.read(8)
    if not head:
        return
    dictionary, left = None, head
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == SKIPPABLE:
        size = struct.unpack("<I", head[4:])[0]
        content = stream.read(size)
        if len(content) != size:
            raise Invalid("the dictionary is cut off")
        if content[:4] == struct.pack("<I", FRAME):
            content = zstandard.ZstdDecompressor().decompress(content)
        dictionary, left = zstandard.ZstdCompressionDict(content), b""
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while True:
        left = left or stream.read(chunk)
        if not left:
            return
        frame, parts = decompressor.decompressobj(), []
        try:
            while not frame.eof:
                if not left:
                    left = stream.read(chunk)
                    if not left:
                        raise Invalid("the last record is cut off")
                parts.append(frame.decompress(left))
                left = frame.unused_data if frame.eof else b""
        except zstandard.ZstdError as error:
            raise Invalid(f"not a Zstandard frame: {error}") from error
        yield b"".join(parts)


def _headers(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    name = None
    for line in lines:
        if line[:1] in (b" ", b"\t") and name is not None:  # folded
            out[name] += " " + _text(line)
            continue
        key, colon, value = line.partition(b":")
        if not colon:
            raise Invalid(f"not a header: {line[:80]!r}")
        name = _text(key).lower()
        out[name] = _text(value)
    return out


def _text(raw: bytes) -> str:
    try:
        return raw.strip().decode()
    except UnicodeDecodeError as error:
        raise Invalid(f"a header is no UTF-8: {raw[:80]!r}") from error


def _checked(stated: str | None, content: bytes, what: str) -> str:
    """The digest of ``content``: the stated one, if it is a SHA-1 it must fit."""
    if stated is None:
        return digest32(content)
    name, _, value = stated.partition(":")
    if name.lower() != "sha1":
        return stated
    if value.upper() != digest32(content):
        raise Invalid(f"the {what} digest does not fit")
    return value.upper()


def _http(block: bytes) -> tuple[bytes, int | None]:
    """(payload, its stated length) of an HTTP message."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        raise Invalid("the HTTP headers do not end")
    first, *lines = head.split(b"\r\n")
    if not first.startswith(b"HTTP/"):
        raise Invalid(f"not an HTTP message: {first[:40]!r}")
    # Servers send header lines that are none, and letters that are no UTF-8.
    named = {n.strip().lower(): v.strip() for n, c, v in (line.partition(b":") for line in lines) if c}
    length = named.get(b"content-length", b"")
    encoded = b"transfer-encoding" in named or b"content-encoding" in named
    return payload, int(length) if length.isdigit() and not encoded else None


def parse(record: bytes) -> dict:
    """One record, with headers, lengths and digests checked."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not gap or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise Invalid(f"not a WARC record: {record[:40]!r}")
    h = _headers(lines)
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - set(h)
    if missing or not h["content-length"].isdigit():
        raise Invalid(f"headers missing or malformed: {sorted(missing)}")
    size = int(h["content-length"])
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise Invalid("Content-Length does not fit the block")
    _checked(h.get("warc-block-digest"), block, "block")
    kind, stated = h["warc-type"], h.get("warc-payload-digest")
    http = kind in ("response", "revisit") and h.get("content-type", "").startswith("application/http")
    payload, length = _http(block) if http and block else (block, None)
    if kind == "revisit":
        if payload or "warc-refers-to" not in h:
            raise Invalid("a revisit has no payload and refers to a record")
        full, digest = length, stated and stated.partition(":")[2] if (stated or "").lower().startswith("sha1:") else stated
    else:
        if kind == "response" and length is not None and length != len(payload):
            raise Invalid("the payload's length does not fit")
        full, digest = len(payload), _checked(stated, payload, "payload")

    def number(name: str) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+|none)>", h[name]) if name in h else None
        return int(found[1]) if found and found[1] != "none" else None

    return {
        "id": number("warc-record-id"),
        "url": h.get("warc-target-uri", ""),
        "payload_bytes": full,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("warc-refers-to"),
        "payload": None if kind == "revisit" else payload,
        "record_id": h["warc-record-id"],
    }


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of every archive in the manifest (archive, records); ``records``
    is NULL for archives whose number of records is not known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, path = fs.FileSystem.from_uri(archive)
                rows, size, count = [], 0, 0
                with system.open_input_stream(path, compression=None) as stream:
                    for record in frames(stream):
                        row = parse(record)
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        count, size = count + 1, size + len(record)
                        if size > 8 << 20 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RECORDS)
                if expected is not None and count != expected:
                    raise Invalid(f"{archive}: {count} records, {expected} were written")

    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("archive", "records").repartition(parts, "archive").mapInArrow(run, _RECORDS_SQL)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes ``pages`` and reads the archives back, one row per page."""
    records = read(write(pages, run_folder(spark, "warc")), payloads=False)
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
