"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each with a group of WARC
records, and a last, skippable frame with the seek table (compressed and plain
size of each frame) in the published seekable format. The index maps a record to
bundle, frame, offset within the plain frame, and length, so that one record is
read by decompressing one frame.

Of the records with equal payloads of at least MIN_PAYLOAD bytes that with the
smallest page_id is a response; the others are revisits, which carry the digest
and length but not the payload. Bundles go to the shared folder: a task writes
each under a name of its own and renames it when it is whole, and only what
committed tasks wrote is in the index, so a task that runs again does no harm.

Edge cases: a null html is an empty payload; empty and short payloads are always
responses; rows that repeat page_id and payload are each responses where that
page_id is the smallest; a null page_id is never referred to unless all equal
payloads have it, then each is a response; a null url is left out of the header.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.store import frugal, ids_hint, shared_dir, stored

MIN_PAYLOAD = 100
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
#: Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
#: The tables have no capture time.
WARC_DATE = "1970-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

_INDEX = "page_id long, bundle string, frame int, offset int, length int"


def _header_url(url: str) -> str:
    return url.replace("\r", "%0D").replace("\n", "%0A")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None = None) -> bytes:
    """One WARC record; a revisit if refers_to is given, which names the response's record and URL."""
    body = HTTP_HEAD + payload if refers_to is None else HTTP_HEAD
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + _header_url(url))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Refers-To-Date: {WARC_DATE}", f"X-Refers-To-Page-Id: {refers_to}"]
        if refers_url is not None:
            head.append("WARC-Refers-To-Target-URI: " + _header_url(refers_url))
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    body = rest[: int(headers["Content-Length"])]
    if len(body) != int(headers["Content-Length"]):
        raise ValueError("the record is cut short")
    return headers, body.partition(b"\r\n\r\n")[2]


class BundleWriter:
    """Gathers records into frames and frames into one bundle."""

    def __init__(self, sink):
        self.sink, self.held, self.size, self.table, self.places, self.written = sink, [], 0, [], [], 0
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, page_id: int | None, raw: bytes) -> None:
        self.places.append((page_id, len(self.table), self.size, len(raw)))
        self.held.append(raw)
        self.size += len(raw)
        if self.size >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.held:
            packed = self.compressor.compress(b"".join(self.held))
            self.sink.write(packed)
            self.table.append((len(packed), self.size))
            self.written += len(packed)
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<II", *e) for e in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.sink.close()


class BundleReader:
    """Reads single frames of a bundle by its seek table."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        source.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE_MAGIC or flags:
            raise ValueError("the bundle has no seek table")
        source.seek(end - 9 - 8 * n)
        sizes = list(struct.iter_unpack("<II", source.read(8 * n)))
        self.frames, at = [], 0
        for packed, plain in sizes:
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        at, packed, plain = self.frames[k]
        self.source.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.source.read(packed), max_output_size=plain)


def _storage(place: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(place) if ":" in place else (pyarrow.fs.LocalFileSystem(), place)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to", "refers_url")), strict=True)


def assigned(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, refers_to and refers_url (the response's; null for responses)."""
    rows = frugal(pages).select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    ids = stored(rows.select("page_id", "url", "digest", F.octet_length("payload").alias("size")).where(F.col("size") >= MIN_PAYLOAD), "warc-digests")
    shared = ids.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.min_by("url", F.struct("page_id", "url")).alias("refers_url"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = ids.join(ids_hint(stored(shared, "warc-shared")), "digest").where(F.col("page_id") != F.col("refers_to")).select("page_id", "digest", "refers_to", "refers_url").distinct()
    return rows.join(ids_hint(stored(again, "warc-revisits")), ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "refers_to", "refers_url")


def write(records: DataFrame, folder: str) -> DataFrame:
    """Write the records (as from assigned()) to bundles in `folder`; the stored index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _storage(folder)
        writer, name = None, ""

        def give() -> pa.RecordBatch:
            writer.close()
            files.move(f"{path}/.{name}", f"{path}/{name}")
            ids, frames, offsets, lengths = zip(*writer.places, strict=True)
            return pa.record_batch([pa.array(ids, pa.int64()), pa.array([name] * len(ids)), pa.array(frames, pa.int32()), pa.array(offsets, pa.int32()), pa.array(lengths, pa.int32())], ["page_id", "bundle", "frame", "offset", "length"])

        for page_id, url, payload, digest, refers_to, refers_url in _rows(batches):
            if writer is None:
                files.create_dir(path, recursive=True)
                name = f"{uuid.uuid4().hex}.warc.zst"
                writer = BundleWriter(files.open_output_stream(f"{path}/.{name}", compression=None))
            writer.add(page_id, record(page_id, url, payload, digest, refers_to, refers_url))
            if writer.written >= BUNDLE_BYTES:
                yield give()
                writer = None
        if writer is not None:
            yield give()

    return stored(records.mapInArrow(run, _INDEX), "warc-index")


def read(index: DataFrame, folder: str) -> DataFrame:
    """page_id, payload (null for revisits), payload_bytes, payload_digest, record_type, refers_to of the indexed records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _storage(folder)
        name, reader = None, None
        for batch in batches:
            for bundle, k, places in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "places")), strict=True):
                if bundle != name:
                    name, reader = bundle, BundleReader(files.open_input_file(f"{path}/{bundle}"))
                plain, out = reader.frame(k), []
                for place in places:
                    headers, payload = parse(plain[place["offset"] : place["offset"] + place["length"]])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    size, response = int(headers["X-Payload-Length"]), headers["WARC-Type"] == "response"
                    if response:
                        size, stated, digest = len(payload), digest, hashlib.sha256(payload).hexdigest()
                        if digest != stated:
                            raise ValueError(f"the payload of page {place['page_id']} doesn't have its digest")
                    out.append((place["page_id"], payload if response else None, size, digest, headers["WARC-Type"], int(headers["X-Refers-To-Page-Id"]) if not response else None))
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["page_id", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    # by bundles, of which there are as many as writing tasks at least; the index is too small for its own size to tell
    bundles = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), index.select("bundle").distinct().count())
    frames = index.repartition(bundles, "bundle").groupBy("bundle", "frame").agg(F.collect_list(F.struct("page_id", "offset", "length")).alias("places"))
    return frames.mapInArrow(run, "page_id long, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


def lookup(index: DataFrame, folder: str, page_ids: list[int]) -> DataFrame:
    """The records of the given pages; only their frames are read."""
    return read(index.where(F.col("page_id").isin(page_ids)), folder)


def report(pages: DataFrame) -> DataFrame:
    """Write all pages and read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    return read(write(assigned(pages), folder), folder).drop("payload")


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
