"""WARC records in seekable Zstandard bundles, and random access to them by record identifier."""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.text import texts
from orderflow.sources.workdir import fresh_dir, stored

# Fixed values of the seekable format: skippable frame with the seek table, and the footer's magic number.
SKIPPABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1
INDEX = "record_id string, page_id long, bundle string, frame int, start int, n_bytes int"


class Bundle:
    """A file of independent frames. Records collect until a frame is full; ``close`` appends the seek table."""

    def __init__(self, path: str, frame_bytes: int):
        self.path, self.frame_bytes = path, frame_bytes
        filesystem, name = fs.FileSystem.from_uri(path)
        filesystem.create_dir(name.rpartition("/")[0], recursive=True)
        self.out = filesystem.open_output_stream(name, compression=None)
        self.zstd = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.sizes: list[tuple[int, int]] = []
        self.buffer, self.held, self.written = [], 0, 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame number and offset in the decompressed frame."""
        if self.held and self.held + len(record) > self.frame_bytes:
            self.flush()
        at = len(self.sizes), self.held
        self.buffer.append(record)
        self.held += len(record)
        return at

    def flush(self) -> None:
        if self.held:
            packed = self.zstd.compress(b"".join(self.buffer))
            self.out.write(packed)
            self.sizes.append((len(packed), self.held))
            self.written += len(packed)
            self.buffer, self.held = [], 0

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, FOOTER)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()


class Reader:
    """Frames of a bundle by number; the last one stays decompressed."""

    def __init__(self, path: str):
        filesystem, name = fs.FileSystem.from_uri(path)
        self.file = filesystem.open_input_file(name)
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != FOOTER:
            raise ValueError(f"{path} has no seek table")
        table = np.frombuffer(self.file.read_at(8 * count, size - 9 - 8 * count), "<u4").reshape(-1, 2).astype(np.int64)
        self.packed, self.plain = table[:, 0], table[:, 1]
        self.starts = np.concatenate(([0], np.cumsum(self.packed)))
        self.at, self.frame = -1, b""

    def record(self, frame: int, start: int, n_bytes: int) -> bytes:
        if frame != self.at:
            raw = self.file.read_at(int(self.packed[frame]), int(self.starts[frame]))
            self.frame = zstandard.ZstdDecompressor().decompress(raw, max_output_size=int(self.plain[frame]))
            self.at = frame
        return self.frame[start : start + n_bytes]


def one_line(value) -> str:
    """A header's value: line ends would start another header, so they are blanked."""
    return " ".join(str(value).splitlines())


def record(kind: str, record_id: str, uri: str | None, payload: bytes, digest: str, n_bytes: int, refers_to: str | None, date: str) -> bytes:
    """A WARC record, dated in UTC to the second. A revisit has the HTTP headers of its response, Content-Length included, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    base32 = base64.b32encode(bytes.fromhex(digest)).decode()
    headers = [f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{base32}",
               "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if uri is not None:
        headers.append(f"WARC-Target-URI: {one_line(uri)}")
    if refers_to is not None:
        headers += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {refers_to}"]
    return "\r\n".join(["WARC/1.1", *headers, "", ""]).encode() + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(warc["Content-Length"])].partition(b"\r\n\r\n")
    return warc, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    number = identifier[len("<urn:page:") : -1]
    return None if number == "none" else int(number)


def with_revisits(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """page_id, url, html, digest, n_bytes, refers_to. refers_to is null for responses.

    Payloads are equal if their SHA-256 is; the digest of the records is the SHA-1 that archives use. Digests are aggregated before the join, so a payload that a third of all pages have is one row on one side of
    it, and adaptive execution may split the other.
    """
    body = F.coalesce("html", F.lit("")).cast("binary")
    hashed = pages.select("page_id", "url", "html", F.sha1(body).alias("digest"), F.sha2(body, 256).alias("same"), F.octet_length(body).cast("long").alias("n_bytes"))
    first = (hashed.where(F.col("n_bytes") >= least_bytes).groupBy("same")
             .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return hashed.join(first, "same", "left").select(
        "page_id", "url", "html", "digest", "n_bytes", F.when(other, F.col("first")).alias("refers_to"))


def write(pages: DataFrame, root: str, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 26, date: dt.datetime | None = None) -> DataFrame:
    """Writes every page as a record below ``root`` and returns the stored index, a row per record.

    All records have one date, by default that of this call.
    A task writes its own bundles under names with its attempt, and its index rows reach the index table only if it
    ends well: what a lost or repeated task left is never read.
    """

    stamp = (date or dt.datetime.now(dt.timezone.utc)).astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches) -> Iterator[pa.RecordBatch]:
        bundle, name = None, f"{root}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        part = 0
        for batch in batches:
            ids, urls, digests, sizes, refers = (batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "n_bytes", "refers_to"))
            rows = []
            for page, url, html, digest, size, first in zip(ids, urls, texts(batch.column("html")), digests, sizes, refers):
                if bundle is None:
                    bundle, part = Bundle(f"{name}-{part}.warc.zst", frame_bytes), part + 1
                kind = "response" if first is None else "revisit"
                raw = record(kind, record_id(page), url, html, digest, size, None if first is None else record_id(first), stamp)
                rows.append((record_id(page), page, bundle.path, *bundle.add(raw), len(raw)))
                if bundle.written >= bundle_bytes:
                    bundle.close()
                    bundle = None
            columns = zip(*rows) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, TYPES)], NAMES)
        if bundle is not None:
            bundle.close()

    NAMES = ["record_id", "page_id", "bundle", "frame", "start", "n_bytes"]
    TYPES = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
    return stored(pages.mapInArrow(run, INDEX), "warc-index")


def read(index: DataFrame) -> DataFrame:
    """The records that an index names, or any rows of it: page_id, record_type, payload_bytes, payload_digest, refers_to, payload.

    Each task takes whole frames, finds them by the bundle's seek table and cuts records at their offsets. Bytes and
    digest are of the full payload; for revisits they come from the record's headers, and payload is null.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        reader, path = None, None
        for batch in batches:
            rows = []
            for identifier, bundle, frame, start, n_bytes in zip(*(batch.column(c).to_pylist() for c in ("record_id", "bundle", "frame", "start", "n_bytes"))):
                if bundle != path:
                    reader, path = Reader(bundle), bundle
                warc, http, payload = parsed(reader.record(frame, start, n_bytes))
                if warc["WARC-Record-ID"] != identifier:
                    raise ValueError(f"{path}: {warc['WARC-Record-ID']} where {identifier} should be")
                if warc["WARC-Type"] == "response":
                    rows.append((page_of(identifier), "response", len(payload), hashlib.sha1(payload).hexdigest(), None, payload))
                else:
                    digest = base64.b32decode(warc["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    rows.append((page_of(identifier), "revisit", int(http["Content-Length"]), digest, page_of(warc["WARC-Refers-To"]), None))
            columns = zip(*rows) if rows else [[]] * 6
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
            names = ["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    dealt = index.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "start")
    return dealt.mapInArrow(run, "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def archive(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) to bundles in the shared folder and returns their index.

    Equal payloads of at least ``least_bytes`` bytes: the one with the largest page_id is a response, the others
    revisit it. Null html is an empty payload; a null url gives no target header; a null page_id is less than any
    other, and rows that repeat the largest page_id of their payload are all responses. No pages: an empty index.
    """
    return write(with_revisits(pages, least_bytes), fresh_dir(pages.sparkSession, "warc"))
