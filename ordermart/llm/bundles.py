"""WARC archives as seekable Zstandard bundles.

Each task writes the records of its rows into bundles. A bundle is a file of independent
Zstandard frames, each holding whole records of about ``FRAME_BYTES``, followed by the seek
table of the Zstandard seekable format: a skippable frame with the sizes of every frame and
a footer. A reader takes the table from the end of the file and decompresses only the frames
it needs; any Zstandard tool reads the file as one stream.

The index maps a record's identifier to bundle, frame, and offset and length within the
decompressed frame. Record identifiers follow from the contents, so a task that is run again
writes the same records. Every attempt writes files under names of its own; only the
attempts whose index rows Spark committed count, so what a lost attempt left is never read.

Of records with equal payloads of at least ``REVISIT_BYTES`` the one of the largest id is a
``response``; the others are ``revisit`` records without payload that name it. Payloads move
to the writing task with their row; what decides the record type is a table of the repeated
digests, of which each is one row, so a payload that a third of all pages share is one row
there and adaptive execution splits its pages.

Defined results: a null payload is empty. A null id is below every other; rows that share
the largest id of their payload are all responses. A null URL has no ``WARC-Target-URI``;
control characters of a URL are percent-encoded there, and ``Page-URL`` has it as JSON. An empty table gives no bundles. A record larger than a frame has a
frame of its own; a payload of any length is written whole. Further columns are not
archived, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
from base64 import b32decode, b32encode
from collections.abc import Iterator
from datetime import datetime
from urllib.parse import quote, unquote, urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.session import freeze, scratch_path

REVISIT_BYTES = 1000
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
LEVEL = 3
# Runs of frames that one task reads at least, where there are enough for all cores.
RUNS_PER_TASK = 4
# Repeated digests up to which the table of them is broadcast, 30 bytes each.
BROADCAST_DIGESTS = 1_000_000

# Magic numbers of the Zstandard seekable format, the WARC revisit profile,
# and the HTTP head in front of every payload.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

INDEX = "record_id string, id long, record_type string, bundle string, frame int, offset long, length long"
RECORDS = (
    "record_id string, id long, url string, record_type string, payload_digest string, "
    "refers_to_record string, payload binary, payload_bytes long, digest_read string"
)


def open_store(url: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a shared folder's address (``file:``, ``hdfs:``, ``s3:``, …)."""
    parts = urlsplit(url)
    if parts.scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), unquote(parts.path)
    return pyarrow.fs.FileSystem.from_uri(url)


def record_id(identifier: int | None, url: str | None, digest: str) -> str:
    """Identifier that follows from what the record says."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{identifier}\n{digest}\n{url}')}>"


_CONTROL = re.compile(r"[\x00-\x1f\x7f]")


def warc_record(
    identifier: int | None, url: str | None, payload: bytes, at: datetime, refers_to: tuple | None = None
) -> tuple[str, bytes]:
    """Identifier and bytes of one record; ``refers_to`` makes it a revisit."""
    digest = hashlib.sha1(payload).digest()
    name = record_id(identifier, url, digest.hex())
    head = HTTP_HEAD.format(len(payload)).encode()
    block = head if refers_to else head + payload
    fields = [
        ("WARC-Type", "revisit" if refers_to else "response"),
        ("WARC-Record-ID", name),
        ("WARC-Date", at.strftime("%Y-%m-%dT%H:%M:%SZ")),
        ("WARC-Target-URI", None if url is None else _CONTROL.sub(lambda m: quote(m.group()), url)),
        ("Page-URL", json.dumps(url) if url and _CONTROL.search(url) else None),
        ("WARC-Payload-Digest", f"sha1:{b32encode(digest).decode()}"),
        ("WARC-Profile", PROFILE if refers_to else None),
        ("WARC-Refers-To", refers_to[0] if refers_to else None),
        ("Page-ID", None if identifier is None else str(identifier)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{key}: {value}\r\n" for key, value in fields if value is not None)
    return name, b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def read_record(data: bytes, offset: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Fields and payload of the record at ``offset``, and where the next one begins."""
    end = data.index(b"\r\n\r\n", offset)
    version, *lines = data[offset:end].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no WARC record at {offset}")
    fields = dict(line.split(": ", 1) for line in lines)
    start = end + 4
    stop = start + int(fields["Content-Length"])
    body = data.index(b"\r\n\r\n", start) + 4
    return fields, data[body:stop], stop + 4


class BundleWriter:
    """Writes records into one bundle; ``add`` tells where a record lies."""

    def __init__(self, folder: str, frame_bytes: int = FRAME_BYTES):
        self.store, path = open_store(folder)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.store.create_dir(path, recursive=True)
        # The frames are compressed here, not by the file system.
        self.out = self.store.open_output_stream(f"{path}/{self.name}", compression=None)
        self.limit = frame_bytes
        self.frames: list[tuple[int, int]] = []
        self.open_frame = bytearray()
        self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame, and offset within the decompressed frame."""
        if self.open_frame and len(self.open_frame) + len(record) > self.limit:
            self._end_frame()
        offset = len(self.open_frame)
        self.open_frame += record
        return len(self.frames), offset

    def _end_frame(self) -> None:
        packed = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True).compress(bytes(self.open_frame))
        self.out.write(packed)
        self.frames.append((len(packed), len(self.open_frame)))
        self.written += len(packed)
        self.open_frame = bytearray()

    def close(self) -> None:
        if self.open_frame:
            self._end_frame()
        entries = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()


class BundleReader:
    """Reads single frames of a bundle by its seek table."""

    def __init__(self, path: str):
        store, local = open_store(path)
        self.file = store.open_input_file(local)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        width = 12 if flags & 0x80 else 8
        table = np.frombuffer(self.file.read_at(count * width, size - 9 - count * width), dtype="<u4")
        self.sizes = table.reshape(count, width // 4)[:, :2].astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes[:, 0])))

    def frame(self, number: int) -> bytes:
        packed, size = self.sizes[number]
        data = self.file.read_at(int(packed), int(self.starts[number]))
        return zstandard.ZstdDecompressor().decompress(data, max_output_size=int(size))

    def close(self) -> None:
        self.file.close()


def _write(folder: str, at: datetime, frame_bytes: int, bundle_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, rows = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                identifier, url, payload, target, target_url = (column[row].as_py() for column in batch.columns[:5])
                refers = None
                if batch.column("revisit")[row].as_py():
                    refers = (record_id(target, target_url, hashlib.sha1(payload).hexdigest()),)
                name, record = warc_record(identifier, url, payload, at, refers)
                if writer is None:
                    writer = BundleWriter(folder, frame_bytes)
                frame, offset = writer.add(record)
                kind = "revisit" if refers else "response"
                rows.append((name, identifier, kind, f"{folder}/{writer.name}", frame, offset, len(record)))
                if writer.written >= bundle_bytes:
                    writer.close()
                    yield _index_rows(rows)
                    writer, rows = None, []
        if writer is not None:
            writer.close()
            yield _index_rows(rows)

    return write


def _index_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
    names = [part.split()[0] for part in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def with_record_types(pages: DataFrame) -> DataFrame:
    """``id, url, payload, target, target_url, revisit``: revisits name the response of equal payload.

    The response is the row of the largest id; of several rows with that id, revisits name
    the one of the largest URL.
    """
    large = F.octet_length("payload") >= REVISIT_BYTES
    digest = F.unhex(F.sha1("payload"))
    # Largest id, and of its rows the largest URL, combined before anything is shuffled.
    top = F.struct(F.coalesce(F.col("id"), F.lit(-(2**63))).alias("place"), "id", "url")
    groups = pages.where(large).select(digest.alias("response_digest"), top.alias("top")).groupBy("response_digest")
    named = groups.agg(F.max("top").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1")
    named = freeze(
        named.select("response_digest", F.col("top.id").alias("target"), F.col("top.url").alias("target_url")), "responses"
    )
    if named.count() <= BROADCAST_DIGESTS:
        named = F.broadcast(named)
    # Small payloads match no digest of 20 bytes and are spread over the join's partitions.
    key = F.when(large, digest).otherwise(F.unhex(F.hex(F.xxhash64("id", "url"))))
    joined = pages.withColumn("digest", key).join(named, F.col("digest") == F.col("response_digest"), "left")
    revisit = F.col("response_digest").isNotNull() & ~F.col("id").eqNullSafe(F.col("target"))
    return joined.select("id", "url", "payload", "target", "target_url", revisit.alias("revisit"))


def write_bundles(
    pages: DataFrame, folder: str, at: datetime, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> DataFrame:
    """Archive ``id, url, payload`` in ``folder``; returns the stored index of the records."""
    index = with_record_types(pages).mapInArrow(_write(folder, at, frame_bytes, bundle_bytes), INDEX)
    return freeze(index, "warc-index")


def _parsed(fields: dict[str, str], payload: bytes) -> tuple:
    identifier, url = fields.get("Page-ID"), fields.get("WARC-Target-URI")
    response = fields["WARC-Type"] == "response"
    return (
        fields["WARC-Record-ID"],
        None if identifier is None else int(identifier),
        json.loads(fields["Page-URL"]) if "Page-URL" in fields else url,
        fields["WARC-Type"],
        b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex(),
        fields.get("WARC-Refers-To"),
        payload if response else None,
        len(payload) if response else None,
        hashlib.sha1(payload).hexdigest() if response else None,
    )


def _record_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.binary(), pa.int64(), pa.string()]
    names = [part.split()[0] for part in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _read(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, frames in zip(batch.column("bundle").to_pylist(), batch.column("frames").to_pylist()):
                reader = BundleReader(path)
                for number in sorted(frames):
                    data, offset, rows = reader.frame(number), 0, []
                    while offset < len(data):
                        fields, payload, offset = read_record(data, offset)
                        row = _parsed(fields, payload)
                        rows.append(row if with_payload else (*row[:6], None, *row[7:]))
                    yield _record_rows(rows)
                reader.close()

    return read


def read_bundles(index: DataFrame, with_payload: bool = True, frames_per_task: int = 64) -> DataFrame:
    """All records of the bundles of an index, read from the archives frame by frame.

    A bundle is read by as many tasks as it has runs of ``frames_per_task`` frames. Digest
    and size of a response are worked out from the payload as it was read.
    """
    part = F.floor(F.col("frame") / frames_per_task).alias("part")
    frames = freeze(index.groupBy("bundle", part).agg(F.collect_set("frame").alias("frames")), "warc-frames")
    # Few bytes name many frames: tasks are dealt by the number of runs, not by their size.
    runs, cores = frames.count(), index.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, runs // RUNS_PER_TASK, min(runs, cores))
    return frames.select("bundle", "frames").repartition(tasks).mapInArrow(_read(with_payload), RECORDS)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, places in zip(batch.column("bundle").to_pylist(), batch.column("places").to_pylist()):
            reader, number, data = BundleReader(path), None, b""
            for place in sorted(places, key=lambda p: (p["frame"], p["offset"])):
                if place["frame"] != number:
                    number = place["frame"]
                    data = reader.frame(number)
                fields, payload, _ = read_record(data, place["offset"])
                yield _record_rows([_parsed(fields, payload)])
            reader.close()


def fetch_records(index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records of the given ``record_id``; only the frames that hold them are decompressed."""
    wanted = index.join(record_ids.select("record_id").distinct(), "record_id", "left_semi")
    part = F.floor(F.col("frame") / 64).alias("part")
    places = wanted.groupBy("bundle", part).agg(F.collect_set(F.struct("frame", "offset")).alias("places"))
    return places.select("bundle", "places").mapInArrow(_fetch, RECORDS)


def archived_pages(records: DataFrame) -> DataFrame:
    """``id, url, payload_bytes, payload_digest, record_type, refers_to`` of records as read.

    A revisit has the size and digest of the response it names, as read from there; where
    that response is missing, or its payload has another digest, they are null.
    """
    records = freeze(records.drop("payload"), "warc-records")
    revisits = records.where("record_type = 'revisit'")
    named = revisits.select(F.col("refers_to_record").alias("record_id")).distinct()
    responses = records.where("record_type = 'response'")
    # Rows equal in id, URL and payload have one identifier.
    targets = freeze(
        responses.join(named, "record_id", "left_semi")
        .groupBy(F.col("record_id").alias("refers_to_record"))
        .agg(
            F.max("id").alias("refers_to"),
            F.max("payload_bytes").alias("full_bytes"),
            F.max("digest_read").alias("full_digest"),
        ),
        "revisited",
    )
    own = responses.select(
        "id",
        "url",
        "payload_bytes",
        F.col("digest_read").alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    matching = F.col("full_digest") == F.col("payload_digest")
    resolved = revisits.join(targets, "refers_to_record", "left").select(
        "id",
        "url",
        F.when(matching, F.col("full_bytes")).alias("payload_bytes"),
        F.when(matching, F.col("full_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
    return own.unionByName(resolved)


def archive_and_read(pages: DataFrame, at: datetime = datetime(2026, 1, 1)) -> DataFrame:
    """Write ``pages`` into bundles in the shared folder and return what the archives say."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("id"),
        "url",
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    )
    index = write_bundles(rows, scratch_path(pages.sparkSession, "warc"), at)
    return archived_pages(read_bundles(index, with_payload=False)).withColumnRenamed("id", "page_id").drop("url")
