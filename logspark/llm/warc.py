"""WARC archives as seekable Zstandard bundles.

A bundle is one file of independent Zstandard frames, each holding whole records, followed by two skippable frames: a
map from record id to frame and offset inside the frame, and the seek table of the seekable format (sizes of all
frames). Any Zstandard reader can unpack a bundle; a reader with the tables unpacks one frame to get one record.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from logspark.llm.common import saved
from logspark.session import scratch_path

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 8 << 20
REVISIT_BYTES = 100
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the seekable format.
SKIPPABLE, SEEK_SKIPPABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_ENTRY = "<16sIII"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id, digest: str) -> uuid.UUID:
    return uuid.UUID(bytes=hashlib.sha256(f"{page_id}/{digest}".encode()).digest()[:16])


def record(page_id, url: str | None, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    """One WARC record; a revisit (``refers_to`` set) has no payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_id(page_id, digest).urn}>"]
    head += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if revisit:
        head += [f"WARC-Refers-To: <{record_id(refers_to, digest).urn}>", f"X-Refers-To-Page-ID: {refers_to}", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


class Bundle:
    """Collects records into frames; ``finish`` appends the tables."""

    def __init__(self) -> None:
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.places: list[bytes] = []
        self.open: list[bytes] = []
        self.open_bytes = self.bytes = 0

    def add(self, key: uuid.UUID, data: bytes) -> None:
        self.places.append(struct.pack(_ENTRY, key.bytes, len(self.frames), self.open_bytes, len(data)))
        self.open.append(data)
        self.open_bytes += len(data)
        if self.open_bytes >= FRAME_BYTES:
            self.cut()

    def cut(self) -> None:
        if self.open:
            frame = self.packer.compress(b"".join(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), self.open_bytes))
            self.bytes += len(frame)
            self.open, self.open_bytes = [], 0

    def finish(self) -> bytes:
        self.cut()
        places = b"".join(self.places)
        lookup = struct.pack("<II", SKIPPABLE, len(places)) + places
        sizes = [*self.sizes, (len(lookup), 0)]
        table = b"".join(struct.pack("<II", *s) for s in sizes)
        footer = struct.pack("<IBI", len(sizes), 0, SEEKABLE)
        return b"".join([*self.frames, lookup, struct.pack("<II", SEEK_SKIPPABLE, len(table) + 9), table, footer])


def tables(bundle: bytes) -> tuple[list[tuple[int, int]], list[tuple[bytes, int, int, int]]]:
    """(start, length) of each data frame; (record id, frame, offset inside it, length) of each record, in the order of
    writing. Reads the end only. Records that repeat an id each have an entry."""
    count, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE:
        raise ValueError("not a seekable bundle")
    sizes = list(struct.iter_unpack("<II", bundle[-9 - 8 * count : -9]))
    starts, at = [], 0
    for packed, _ in sizes:
        starts.append((at, packed))
        at += packed
    first, length = starts[-1]
    return starts[:-1], list(struct.iter_unpack(_ENTRY, bundle[first + 8 : first + length]))


def read_record(bundle: bytes, key: uuid.UUID) -> bytes | None:
    """One record by its id, the last of those that repeat it: unpacks a single frame."""
    frames, entries = tables(bundle)
    places = {e[0]: e[1:] for e in entries}
    if key.bytes not in places:
        return None
    frame, offset, length = places[key.bytes]
    start, packed = frames[frame]
    return zstandard.ZstdDecompressor().decompress(bundle[start : start + packed])[offset : offset + length]


def records(bundle: bytes) -> Iterator[bytes]:
    """All records, frame by frame, in the order of writing."""
    frames, entries = tables(bundle)
    by_frame: dict[int, list[tuple[int, int]]] = {}
    for _, frame, offset, length in entries:
        by_frame.setdefault(frame, []).append((offset, length))
    unpack = zstandard.ZstdDecompressor()
    for i, (start, packed) in enumerate(frames):
        data = unpack.decompress(bundle[start : start + packed])
        if i in by_frame and len(by_frame[i]) > 0:
            for offset, length in sorted(by_frame[i]):
                yield data[offset : offset + length]


def parse(data: bytes) -> dict:
    """Fields of one record; the payload digest and length of a response are checked against its bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(http.decode().rsplit("Content-Length: ", 1)[1].split("\r\n")[0])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest,
        "record_type": kind, "refers_to": number("X-Refers-To-Page-ID"), "record_id": fields["WARC-Record-ID"][1:-1],
        "payload": payload if kind == "response" else None,
    }


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write a record per page below ``path``, one bundle per file.

    Of records with equal payloads of ``REVISIT_BYTES`` or more, the smallest page id is the response and the others
    revisit it; a null id is never smallest, and where all ids of a payload are null each is a response. Rows that
    repeat id and payload have one record id and the same type. Null html: empty payload. Only digests are grouped.
    """
    own = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("binary"), F.lit("").cast("binary")).alias("payload"),
    )
    own = own.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload").cast("bigint"))
    first = (
        own.where(F.col("bytes") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select(F.col("digest").alias("d"), "first")
    )
    first = saved(first, "warc-first")
    typed = own.join(first, F.col("digest") == F.col("d"), "left").select(
        "page_id",
        "url",
        F.when(F.col("first").isNull() | F.col("first").eqNullSafe(F.col("page_id")), F.col("payload")).alias("payload"),
        "digest",
        "bytes",
        F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"),
    )

    def pack(batches):
        bundle = Bundle()
        for batch in batches:
            for row in zip(*(batch[c] for c in ("page_id", "url", "payload", "digest", "bytes", "refers_to"))):
                page_id, url, payload, digest, size, refers_to = (x.as_py() for x in row)
                bundle.add(record_id(page_id, digest), record(page_id, url, payload or b"", digest, size, refers_to))
                if bundle.bytes >= BUNDLE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([bundle.finish()], pa.binary())], ["bundle"])
                    bundle = Bundle()
        if bundle.places:
            yield pa.RecordBatch.from_arrays([pa.array([bundle.finish()], pa.binary())], ["bundle"])

    bundles = typed.mapInArrow(pack, "bundle binary")
    # The text writer puts a row's bytes and then the separator into a file. A bundle's last byte, the end of the seek
    # table's magic number, is this separator; so each file is exactly one bundle.
    last = struct.pack("<I", SEEKABLE)[-1:]
    cut = F.expr("substring(bundle, 1, octet_length(bundle) - 1)").cast("string").alias("value")
    writer = bundles.select(cut).write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1")
    writer.option("lineSep", last.decode("latin-1")).text(path)


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, record_id, file (and payload)."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"]
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_id string"
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    if payloads:
        names, schema, kinds = [*names, "payload"], schema + ", payload binary", [*kinds, pa.binary()]

    def unpack(batches):
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                rows, size = [], 0
                for data in records(content.as_buffer().to_pybytes()):
                    rows.append(parse(data))
                    size += len(data) if payloads else 200
                    if size > BUNDLE_BYTES:
                        yield emit(rows, file)
                        rows, size = [], 0
                if rows:
                    yield emit(rows, file)

    def emit(rows, file):
        columns = [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([file.as_py()] * len(rows), pa.string())], [*names, "file"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(unpack, schema + ", file string")


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(record_id, record): the raw records named in ``wanted`` (file, record_id), unpacking only their frames."""
    grouped = wanted.groupBy("file").agg(F.collect_set("record_id").alias("ids"))
    files = spark.read.format("binaryFile").load(path).join(grouped, F.col("path") == F.col("file")).select("content", "ids")

    def run(batches):
        for batch in batches:
            for content, ids in zip(batch["content"], batch["ids"]):
                data = content.as_buffer().to_pybytes()
                for key in ids.as_py():
                    found = read_record(data, uuid.UUID(key))
                    if found is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([found], pa.binary())], ["record_id", "record"])

    return files.mapInArrow(run, "record_id string, record binary")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to fresh archives below the shared folder and read them back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
