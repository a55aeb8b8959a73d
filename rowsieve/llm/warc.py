"""WARC archives as seekable zstandard bundles.

Records are grouped into independent zstandard frames of about
``FRAME_BYTES``; frames follow each other in a bundle that ends with a seek
table (a skippable frame with every frame's sizes and the footer's magic
number, as in the public seekable format), so a reader finds a frame from
the end of the bundle and decompresses nothing else.  An index maps a record
to its bundle, frame and offset in the frame.

Records with equal payloads of ``at_least`` bytes are stored once: the one
with the largest id is the ``response``, the others are ``revisit`` records
that name it.  Digests are aggregated first (ids only), and the digests that
repeat are joined back with hot ones dealt over salts, so no group of equal
payloads meets in one task.

Bundles are written as rows (bundle, bytes) by Spark's own writer, which
commits whole tasks only, to any store that Spark writes to; the bytes of a
row are a complete bundle.  Bundles hold ``BUNDLE_BYTES`` at most, or one
record.

Defined cases: null payload is empty; a null url is written as an empty
target; a record without an id is a response that nothing refers to; rows
that repeat the largest id of a payload are all responses; extra columns are
ignored; an empty table gives no bundles and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsieve.llm.tables import save, shared_folder

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 8 << 20
LEVEL = 3
#: WARC-Date where none is given: one date for all, so that the same pages make the same bytes.
DATE = "1970-01-01T00:00:00Z"
#: A payload repeated more often is dealt over SALTS when its response is looked up.
HOT, SALTS = 10_000, 64

# Fixed values of the seekable format: magic numbers of a skippable frame and of the footer.
SKIPPABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1

BUNDLES = "bundle string, bytes binary, records array<struct<id:bigint,frame:int,offset:bigint,length:bigint>>"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, refers_to, date: str = DATE) -> bytes:
    """One WARC/1.1 record.  Its block is an HTTP message: a minimal head, and
    for a response the payload.  A revisit has the head alone, with the length
    and digest of the payload it saves.  Digests are of the payload."""
    kind = "response" if refers_to is None else "revisit"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {'' if url is None else ''.join(c for c in url if c >= ' ')}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])


def parse(raw: bytes) -> dict:
    """Headers of one record, ``http`` (those of its HTTP message) and ``body``, the payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = _fields(head)
    size = int(headers["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    http, _, body = rest[:size].partition(b"\r\n\r\n")
    return headers | {"http": _fields(http), "body": body}


class BundleWriter:
    """Builds one bundle: records into frames, then the seek table."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        import zstandard as z

        self.coder, self.frame_bytes = z.ZstdCompressor(level=LEVEL), frame_bytes
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.current, self.index, self.done = bytearray(), [], 0

    def add(self, page_id, raw: bytes) -> None:
        if self.current and len(self.current) + len(raw) > self.frame_bytes:
            self._close()
        self.index.append({"id": page_id, "frame": len(self.frames), "offset": len(self.current), "length": len(raw)})
        self.current += raw

    def _close(self) -> None:
        frame = self.coder.compress(bytes(self.current))
        self.sizes.append((len(frame), len(self.current)))
        self.frames.append(frame)
        self.done += len(frame)
        self.current = bytearray()

    @property
    def size(self) -> int:
        return self.done + len(self.current)

    def finish(self) -> bytes:
        if self.current:
            self._close()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, FOOTER)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer


class BundleReader:
    """Reads frames of a bundle (bytes, or an open file) by its seek table."""

    def __init__(self, file):
        import io

        self.file = io.BytesIO(file) if isinstance(file, bytes) else file
        end = self.file.seek(0, 2)
        self.file.seek(end - 9)
        n, _, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != FOOTER:
            raise ValueError("no seek table")
        self.file.seek(end - 9 - 8 * n)
        sizes = [struct.unpack("<II", self.file.read(8)) for _ in range(n)]
        self.frames, at = [], 0
        for stored, plain in sizes:
            self.frames.append((at, stored, plain))
            at += stored

    def frame(self, number: int) -> bytes:
        import zstandard as z

        at, stored, plain = self.frames[number]
        self.file.seek(at)
        return z.ZstdDecompressor().decompress(self.file.read(stored), max_output_size=plain)

    def record(self, frame: int, offset: int, length: int) -> dict:
        return parse(self.frame(frame)[offset : offset + length])


def _bundle_batches(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        writer = BundleWriter()
        kind = pa.list_(pa.struct([("id", pa.int64()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))

        def out():
            nonlocal writer, made
            row = pa.RecordBatch.from_arrays(
                [pa.array([f"{task:06d}-{made:06d}"]), pa.array([writer.finish()], pa.binary()), pa.array([writer.index], kind)], names=["bundle", "bytes", "records"]
            )
            writer, made = BundleWriter(), made + 1
            return row

        for batch in batches:
            columns = (batch.column(n) for n in ("id", "url", "payload", "refers_to"))
            for page_id, url, payload, refers_to in zip(*columns):
                raw = record(page_id.as_py(), url.as_py(), (payload.as_py() or "").encode(), refers_to.as_py(), date)
                if writer.index and writer.size + len(raw) > BUNDLE_BYTES:
                    yield out()
                writer.add(page_id.as_py(), raw)
        if writer.index:
            yield out()

    return run


def with_references(pages: DataFrame, folder: str, at_least: int = 0) -> DataFrame:
    """``pages(id, url, payload)`` with ``refers_to``: the response whose
    payload a row repeats, null for responses."""
    payload = F.coalesce("payload", F.lit("")).cast("binary")
    digest = F.when(F.col("id").isNotNull() & (F.octet_length(payload) >= at_least), F.sha1(payload))
    groups = pages.select("id", digest.alias("digest")).where("digest IS NOT NULL").groupBy("digest")
    groups = groups.agg(F.max("id").alias("response"), F.min("id").alias("least"), F.count("*").alias("k")).where("least < response")
    groups = save(groups.select("digest", "response", (F.col("k") > HOT).alias("hot")), folder)
    salted = groups.withColumn("salt", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(-1)))))
    hot = F.broadcast(groups.where("hot").select("digest", "hot"))  # at most 1 / HOT of the rows
    n_hot = groups.where("hot").count()
    rows = pages.withColumn("digest", digest)
    if n_hot:
        hot = hot if n_hot <= 1_000_000 else groups.where("hot").select("digest", "hot")
        rows = rows.join(hot, "digest", "left")
        salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).otherwise(F.lit(-1))
        rows = rows.withColumn("salt", salt).drop("hot")
    else:
        rows = rows.withColumn("salt", F.lit(-1))
    # rows without a digest match nothing: a key of their own spreads them
    key = F.coalesce("digest", F.concat(F.lit("-"), F.xxhash64("url", "payload")))
    looked = salted.select(F.col("digest").alias("key"), "salt", "response")
    joined = rows.withColumn("key", key).join(looked, ["key", "salt"], "left")
    return joined.select("id", "url", "payload", F.when(F.col("response") > F.col("id"), F.col("response")).alias("refers_to"))


def write_bundles(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", at_least: int = 0, date: str = DATE) -> DataFrame:
    """Write a record per row of ``pages`` to bundles below ``path``; returns
    the written bundles: (bundle, bytes, records), ``records`` the index.
    ``date`` is the WARC-Date of all records."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).cast("string").alias("payload")
    )
    return save(with_references(rows, path, at_least).mapInArrow(_bundle_batches(date), BUNDLES), path)


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every record of bundles, found by the seek table and the index, its
    body checked against its digest."""
    number = lambda urn: int(urn[10:-1]) if urn and urn != "<urn:page:>" else None
    for batch in batches:
        for raw, index in zip(batch.column("bytes"), batch.column("records")):
            reader, rows, at, frame = BundleReader(raw.as_py()), [], -1, b""
            for place in index.as_py():
                if place["frame"] != at:
                    at, frame = place["frame"], reader.frame(place["frame"])
                found = parse(frame[place["offset"] : place["offset"] + place["length"]])
                digest = found["WARC-Payload-Digest"].removeprefix("sha1:")
                if found["WARC-Type"] == "response" and payload_digest(found["body"]) != digest:
                    raise ValueError("a payload does not have its digest")
                size = len(found["body"]) if found["WARC-Type"] == "response" else int(found["http"]["Content-Length"])
                rows.append((number(found["WARC-Record-ID"]), size, digest, found["WARC-Type"], number(found.get("WARC-Refers-To"))))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[f.split()[0] for f in _READ.split(", ")])


def read_bundles(bundles: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of
    every record, read back from the bundles."""
    return bundles.select("bytes", "records").mapInArrow(_read_batches, _READ)


def round_trip(pages: DataFrame, at_least: int = 0) -> DataFrame:
    """Write ``pages`` to bundles in the shared folder and read them back."""
    return read_bundles(write_bundles(pages, shared_folder(pages.sparkSession), at_least=at_least))
