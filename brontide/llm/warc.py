"""WARC in seekable Zstandard bundles.

Tasks write bundles to the shared folder: records grouped into independent frames, and behind
them a skippable frame with the seek table of Zstandard's seekable format. The index maps each
record to its bundle, frame and offset in the frame; it is written last and only what it names
counts, so files of failed attempts are never read.

Defined results: a null or empty html is an empty payload; of equal payloads of at least
REVISIT_BYTES the largest page_id is the response and the others revisit it; a null page_id is
written as a response without a page id; repeated rows are written each; an empty table gives
bundles and an index without records; control characters in urls are percent-encoded, and a
null url is left out. A frame holds one record at least, so a long page has its own. Input columns
of other names are not read, so none clashes. A very long payload is held whole, one at a time.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brontide.llm.common import new_path, release, text_of, written

REVISIT_BYTES = 1000
#: A frame is closed at so many bytes of records, a bundle at so many of frames.
FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 64 * 1024 * 1024
#: Bytes of records that a reading task gets, and frames of a bundle that it gets together.
TASK_BYTES = 8 * 1024 * 1024
FRAMES_TOGETHER = 4
#: Up to so many digests of repeated payloads are broadcast; else the pages are shuffled by digest.
BROADCAST_DIGESTS = 500_000
#: Fixed values of Zstandard's seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2000-01-01T00:00:00Z"

INDEX = "record_id string, page_id long, bundle string, frame int, offset long, length long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
#: Pages that Python workers get at once.
PAGE_ROWS = 500
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_CONTROL = re.compile("[\x00-\x20\x7f]")


def record_id(page_id: int | None) -> str:
    own = uuid.uuid4() if page_id is None else uuid.uuid5(_NAMESPACE, f"page:{page_id}")
    return f"<urn:uuid:{own}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> tuple[str, bytes]:
    """The id and text of one record. A revisit has the HTTP head only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    own = record_id(page_id)
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {own}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return own, b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _head(raw: memoryview) -> int:
    """Where the head that starts at raw ends; heads are short, so little is copied."""
    size = 1024
    while (at := bytes(raw[:size]).find(b"\r\n\r\n")) < 0:
        if size > len(raw):
            raise ValueError("a head does not end")
        size *= 4
    return at + 4


def parse_record(raw: memoryview) -> dict:
    """The record that starts at raw; end is where the next one does."""
    head_end = _head(raw)
    version, *lines = bytes(raw[: head_end - 4]).decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"not a record: {version[:40]}")
    head = dict(x.split(": ", 1) for x in lines)
    end = head_end + int(head["Content-Length"])
    block = raw[head_end:end]
    http_end = _head(block)
    length = int(re.search(rb"Content-Length: (\d+)", bytes(block[:http_end]))[1])
    payload = bytes(block[http_end:])
    kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{head['WARC-Record-ID']} is damaged")
    number = lambda k: int(head[k]) if k in head else None
    return {
        "page_id": number("X-Page-ID"),
        "url": head.get("WARC-Target-URI"),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("X-Refers-To-Page-ID"),
        "payload": payload,
        "end": end + 4,
    }


class Bundle:
    """A bundle being written."""

    def __init__(self, folder: str):
        from pyarrow import fs

        self.path = f"{folder}/bundle-{uuid.uuid4().hex}.warc.zst"
        system, place = fs.FileSystem.from_uri(self.path)
        self.out = system.open_output_stream(place, compression=None)
        self.frames: list[tuple[int, int]] = []
        self.written = 0

    def add(self, frame: bytes) -> None:
        import zstandard

        packed = zstandard.ZstdCompressor(level=3).compress(frame)
        self.out.write(packed)
        self.frames.append((len(packed), len(frame)))
        self.written += len(packed)

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class Reader:
    """Frames of a finished bundle, read by themselves."""

    def __init__(self, path: str):
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        self.file.seek(size - 9)
        n, _, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        self.file.seek(size - 9 - 8 * n)
        sizes = list(struct.iter_unpack("<II", self.file.read(8 * n)))
        self.frames, at = [], 0
        for packed, full in sizes:
            self.frames.append((at, packed, full))
            at += packed

    def frame(self, k: int) -> bytes:
        import zstandard

        at, packed, full = self.frames[k]
        self.file.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=full)

    def close(self) -> None:
        self.file.close()


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, frame, index, rows, at = None, [], [], [], 0

        def close_frame():
            nonlocal frame, at, index
            bundle.add(b"".join(frame))
            rows.extend((*x[:2], bundle.path, len(bundle.frames) - 1, *x[2:]) for x in index)
            frame, at, index = [], 0, []

        def finished() -> pa.RecordBatch:
            bundle.close()
            names = ("record_id", "page_id", "bundle", "frame", "offset", "length")
            types = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)
            rows.clear()
            return out

        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "html", "digest", "refers_to")), strict=True):
                own, raw = record_bytes(page_id.as_py(), url.as_py(), html.as_py().encode("utf-8"), digest.as_py(), refers_to.as_py())
                if bundle is None:
                    bundle = Bundle(folder)
                if at and at + len(raw) > FRAME_BYTES:
                    close_frame()
                    if bundle.written >= BUNDLE_BYTES:
                        yield finished()
                        bundle = Bundle(folder)
                index.append((own, page_id.as_py(), at, len(raw)))
                frame.append(raw)
                at += len(raw)
        if bundle is not None:
            if frame:
                close_frame()
            yield finished()
        release()

    return write


@dataclass(frozen=True)
class Archive:
    """Where bundles are and the index of their records."""

    folder: str
    index: DataFrame


def write_archive(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> Archive:
    """A record for each row of pages, in bundles in a folder that all machines share."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc", stays=True)
    _folder(folder)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), text_of(html_col).alias("html"))
    rows = rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "n": F.octet_length("html")})
    large = rows.where((F.col("n") >= REVISIT_BYTES) & F.col("page_id").isNotNull())
    same = large.groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("copies")).where("copies > 1").select("digest", "last")
    same = written(same, "payloads")
    joined = rows.join(F.broadcast(same) if same.count() <= BROADCAST_DIGESTS else same, "digest", "left")
    other = F.when((F.col("n") >= REVISIT_BYTES) & (F.col("page_id") != F.col("last")), F.col("last"))
    records = joined.select("page_id", "url", "html", "digest", other.alias("refers_to"))
    return Archive(folder, written(records.mapInArrow(_writer(folder), INDEX), "warc-index", PAGE_ROWS))


def _folder(uri: str) -> None:
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(uri)
    system.create_dir(place, recursive=True)


_FIELDS = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]


def _batch(records: list[dict], payload: bool) -> pa.RecordBatch:
    fields = [*_FIELDS, *([("payload", pa.binary())] if payload else [])]
    return pa.RecordBatch.from_pylist(records, pa.schema(fields))


def _frames(payload: bool):
    """All records of the frames asked for, a frame at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, path = None, None
        for batch in batches:
            for bundle, k in sorted(zip(batch.column("bundle").to_pylist(), batch.column("frame").to_pylist(), strict=True)):
                if bundle != path:
                    if reader:
                        reader.close()
                    reader, path = Reader(bundle), bundle
                raw, at, found = memoryview(reader.frame(k)), 0, []
                while at < len(raw):
                    record = parse_record(raw[at:])
                    at += record.pop("end")
                    found.append(record)
                yield _batch(found, payload)
        if reader:
            reader.close()
        release()

    return read


def read_archive(archive: Archive, payload: bool = True) -> DataFrame:
    """Every record of an archive, its digest checked; frames are dealt over tasks and read by
    themselves. payload=False leaves the payloads behind in the tasks."""
    # Index rows are tiny, but each frame stands for many bytes: tasks are made by the latter.
    frames = archive.index.groupBy("bundle", "frame").agg(F.sum("length").alias("bytes"))
    total = archive.index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // TASK_BYTES))
    dealt = frames.select("bundle", "frame").repartition(tasks, "bundle", F.floor(F.col("frame") / FRAMES_TOGETHER))
    return dealt.mapInArrow(_frames(payload), RECORD + ", payload binary" * payload)


def read_records(archive: Archive, page_ids: DataFrame) -> DataFrame:
    """The records of some pages (a column page_id), by the index and one seek a frame."""
    wanted = archive.index.join(page_ids.select("page_id").distinct(), "page_id", "left_semi")

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                reader = Reader(x["bundle"])
                record = parse_record(memoryview(reader.frame(x["frame"]))[x["offset"] : x["offset"] + x["length"]])
                reader.close()
                record.pop("end")
                yield _batch([record], True)

    return wanted.mapInArrow(seek, RECORD + ", payload binary")


def open_archive(spark: SparkSession, folder: str, index_path: str) -> Archive:
    return Archive(folder, spark.read.schema(INDEX).parquet(index_path))
