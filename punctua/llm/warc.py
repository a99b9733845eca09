"""WARC archives as seekable Zstandard bundles, written and read back by tasks."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from punctua.llm.common import Workspace, frames_of

# Fixed values of the seekable format: skippable frame, footer and its size.
SKIPPABLE, FOOTER, FOOTER_SIZE = 0x184D2A5E, 0x8F92EAB1, 9
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "record_id string, page_id bigint, bundle string, frame int, at bigint, size bigint"
READ = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
        "record_id string, url string, payload binary")


def base32_sha1(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(urn: str | None):
    number = (urn or "")[len("<urn:x-page:"):-1]
    return int(number) if number else None


def record(page_id, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """One record: a response with its payload, or a revisit that names the response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c >= " " else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """(headers, block, position after it) of the record at ``at``; its lengths must hold."""
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record at {at}")
    head = dict(x.split(": ", 1) for x in lines[1:])
    stop = end + 4 + int(head["Content-Length"])
    if raw[stop:stop + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} has a wrong length")
    return head, raw[end + 4:stop], stop + 4


class Bundle:
    """A bundle being written: records gather into frames of about ``frame_bytes`` each."""

    def __init__(self, frame_bytes: int, level: int):
        import zstandard

        self.press, self.most = zstandard.ZstdCompressor(level=level, write_content_size=True), frame_bytes
        self.out, self.held, self.frames, self.size = [], bytearray(), [], 0

    def add(self, raw: bytes) -> tuple[int, int]:
        """(frame, place in the frame's plain bytes) where the record will be found."""
        if self.held and len(self.held) + len(raw) > self.most:
            self.close_frame()
        where = len(self.frames), len(self.held)
        self.held += raw
        return where

    def close_frame(self) -> None:
        if self.held:
            packed = self.press.compress(bytes(self.held))
            self.out.append(packed)
            self.frames.append((len(packed), len(self.held)))
            self.size += len(packed)
            self.held = bytearray()

    def finish(self) -> bytes:
        self.close_frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, FOOTER)
        return b"".join(self.out) + struct.pack("<II", SKIPPABLE, len(table)) + table


def seek_table(file) -> list[tuple[int, int, int]]:
    """(position, packed size, plain size) of every frame, from the footer."""
    size = file.size()
    file.seek(size - FOOTER_SIZE)
    n, _, magic = struct.unpack("<IBI", file.read(FOOTER_SIZE))
    if magic != FOOTER:
        raise ValueError("no seek table")
    file.seek(size - FOOTER_SIZE - 8 * n)
    raw, out, at = file.read(8 * n), [], 0
    for packed, plain in struct.iter_unpack("<II", raw):
        out.append((at, packed, plain))
        at += packed
    return out


def read_record(path: str, frame: int, at: int) -> tuple[dict, bytes]:
    """(headers, block) of one record: reads the seek table and that frame only."""
    import zstandard

    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_file(name) as file:
        begin, packed, plain = seek_table(file)[frame]
        file.seek(begin)
        return parse(zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain), at)[:2]


def _write(base: str, frame_bytes: int, bundle_bytes: int, level: int, date: str):
    def run(batches):
        store, root = fs.FileSystem.from_uri(base)
        store.create_dir(root, recursive=True)

        def flush(bundle, rows):
            # A name of its own for every attempt: a lost or repeated task leaves a file no index row names.
            name = f"bundle-{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(bundle.finish())
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([
                pa.array(cols[0]), pa.array(cols[1], pa.int64()), pa.array([f"{base}/{name}"] * len(rows)),
                pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                names=["record_id", "page_id", "bundle", "frame", "at", "size"])

        bundle, rows = Bundle(frame_bytes, level), []
        for b in frames_of(batches):
            for page, url, html, first in zip(*(b.column(i).to_pylist() for i in range(4))):
                raw = record(page, url, (html or "").encode("utf-8", "surrogatepass"), None if first == page else first, date)
                rows.append((record_id(page), page, *bundle.add(raw), len(raw)))
                if bundle.size + len(bundle.held) >= bundle_bytes:
                    yield flush(bundle, rows)
                    bundle, rows = Bundle(frame_bytes, level), []
        if rows:
            yield flush(bundle, rows)
    return run


def write_bundles(
    pages: DataFrame, work: Workspace, frame_bytes: int = 256 << 10, bundle_bytes: int = 32 << 20, level: int = 3,
    date: str = "2020-01-01T00:00:00Z", id_col: str = "page_id", url: str = "url", payload: str = "html",
) -> DataFrame:
    """Writes every page as a record; returns the index ``(record_id, page_id, bundle, frame, at, size)``.

    Of pages with equal payloads (by SHA-1) the one of the largest id is the response and
    the others revisit it.  Only digests and ids are shuffled for that; payloads meet just
    the digests that occur more than once.  Every task writes bundles of its own below the
    workspace and the stored index commits them.

    Defined cases: null payloads are empty ones and count as equal; a null url leaves its
    header out; a null page id has an empty record number, is a response, and is never
    referred to; rows sharing id and payload are all responses; no pages, no bundles.
    """
    src = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("html")).withColumn("digest", F.sha1("html"))
    again = src.groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("first")).where("n > 1")
    again = work.store(again.select("digest", "first"), "again")
    first = F.when(F.col("page_id").isNotNull(), F.coalesce("first", "page_id"))
    rows = src.join(again, "digest", "left").select("page_id", "url", "html", first.alias("first"))
    return work.store(rows.mapInArrow(_write(work.path("bundles"), frame_bytes, bundle_bytes, level, date), INDEX), "index")


def _read(keep: bool):
    def run(batches):
        import zstandard

        open_ = zstandard.ZstdDecompressor()
        for b in batches:
            for path in b.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as file:
                    for begin, packed, plain in seek_table(file):
                        file.seek(begin)
                        raw = open_.decompress(file.read(packed), max_output_size=plain)
                        yield _rows(raw, keep)
    return run


def _rows(raw: bytes, keep: bool) -> pa.RecordBatch:
    at, rows = 0, []
    while at < len(raw):
        head, block, at = parse(raw, at)
        http, _, body = block.partition(b"\r\n\r\n")
        size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == "response" and (len(body) != size or base32_sha1(body) != digest):
            raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
        rows.append((page_of(head["WARC-Record-ID"]), size, digest, head["WARC-Type"], page_of(head.get("WARC-Refers-To")),
                     head["WARC-Record-ID"], head.get("WARC-Target-URI"), body if keep and head["WARC-Type"] == "response" else None))
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[c.split()[0] for c in READ.split(", ")])


def read_bundles(index: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the bundles an index names, frame by frame; checks each payload's digest."""
    n = index.sparkSession.sparkContext.defaultParallelism
    return index.select("bundle").distinct().repartition(max(n, 1)).mapInArrow(_read(payloads), READ)
