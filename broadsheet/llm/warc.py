"""WARC archives as seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each holding whole WARC records, closed by a seek table in a skippable
frame (the public seekable format). The manifest maps every record to its bundle, frame and offset inside the frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import fold, fresh_path, salted, slices, small_batches, stage, unfold

#: Fixed values of the formats.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "record_id string, page_id string, bundle string, frame int, frame_start bigint, offset bigint, length bigint"
RECORDS = "record_id string, page_id string, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to string, payload binary"


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: str) -> str:
    return f"<urn:page:{page_id}>"


# ---------------------------------------------------------------- bundles


class BundleWriter:
    """Packs records into frames of about `frame_bytes`; one larger record has a frame of its own."""

    def __init__(self, uri: str, frame_bytes: int = 1 << 20, level: int = 3):
        self.uri, self.frame_bytes = uri, frame_bytes
        fs, path = _open(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = fs.open_output_stream(path, compression=None)
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.sizes: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.size = self.at = 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        """(frame, start of the frame in the file, offset in the frame)."""
        if self.size and self.size + len(record) > self.frame_bytes:
            self._flush()
        place = len(self.sizes), self.at, self.size
        self.held.append(record)
        self.size += len(record)
        return place

    def _flush(self) -> None:
        if self.size:
            frame = self.zstd.compress(b"".join(self.held))
            self.out.write(frame)
            self.sizes.append((len(frame), self.size))
            self.at += len(frame)
            self.held, self.size = [], 0

    def close(self) -> None:
        self._flush()
        body = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()


class BundleReader:
    """Random access to the frames of a bundle by its seek table."""

    def __init__(self, uri: str):
        fs, path = _open(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE or flags & 0x80:
            raise ValueError(f"{uri} has no seek table")
        table = self.file.read_at(8 * count, size - 9 - 8 * count)
        self.frames, at = [], 0
        for packed, plain in struct.iter_unpack("<II", table):
            self.frames.append((at, packed, plain))
            at += packed
        self.zstd = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.frames[number]
        out = self.zstd.decompress(self.file.read_at(packed, at), max_output_size=plain)
        if len(out) != plain:
            raise ValueError("a frame's size differs from the seek table")
        return out

    def close(self) -> None:
        self.file.close()


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes):
    """(headers by lower-case name, block) of each record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a WARC record")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        size = int(headers["content-length"])
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


# ---------------------------------------------------------------- archive and read back


def _digested(pages: DataFrame, id_col: str, url_col: str | None, payload_col: str, wide: bool) -> DataFrame:
    """(_id, digest, size), and url and payload if wide."""
    small_batches(pages.sparkSession)
    url = pages[url_col].cast("string") if url_col else F.lit(None).cast("string")
    cols = [pages[id_col].alias("_id"), pages[payload_col].cast("string").alias("_p"), *([url.alias("_url")] if wide else [])]

    def run(batches):
        for b in slices(batches):
            raw = pc.fill_null(b.column(1), "").cast(pa.binary())
            out = [b.column(0), pa.array([hashlib.sha1(x.as_py()).digest() for x in raw], pa.binary()), pc.binary_length(raw).cast(pa.int64())]
            yield pa.RecordBatch.from_arrays(out + ([b.column(2), raw] if wide else []), names=["_id", "digest", "size"] + ["_url", "_payload"] * wide)

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(*cols).mapInArrow(run, f"_id {kind}, digest binary, size bigint" + ", _url string, _payload binary" * wide)


def archive(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str | None = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    frame_bytes: int = 1 << 20,
    bundle_bytes: int = 1 << 30,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row of pages and return the manifest (MANIFEST), staged.

    Of payloads of at least `min_bytes` that are equal, the row with the largest id is a response and the others revisit
    it; rows that repeat that id with that payload are responses too. Null payloads are empty; null ids are smallest and
    written as ''. Every task attempt writes bundles of its own name, and only those of attempts that succeed are in the
    manifest. Groups of copies are salted. An empty table gives an empty manifest. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")
    narrow = salted(_digested(pages, id_col, url_col, payload_col, False), F.col("_id"))
    groups = fold(narrow, ["digest"], {"_keep": F.max("_id")}, {"_keep": F.max("_keep")})
    wide = unfold(salted(_digested(pages, id_col, url_col, payload_col, True), F.col("_id")), groups, ["digest"])
    first = (F.col("size") < min_bytes) | F.col("_id").eqNullSafe(F.col("_keep"))
    rows = wide.select(
        F.coalesce(F.col("_id").cast("string"), F.lit("")).alias("page_id"),
        F.when(~first, F.coalesce(F.col("_keep").cast("string"), F.lit(""))).alias("refers_to"),
        "_url",
        "digest",
        F.when(first, F.col("_payload")).alias("payload"),
        "size",
    )

    def write(batches):
        task = TaskContext.get()
        lead = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        out, number = None, 0
        for b in slices(batches):
            found = []
            for r in b.to_pylist():
                if out is None:
                    out = BundleWriter(f"{lead}-{number:04d}.warc.zst", frame_bytes)
                    info = b"software: broadsheet\r\nformat: WARC File Format 1.1\r\n"
                    out.add(record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], info))
                name = _record_id(r["page_id"])
                headers = [("WARC-Record-ID", name), ("WARC-Date", date), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(r["digest"]).decode()), ("Content-Type", "application/http; msgtype=response")]
                if r["_url"] is not None:
                    headers.append(("WARC-Target-URI", r["_url"].replace("\r", "%0D").replace("\n", "%0A")))
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['size']}\r\n\r\n".encode()
                if r["refers_to"] is None:
                    data = record("response", headers, http + r["payload"])
                else:
                    headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(r["refers_to"]))]
                    data = record("revisit", headers, http)
                frame, start, offset = out.add(data)
                found.append((name, r["page_id"], out.uri, frame, start, offset, len(data)))
                if out.at + out.size > bundle_bytes:
                    out.close()
                    out, number = None, number + 1
            if found:
                types = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), types, strict=True)], names=[x.split()[0] for x in MANIFEST.split(", ")])
        if out is not None:
            out.close()

    return stage(rows.mapInArrow(write, MANIFEST), "warc-manifest")


def read_back(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the archives in the manifest (RECORDS), frame by frame through the seek tables.

    Digests of responses are computed from the payload read, and compared with the header. A revisit has no payload; its
    payload_bytes are those of the original, from the HTTP headers that it repeats.
    """
    names = [x.split()[0] for x in RECORDS.split(", ")]
    frames = manifest.select("bundle", "frame").distinct()

    def read(batches):
        reader, uri = None, None
        for b in batches:
            for bundle, number in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if bundle != uri:
                    if reader:
                        reader.close()
                    reader, uri = BundleReader(bundle), bundle
                cols = [[] for _ in names]
                for h, block in parse(reader.frame(number)):
                    if h["warc-type"] == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    digest = h["warc-payload-digest"].removeprefix("sha1:")
                    whole = h["warc-type"] == "response"
                    if whole and (len(payload) != size or _digest(payload) != digest):
                        raise ValueError(f"{h['warc-record-id']} is damaged")
                    page = lambda x: x[len("<urn:page:") : -1]
                    refers = h.get("warc-refers-to")
                    row = (h["warc-record-id"], page(h["warc-record-id"]), h.get("warc-target-uri"), h["warc-type"], size, digest, refers and page(refers), payload if whole and payloads else None)
                    for c, v in zip(cols, row, strict=True):
                        c.append(v)
                types = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types, strict=True)], names=names)
        if reader:
            reader.close()

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frames.repartition(n, "bundle", "frame").sortWithinPartitions("bundle", "frame").mapInArrow(read, RECORDS)


def look_up(manifest: DataFrame, ids: list[str]) -> list[bytes]:
    """The raw records of a few page ids, each by one seek."""
    out = []
    for r in manifest.filter(F.col("page_id").isin(ids)).collect():
        reader = BundleReader(r.bundle)
        out.append(reader.frame(r.frame)[r.offset : r.offset + r.length])
        reader.close()
    return out
