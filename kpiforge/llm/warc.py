"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a bundle is a file of
frames with the seek table of the seekable format in a skippable frame at its
end. The index maps a record to its bundle, its frame and its place in the
decompressed frame, so one record costs one ranged read and one small frame."""

from __future__ import annotations

import base64
import struct
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.common import stored, work_path

MIN_DEDUP_BYTES = 1000
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 32 << 20
#: Fixed values of the Zstandard seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "1970-01-01T00:00:00Z"

INDEX = "record_id string, page_id long, bundle string, frame int, frame_offset long, frame_bytes long, offset long, length long"


def record_uri(page_id) -> str:
    return f"urn:x-page:{'none' if page_id is None else page_id}"


def encode_record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record. A revisit holds the HTTP header of the payload only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    uri = "".join(c if " " < c and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url or "")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_uri(page_id)}>",
             f"WARC-Target-URI: {uri}", f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        lines[2:2] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                      f"WARC-Refers-To: <{record_uri(refers_to)}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_records(data: bytes):
    """Records of a decompressed frame: (offset, length, headers, block)."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *rest = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        headers = dict(line.split(": ", 1) for line in rest)
        start = end + 4
        stop = start + int(headers["Content-Length"])
        yield at, stop + 4 - at, headers, data[start:stop]
        at = stop + 4


def digest_of(headers: dict) -> str:
    return base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()


def payload_of(block: bytes) -> tuple[int, bytes]:
    """Content-Length of the HTTP header, and what follows it."""
    head, _, body = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b": ")[1]) for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))
    return size, body


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", c, d) for c, d in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed, decompressed) of the frames of a bundle."""
    file.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    file.seek(size - 9 - n * entry)
    body, out, at = file.read(n * entry), [], 0
    for i in range(n):
        c, d = struct.unpack_from("<II", body, i * entry)
        out.append((at, c, d))
        at += c
    return out


def open_store(path: str):
    """File system and path for a file of the shared folder, from any executor."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("s3://" + path[6:] if path.startswith("s3a://") else path)


class BundleWriter:
    """Writes the records of one task into bundles below ``folder``. Names are
    new for each attempt, so a retry never touches what another attempt wrote;
    only bundles in the committed index count."""

    def __init__(self, folder: str):
        import zstandard

        self.folder, self.zstd = folder.rstrip("/"), zstandard.ZstdCompressor(level=3)
        self.rows, self.done = [], []
        self.file = None
        self._open_frame()

    def _open_frame(self):
        self.frame, self.held, self.frame_size = [], [], 0

    def add(self, page_id, record: bytes):
        self.held.append((record_uri(page_id), page_id, self.frame_size, len(record)))
        self.frame.append(record)
        self.frame_size += len(record)
        if self.frame_size >= FRAME_BYTES:
            self._close_frame()

    def _close_frame(self):
        if not self.frame:
            return
        data = self.zstd.compress(b"".join(self.frame))
        if self.file is None:
            self.path = f"{self.folder}/{uuid.uuid4().hex}.warc.zst"
            store, path = open_store(self.path)
            store.create_dir(path.rpartition("/")[0], recursive=True)
            self.file, self.at, self.frames = store.open_output_stream(path, compression=None), 0, []
        self.file.write(data)
        self.rows += [(u, p, self.path, len(self.frames), self.at, len(data), o, n) for u, p, o, n in self.held]
        self.frames.append((len(data), self.frame_size))
        self.at += len(data)
        self._open_frame()
        if self.at >= BUNDLE_BYTES:
            self._close_bundle()

    def _close_bundle(self):
        if self.file is not None:
            self.file.write(seek_table(self.frames))
            self.file.close()
            self.file = None
            self.done += self.rows
            self.rows = []

    def finish(self):
        self._close_frame()
        self._close_bundle()

    def taken(self):
        out, self.done = self.done, []
        return out


def revisits(pages: DataFrame, min_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload another page with
    a larger ``page_id`` has too. Only ids and digests are shuffled; a payload
    that a third of the pages share is one pre-aggregated row, and AQE splits
    its join."""
    rows = stored(pages.select("page_id", F.sha1(F.encode(F.coalesce("html", F.lit("")), "utf-8")).alias("digest"),
                               F.octet_length(F.coalesce("html", F.lit(""))).alias("n")).where(F.col("n") >= min_bytes)
                  .select("page_id", "digest").distinct(), "digests")
    kept = stored(rows.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1").select("digest", "refers_to"), "payloads")
    return rows.join(kept, "digest").where("page_id <> refers_to").select("page_id", "digest", "refers_to")


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)`` into bundles below
    ``folder`` and return the index, itself a written table.

    Null html is empty, a null url empty. Of pages with equal payloads of at
    least ``min_bytes`` bytes, the largest ``page_id`` is the response, the
    others are revisits of it. A null ``page_id`` is always a response, and so
    is each of several rows with the largest id. An empty table gives an empty
    index. Extra columns are not archived."""
    again = revisits(pages, min_bytes).select(F.col("page_id").alias("_kf_id"), F.col("digest").alias("_kf_digest"), "refers_to")
    html = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload")).withColumn("digest", F.sha1("payload"))
    rows = rows.join(again, (rows.page_id == again._kf_id) & (rows.digest == again._kf_digest), "left")

    def run(batches):
        import pyarrow as pa

        writer = BundleWriter(folder)
        names = [f.split()[0] for f in INDEX.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4]

        def out():
            got = writer.taken()
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*got, strict=True), kinds, strict=True)], names)
        for batch in batches:
            for x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                writer.add(x[0], encode_record(*x))
            yield from out()
        writer.finish()
        yield from out()
    return stored(rows.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, INDEX), "index")


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _page_of(uri: str):
    tail = uri.strip("<>").rpartition(":")[2]
    return None if tail == "none" else int(tail)


def read_archives(index: DataFrame) -> DataFrame:
    """A row per record of the bundles in ``index``, read frame by frame from
    the files; payload digests of responses are computed anew and must agree."""
    def run(batches):
        import hashlib

        import pyarrow as pa
        import zstandard

        names = [f.split()[0] for f in READ.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = open_store(path)
                with store.open_input_file(name) as file:
                    for at, size, _ in read_seek_table(file, file.size()):
                        file.seek(at)
                        rows = []
                        for _, _, headers, block in decode_records(zstandard.ZstdDecompressor().decompress(file.read(size))):
                            n, body = payload_of(block)
                            kind, digest = headers["WARC-Type"], digest_of(headers)
                            if kind == "response" and (len(body) != n or hashlib.sha1(body).hexdigest() != digest):
                                raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
                            rows.append((_page_of(headers["WARC-Record-ID"]), n, digest, kind,
                                         _page_of(headers["WARC-Refers-To"]) if kind == "revisit" else None))
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    bundles = index.select("bundle").distinct()
    # names are few and small: without a number of its own this table would be one partition, and one task
    return bundles.repartition(max(bundles.count(), 1)).mapInArrow(run, READ)


def fetch(index: DataFrame, page_ids: DataFrame) -> DataFrame:
    """(page_id, record_type, payload) of single records, by seeking: one ranged
    read and one frame for each. A revisit has an empty payload."""
    def run(batches):
        import pyarrow as pa
        import zstandard

        for batch in batches:
            rows = []
            for page, path, at, size, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, name = open_store(path)
                with store.open_input_file(name) as file:
                    file.seek(at)
                    data = zstandard.ZstdDecompressor().decompress(file.read(size))
                _, _, headers, block = next(decode_records(data[offset:offset + length]))
                rows.append((page, headers["WARC-Type"], payload_of(block)[1]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.binary()), strict=True)],
                                                 ["page_id", "record_type", "payload"])
    wanted = index.join(page_ids.select("page_id").distinct(), "page_id")
    return wanted.select("page_id", "bundle", "frame_offset", "frame_bytes", "offset", "length").mapInArrow(
        run, "page_id long, record_type string, payload binary")


def op8_seekable_bundles(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return read_archives(write_archives(pages, work_path(spark, "warc")))


OP8_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN k.keeper IS NOT NULL AND k.keeper <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN k.keeper <> p.page_id THEN k.keeper END AS refers_to
FROM p LEFT JOIN k ON p.payload_digest = k.payload_digest AND p.payload_bytes >= 1000
"""
