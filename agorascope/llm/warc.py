"""WARC archives written and read as streams; oversized payloads become rows of record identifier and chunk number.

Writing: SHA-1 digests pick the response of equal payloads; each task writes one gzip-member-per-record archive into the
shared folder, chunk by chunk, under a name of its own attempt, and returns its byte ranges. Only ranges returned by a
task that ended well are in the manifest, so lost executors leave at most unread files behind.

Reading: ranges are dealt over tasks by their bytes; a range is inflated CHUNK bytes at a time into rows (record_id,
chunk_no, is_last, size so far, digest so far, data) of at most CHUNK bytes, so no record is ever held whole, however far
it inflates; the last chunk's row carries the payload's digest and length. The reader takes any WARC file, compressed or
not: records of any type and id, with HTTP blocks or others (archives_at). Empty tables give no records; repeated rows are
records of their own; other columns are not used.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.llm.staging import Stage
from agorascope.llm.textkit import strings

CHUNK = 1 << 20
RANGE = 16 << 20
#: Reading tasks at most; ranges beyond share them.
READERS = 10_000
#: Revisit rows that are broadcast to the writers; more are joined by a shuffle.
BROADCAST_ROWS = 100_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
MANIFEST = "path string, begin long, end long, records long"
CHUNKS = "record_id string, chunk_no long, is_last boolean, warc_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string, data binary"
#: What names the pages of write_archives().
PAGE = "urn:x-page:"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


class _Local:
    """A mounted shared folder."""

    def create_dir(self, path: str, recursive: bool = True) -> None:
        os.makedirs(path, exist_ok=True)

    def open_output_stream(self, path: str):
        return open(path, "wb")

    def open_input_file(self, path: str):
        return open(path, "rb")


def _file_system(root: str):
    """(file system, path) of a folder or file: mounted ones are opened directly, others through Arrow."""
    if re.match(r"file:/|/", root):
        return _Local(), "/" + root.removeprefix("file:").lstrip("/")
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", root))


def header(page_id, kind: str, url: str | None, date: str, digest: str, size: int, block: int, refers_to) -> bytes:
    """The named fields of one record. A null id is written as "null", white space and controls in a URL are escaped."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "urn:x-none")
    name = "null" if page_id is None else page_id
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{PAGE}{name}>", f"WARC-Target-URI: {uri}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}", "Content-Type: application/http; msgtype=response"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <{PAGE}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join([*lines, f"Content-Length: {block}", "", ""]).encode()


def _record(page_id, url, payload: memoryview, digest: str, refers_to, date: str, level: int) -> Iterator[bytes]:
    """One record as a gzip member, in pieces."""
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    kind = "response" if refers_to is None else "revisit"
    http = HTTP % len(payload)
    block = len(http) + (len(payload) if kind == "response" else 0)
    yield pack.compress(header(page_id, kind, url, date, digest, len(payload), block, refers_to) + http)
    if kind == "response":
        for a in range(0, len(payload), CHUNK):
            yield pack.compress(payload[a : a + CHUNK])
    yield pack.compress(b"\r\n\r\n") + pack.flush()


def write_archives(pages: DataFrame, stage: Stage, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", level: int = 3, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Writes an archive per task below the stage's folder; the manifest of their byte ranges is returned.

    Null bodies are empty payloads; equal payloads of min_bytes or more refer to the smallest id (a null id never is one,
    and stays a response where it stands alone); repeated ids with the smallest id are all responses."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(body_col).cast("string"), F.lit("")).alias("html"))
    sums = rows.select("page_id", F.sha1(F.col("html").cast("binary")).alias("sha1"), F.octet_length("html").alias("size"))
    sums = stage.table(sums.where(F.col("size") >= min_bytes), "sums")
    first = sums.groupBy("sha1").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null")
    revisits = stage.table(sums.join(first, "sha1").where("not page_id <=> refers_to").select("page_id", "sha1", "refers_to").distinct(), "revisits")
    root = f"{stage.root}/archives"
    if revisits.count() <= BROADCAST_ROWS:
        revisits = F.broadcast(revisits)
    keyed = rows.withColumn("sha1", F.sha1(F.col("html").cast("binary"))).alias("p")
    r = revisits.alias("r")
    joined = keyed.join(r, F.expr("p.page_id <=> r.page_id and p.sha1 = r.sha1"), "left").select("p.page_id", "p.url", "p.html", "p.sha1", "r.refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = _file_system(root)
        files.create_dir(folder, recursive=True)
        part = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        name, ranges, at, begin, count = f"{root}/{part}", [], 0, 0, 0
        with files.open_output_stream(f"{folder}/{part}") as out:
            for batch in batches:
                ids, urls, refs, sums = (batch.column(c).to_pylist() for c in ("page_id", "url", "refers_to", "sha1"))
                text = strings(batch.column("html"))
                for i in range(batch.num_rows):
                    payload = memoryview(text[i].as_buffer() or b"")
                    digest = base32(bytes.fromhex(sums[i]))
                    for piece in _record(ids[i], urls[i], payload, digest, refs[i], date, level):
                        out.write(piece)
                        at += len(piece)
                    count += 1
                    if at - begin >= RANGE:
                        ranges.append((name, begin, at, count))
                        begin, count = at, 0
        if count:
            ranges.append((name, begin, at, count))
        cols = list(zip(*ranges, strict=True)) if ranges else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == 0 else pa.int64()) for k, c in enumerate(cols)], ["path", "begin", "end", "records"])

    return stage.table(joined.mapInArrow(run, MANIFEST), "manifest")


class RecordStream:
    """Splits inflated bytes into records: feed() yields (fields, chunk, is_last) with chunks of payload.

    Names of fields are in lower case. The payload of an HTTP block is what follows its header; other blocks are payload as
    they are, and so is a block said to be HTTP whose header does not end."""

    def __init__(self):
        self.buffer, self.fields, self.left, self.is_payload = bytearray(), None, 0, False

    def feed(self, data: bytes) -> Iterator[tuple[dict, bytes, bool]]:
        self.buffer += data
        while True:
            if self.fields is None:
                while self.buffer[:2] == b"\r\n":  # what ends the record before
                    del self.buffer[:2]
                end = self.buffer.find(b"\r\n\r\n")
                if end < 0:
                    if len(self.buffer) > 2 * CHUNK + (1 << 20):
                        raise ValueError("not a WARC record: its header does not end")
                    return
                lines = self.buffer[:end].decode("utf-8", "replace").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
                self.fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
                self.left = int(self.fields["content-length"])
                self.is_payload = not self.fields.get("content-type", "").lower().startswith("application/http")
                del self.buffer[: end + 4]
                if not self.left:
                    self.is_payload = True
                    yield self.fields, b"", True
            if not self.is_payload:
                end = self.buffer.find(b"\r\n\r\n", 0, self.left)
                if end < 0 and len(self.buffer) < min(self.left, 1 << 20):
                    return
                if end >= 0:
                    del self.buffer[: end + 4]
                    self.left -= end + 4
                self.is_payload = True
                if not self.left:
                    yield self.fields, b"", True
            while self.left and self.buffer and (len(self.buffer) >= CHUNK or len(self.buffer) >= self.left):
                take = min(self.left, CHUNK, len(self.buffer))
                piece = bytes(self.buffer[:take])
                del self.buffer[:take]
                self.left -= take
                yield self.fields, piece, not self.left
            if self.left:
                return
            self.fields = None

    def end(self) -> None:
        """Raises if the bytes end within a record."""
        if self.fields is not None or self.buffer.strip(b"\r\n"):
            raise ValueError("the archive ends within a record")


def inflated(file, begin: int, end: int) -> Iterator[bytes]:
    """The bytes of a range, at most CHUNK at a time: of its gzip members one after the other, or as they are."""
    file.seek(begin)
    data, inflate = b"", None
    while True:
        # The two bytes that tell a gzip member may lie on either side of a chunk's end.
        while begin < end and len(data) < (2 if inflate is None else 1):
            more = file.read(min(CHUNK, end - begin))
            if not more:
                raise ValueError("the archive is shorter than its range")
            begin, data = begin + len(more), data + more
        if inflate is None:
            if not data:
                return
            if data[:2] != b"\x1f\x8b":
                yield data
                data = b""
                continue
            inflate = zlib.decompressobj(31)
        piece = inflate.decompress(data, CHUNK)
        if piece:
            yield piece
        if inflate.eof:
            data, inflate = inflate.unused_data, None
        else:
            data = inflate.unconsumed_tail
            if not piece and not data and begin >= end:
                raise ValueError("the archive ends within a gzip member")


def _named(field: str | None) -> str | None:
    """The URI of a field, without its brackets."""
    return field.removeprefix("<").removesuffix(">") if field else None


def archives_at(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of WARC files at a path or pattern, one range per file."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.lit(0).cast("long").alias("begin"), F.col("length").alias("end"), F.lit(None).cast("long").alias("records"))


def read_chunks(manifest: DataFrame, with_data: bool = True) -> DataFrame:
    """The chunk table of the archives: rows of at most CHUNK payload bytes with running length and digest.

    A revisit has the digest its header tells, and the length if the header tells that; a payload whose digest differs from
    its header's is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, begin, end in zip(*(batch.column(c).to_pylist() for c in ("path", "begin", "end")), strict=True):
                files, place = _file_system(path)
                with files.open_input_file(place) as f:
                    rows, held, stream = [], 0, RecordStream()
                    sha, size, number = hashlib.sha1(), 0, 0
                    for bytes_ in inflated(f, begin, end):
                        for fields, piece, is_last in stream.feed(bytes_):
                            sha.update(piece)
                            size += len(piece)
                            kind = fields.get("warc-type")
                            told, length, digest = fields.get("warc-payload-digest", "").removeprefix("sha1:"), size, base32(sha.digest())
                            if kind == "revisit":
                                length, digest = int(fields["x-payload-length"]) if "x-payload-length" in fields else None, told or None
                            elif is_last and len(told) == 32 and told != digest and kind in ("response", "resource"):
                                raise ValueError(f"{path}: payload digest of {fields.get('warc-record-id')} differs")
                            rows.append((_named(fields.get("warc-record-id")), number, is_last, kind, fields.get("warc-target-uri"), _named(fields.get("warc-refers-to")), length, digest, piece if with_data else None))
                            held += len(piece) if with_data else 64
                            number += 1
                            if is_last:
                                sha, size, number = hashlib.sha1(), 0, 0
                            if held >= 4 * CHUNK:
                                yield _chunk_rows(rows)
                                rows, held = [], 0
                    stream.end()
                    yield _chunk_rows(rows)

    ranges = manifest.count()
    return manifest.repartition(max(1, min(ranges, READERS)), "path", "begin").mapInArrow(run, CHUNKS)


def _chunk_rows(rows: list) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    cols = zip(*rows, strict=True) if rows else [[]] * 9
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [c.split()[0] for c in CHUNKS.split(", ")])


def records(chunks: DataFrame) -> DataFrame:
    """One row per record from its last chunk: no record is put together."""
    return chunks.where("is_last").select("record_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), "refers_to")


def pages(chunks: DataFrame) -> DataFrame:
    """The records of write_archives() by the ids of their pages."""
    page = lambda c: F.regexp_extract(c, rf"^{PAGE}(-?[0-9]+)$", 1).try_cast("long")
    return records(chunks).withColumns({"page_id": page("record_id"), "refers_to": page("refers_to")}).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
