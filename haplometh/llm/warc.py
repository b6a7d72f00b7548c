"""WARC archives from and to a chunked record table.

A payload is a run of rows (record, chunk number, bytes) of bounded size that
follow each other in one task. The writer streams such rows into archives, one
gzip member a record; the reader streams archives into such rows and carries
the digest along, so neither ever holds a payload or an archive as a whole.

Equal payloads from ``DEDUPE_BYTES`` on are stored once: the record with the
largest page id is the response, the others are revisits that refer to it.

Null html is an empty payload; a null url, or one of more than
``LONGEST_TARGET`` bytes when escaped, leaves out the target; a null page id
is kept as null and loses to any other id. Rows that repeat both page id and
payload are equal records: all of them responses, or all revisits. Other
columns are ignored. An empty table gives no archive and no rows.

A task that fails leaves a file that no manifest names; it is never read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from contextlib import closing
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haplometh.storage import materialize, scratch_path

#: Bytes of a chunk row, of an archive after which the next begins, of the shortest payload stored once.
CHUNK, ARCHIVE, DEDUPE_BYTES = 16 << 10, 64 << 20, 1000
#: Bytes of a header that a reader takes, and of an escaped url that a writer puts into it.
LONGEST_HEADER, LONGEST_TARGET = 1 << 20, 1 << 16


# Files on the shared folder, wherever it is.


def _local(path: str) -> str | None:
    parts = urlsplit(path)
    return parts.path if parts.scheme in ("", "file") else None


def open_to_write(path: str) -> io.IOBase:
    local = _local(path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, "wb")
    store, name = pa.fs.FileSystem.from_uri(path)
    return store.open_output_stream(name)


def open_to_read(path: str) -> io.IOBase:
    local = _local(path)
    if local is not None:
        return open(local, "rb")
    store, name = pa.fs.FileSystem.from_uri(path)
    return store.open_input_stream(name)


# Records.


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page is None else page}:{digest}>"


def page_of(record: str) -> int | None:
    page = re.fullmatch(r"<urn:page:(-?[0-9]*):[0-9a-f]+>", record)[1]
    return int(page) if page else None


def head(page: int | None, url: str | None, digest: str, size: int, refers_to: int | None) -> bytes:
    """A record's header with its HTTP header; the payload follows, then two line ends."""
    revisit = refers_to is not None
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + f"Content-Length: {size}\r\n\r\n"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page, digest)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(http) + (0 if revisit else size))),
    ]
    target = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    if target is not None and len(target.encode()) <= LONGEST_TARGET:
        fields.append(("WARC-Target-URI", target))
    if revisit:
        fields.append(("WARC-Refers-To", record_id(refers_to, digest)))
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{lines}\r\n{http}".encode()


def with_roles(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``payload_bytes``, ``digest`` and ``refers_to`` (null: a response)."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("payload_bytes", F.length("payload").cast("long"))
    narrow = materialize(rows.select("page_id", "digest", "payload_bytes"), "warc-digests")
    large = narrow.filter(F.col("payload_bytes") >= DEDUPE_BYTES)
    kept = large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1")
    revisits = large.join(kept, "digest").filter(F.coalesce(F.col("page_id") < F.col("refers_to"), F.col("refers_to").isNotNull()))
    revisits = revisits.select(F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), "refers_to").distinct()
    same = F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest"))
    return rows.join(revisits, same, "left").drop("r_page", "r_digest")


def chunks(records: DataFrame, size: int = CHUNK) -> DataFrame:
    """The chunked record table: a record's rows follow each other, chunk 0 always exists; revisits have no bytes."""
    stored = F.when(F.col("refers_to").isNull(), F.col("payload_bytes")).otherwise(F.lit(0))
    last = F.greatest(F.lit(0), F.ceil(stored / size) - 1).cast("int")
    numbered = records.withColumn("last", last).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("last"))))
    data = F.when(F.col("refers_to").isNull(), F.substring("payload", F.col("chunk") * size + 1, F.lit(size))).otherwise(F.lit(b""))
    return numbered.select("page_id", "url", "digest", "payload_bytes", "refers_to", "chunk", (F.col("chunk") == F.col("last")).alias("ends"), data.alias("data"))


def write(table: DataFrame, folder: str, most: int = ARCHIVE) -> DataFrame:
    """Stream a chunked record table into archives below ``folder``; the manifest ``path``, ``records``.

    A payload whose bytes do not have the announced digest fails the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, records, written = None, "", 0, 0
        digest = member = None

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records], pa.int64())], names=["path", "records"])

        for batch in batches:
            for page, url, told, size, refers_to, chunk, ends, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if chunk == 0:
                    if out is not None and written >= most:
                        yield done()
                        out = None
                    if out is None:
                        path, records, written = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = open_to_write(path)
                    member, digest = zlib.compressobj(6, zlib.DEFLATED, 31), hashlib.sha1()
                    written += out.write(member.compress(head(page, url, told, size, refers_to))) or 0
                digest.update(data)
                written += out.write(member.compress(data)) or 0
                if ends:
                    if refers_to is None and digest.hexdigest() != told:
                        raise ValueError(f"payload of page {page} is not the one announced")
                    written += out.write(member.compress(b"\r\n\r\n") + member.flush()) or 0
                    records += 1
        if out is not None:
            yield done()

    return table.mapInArrow(run, "path string, records long")


class Members:
    """The bytes of an archive's gzip members, read in bounded pieces."""

    def __init__(self, raw: io.IOBase):
        self.raw, self.held, self.rest = raw, bytearray(), b""
        self.open = None

    def more(self) -> bool:
        """Decompress a piece; False at the end of the archive."""
        while True:
            if not self.rest:
                self.rest = self.raw.read(CHUNK)
                if not self.rest:
                    if self.open is not None:
                        raise ValueError("the archive ends inside a record")
                    return False
            if self.open is None:
                self.open = zlib.decompressobj(31)
            piece = self.open.decompress(self.rest, CHUNK)
            self.rest = self.open.unconsumed_tail
            if self.open.eof:
                self.rest, self.open = self.open.unused_data, None
            if piece:
                self.held += piece
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with ``mark``; None at the end of the archive."""
        seen = 0
        while (at := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            if seen > LONGEST_HEADER:
                raise ValueError("no end of a header")
            if not self.more():
                if self.held:
                    raise ValueError("the archive ends inside a header")
                return None
        return self.take(at + len(mark))

    def take(self, most: int) -> bytes:
        """At least one and at most ``most`` bytes."""
        if not self.held and not self.more():
            raise ValueError("the archive ends inside a record")
        piece = bytes(self.held[:most])
        del self.held[:most]
        return piece


def fields(header: bytes) -> dict[str, str]:
    first, *lines = header.decode("utf-8").split("\r\n")
    if not first.startswith("WARC/1."):
        raise ValueError(f"not a record: {first[:40]!r}")
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines if line)}


RECORDS = "record string, page_id long, url string, type string, refers_to long, chunk int, data binary, payload_bytes long, digest string, ends boolean"
_NAMES = [x.split()[0] for x in RECORDS.split(", ")]
_KINDS = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]


def records_of(raw: io.IOBase, with_data: bool) -> Iterator[tuple]:
    """The chunk rows of an archive, with bytes and digest so far; the last row of a record has both in full."""
    members = Members(raw)
    while (header := members.until(b"\r\n\r\n")) is not None:
        told = fields(header)
        announced = base64.b32decode(told["warc-payload-digest"].removeprefix("sha1:")).hex()
        identity = told["warc-record-id"]
        http = members.until(b"\r\n\r\n")
        left = int(told["content-length"]) - len(http)
        size = int(re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", http)[1])
        refers_to = page_of(told["warc-refers-to"]) if "warc-refers-to" in told else None
        common = (identity, page_of(identity), told.get("warc-target-uri"), told["warc-type"], refers_to)
        if told["warc-type"] == "revisit":
            yield (*common, 0, b"", size, announced, True)
        else:
            digest, seen, chunk = hashlib.sha1(), 0, 0
            while True:
                piece = members.take(min(CHUNK, left)) if left else b""
                digest.update(piece)
                seen, left = seen + len(piece), left - len(piece)
                if not left and digest.hexdigest() != announced:
                    raise ValueError(f"{identity}: the payload read is not the one written")
                if with_data or not left:
                    yield (*common, chunk, piece if with_data else b"", seen, digest.hexdigest(), not left)
                chunk += 1
                if not left:
                    break
        if members.until(b"\r\n\r\n") != b"\r\n\r\n":
            raise ValueError(f"{identity}: bytes behind the record")


def read(manifest: DataFrame, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives in ``manifest``; without data, the last row of each record."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for paths in batches:
            for path in paths.column(0).to_pylist():
                with closing(open_to_read(path)) as raw:
                    rows: list[tuple] = []
                    for row in records_of(raw, with_data):
                        rows.append(row)
                        if len(rows) >= 512:
                            yield batch(rows)
                            rows = []
                    if rows:
                        yield batch(rows)

    return manifest.select("path").mapInArrow(run, RECORDS)


def archive(pages: DataFrame) -> DataFrame:
    """Write ``pages`` into archives in the shared folder; their manifest, one partition an archive at most."""
    folder = scratch_path(pages.sparkSession, "warc")
    manifest = materialize(write(chunks(with_roles(pages)), folder), "warc-manifest")
    return manifest.repartition(max(1, manifest.count()))
