"""Byte ranges of files that Spark's text reader does not split well: sequences in lines of any length.

A FASTA chromosome may be one line of hundreds of megabytes, and a text scan
reads a line in one task. This data source plans byte ranges instead. A range
starts and ends anywhere; whether it starts inside a name line is known from
the bytes just before it, since a name line has a greatest length.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, the work of a task; of a row's sequence; and the most of a name line.
RANGE_BYTES, ROW_BYTES, NAME_BYTES = 32 << 20, 1 << 16, 1 << 16
SCHEMA = "file string, split bigint, line bigint, value string"
_NAME = re.compile(rb"^>[^\n]*", re.MULTILINE)
_BLANKS = b" \t\r\n"


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    end: int
    size: int


def opened(path: str):
    """A file of any filesystem that Arrow knows, for reading at any place."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pyarrow.fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    filesystem, inner = pyarrow.fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")
    return filesystem.open_input_file(inner)


def pieces(source, start: int, end: int, size: int) -> Iterator[bytes]:
    """Name lines, and runs of bases without line ends, of the bytes from ``start`` to ``end``.

    A name line belongs to the range that holds its first byte.
    """
    source.seek(max(0, start - NAME_BYTES - 1))
    before = source.read(start - source.tell())
    line = before.rpartition(b"\n")
    # no line end in sight: the line is longer than any name, or the file's first
    fresh = not line[2] if line[1] or start <= NAME_BYTES + 1 else False
    in_name = line[2].startswith(b">") and bool(line[1] or start <= NAME_BYTES + 1)
    data = source.read(end - start)
    at = 0
    if in_name:
        at = data.find(b"\n") + 1 or len(data)
    for found in _NAME.finditer(data, at):
        if found.start() == 0 and not fresh:
            continue
        yield from _bases(data[at : found.start()])
        name, at = found.group(), found.end()
        if at == len(data) and end < size:
            name += source.read(NAME_BYTES).partition(b"\n")[0]
        if len(name) > NAME_BYTES:
            raise ValueError(f"a name line of more than {NAME_BYTES} bytes: {name[:60]!r}")
        yield name.rstrip(_BLANKS)
    yield from _bases(data[at:])


def _bases(data: bytes) -> Iterator[bytes]:
    bases = data.translate(None, _BLANKS)
    for at in range(0, len(bases), ROW_BYTES):
        yield bases[at : at + ROW_BYTES]


class RangeReader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], width: int):
        self.files, self.width = files, width

    def partitions(self) -> list[ByteRange]:
        return [
            ByteRange(path, at, min(at + self.width, size), size) for path, size in self.files for at in range(0, size, self.width)
        ] or [ByteRange("", 0, 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.size:
            return
        with opened(partition.path) as source:
            for line, value in enumerate(pieces(source, partition.start, partition.end, partition.size)):
                yield pa.RecordBatch.from_pydict(
                    {"file": [partition.path], "split": [partition.start], "line": [line], "value": [value.decode("ascii", "replace")]}
                )


class FastaRanges(DataSource):
    """Rows ``file``, ``split``, ``line``, ``value`` of FASTA files, a task a byte range."""

    @classmethod
    def name(cls) -> str:
        return "fasta_ranges"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RangeReader:
        return RangeReader(json.loads(self.options["files"]), int(self.options["width"]))


def read_fasta_ranges(spark: SparkSession, path: str | list[str], width: int = RANGE_BYTES) -> DataFrame:
    """Pieces of plain FASTA files in byte ranges of ``width``; blanks and line ends are dropped.

    Spark lists the files (folders and patterns as everywhere) without reading
    them. Empty files have no rows; a name line of more than ``NAME_BYTES`` fails.
    """
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    files = sorted((row["path"], row["length"]) for row in listed.filter(F.col("length") > 0).collect())  # a row a file
    spark.dataSource.register(FastaRanges)
    return spark.read.format("fasta_ranges").options(files=json.dumps(files), width=str(width)).load()
