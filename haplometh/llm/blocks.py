"""Texts packed into blocks, and an exchange that tells which hashes occur again.

A block is a bounded number of documents, compressed. To learn which of its
hashes occur elsewhere, a block sends each distinct hash once to each range of
hashes, with a mark if it has it twice, and gets one bit per hash back. No
document, position or pair travels, so a value that a third of all documents
hold is one hash a block.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.ipc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haplometh.llm.arrow import frugal, steps
from haplometh.storage import materialize

#: Bytes of text in a block, and hashes of a range that are compared in one task.
BLOCK_BYTES, RANGE_HASHES = 4 << 20, 1 << 21


def blocks(docs: DataFrame, rows: bool = False) -> DataFrame:
    """Packed blocks: ``block``, ``size`` (bytes of text), ``ids`` and compressed ``texts``; written to the shared folder.

    A text longer than a block has a block to itself. With ``rows``, a block
    also holds its whole rows (``rows``), for ``chosen_rows``.
    """
    id_at, text_at = (docs.columns.index(c) for c in ("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)

        def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            ids = [i for p in parts for i in p.column(id_at).to_pylist()]
            texts = [(t or "").encode() for p in parts for t in p.column(text_at).to_pylist()]
            sizes = np.array([len(t) for t in texts], np.int64)
            columns = [pa.array([int(sizes.sum())], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([press.compress(sizes.tobytes() + b"".join(texts))], pa.binary())]
            if rows:
                sink = io.BytesIO()
                others = [p.set_column(text_at, "text", p.column(text_at).is_null()) for p in parts]  # the texts are held once
                with pa.ipc.new_stream(sink, others[0].schema) as out:
                    for p in others:
                        out.write_batch(p)
                columns.append(pa.array([press.compress(sink.getvalue())], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=["size", "ids", "texts", *["rows"] * rows])

        parts, held = [], 0
        for batch in batches:
            for step in steps(batch, text_at, BLOCK_BYTES):
                size = step.column(text_at).nbytes
                if parts and held + size > BLOCK_BYTES:
                    yield packed(parts)
                    parts, held = [], 0
                parts.append(step)
                held += size
        if parts:
            yield packed(parts)

    source = docs.select(*[F.col(f"`{c}`").cast("long").alias(c) if c == "doc_id" else F.col(f"`{c}`") for c in docs.columns]) if rows else docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not rows:
        id_at, text_at = 0, 1
    packed_rows = source.mapInArrow(frugal(run), "size long, ids array<long>, texts binary" + ", rows binary" * rows)
    return materialize(packed_rows.select(F.monotonically_increasing_id().alias("block"), "*"), "text-blocks")


def chosen_rows(packed: DataFrame, places: DataFrame, like: DataFrame) -> DataFrame:
    """The rows of ``packed`` named in ``places`` (``block``, ``place``), with the columns of ``like``."""
    listed = places.groupBy("block").agg(F.collect_list("place").alias("places"))  # at most a block's rows

    text_at = like.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts, rows, chosen in zip(*(batch.column(c) for c in ("ids", "texts", "rows", "places")), strict=True):
                places = sorted(chosen.as_py())
                raw = zstandard.ZstdDecompressor().decompress(rows.as_py())
                table = pa.ipc.open_stream(raw).read_all().take(pa.array(places))
                own = unpacked(ids, texts.as_py())
                back = [None if null else own[i].decode() for i, null in zip(places, table.column(text_at).to_pylist(), strict=True)]
                yield from table.set_column(text_at, "text", pa.array(back, pa.string())).to_batches(max_chunksize=1024)

    return packed.join(listed, "block").select("ids", "texts", "rows", "places").mapInArrow(frugal(run), like.schema)


def unpacked(ids, texts: bytes) -> list[bytes]:
    body = zstandard.ZstdDecompressor().decompress(texts)
    ends = 8 * len(ids) + np.cumsum(np.frombuffer(body, np.int64, len(ids)))
    return [body[a:b] for a, b in zip([8 * len(ids), *ends[:-1]], ends, strict=True)]


def sent(hashes: np.ndarray, ranges: int) -> Iterator[tuple[int, bytes, bytes]]:
    """For each range of hashes: its number, the distinct hashes in order, and a bit for each that occurs again."""
    values, counts = np.unique(hashes, return_counts=True)
    part = ((values >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    ends = np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64))
    for r in np.flatnonzero(np.diff(ends)):
        own = slice(ends[r], ends[r + 1])
        yield int(r), values[own].tobytes(), np.packbits(counts[own] > 1).tobytes()


def answered(hashes: np.ndarray, ranges: int, bits: dict[int, bytes]) -> np.ndarray:
    """For each of ``hashes``, sent as above, whether it occurs again; ``bits`` by range."""
    values, back = np.unique(hashes, return_inverse=True)
    part = ((values >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    ends = np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64))
    again = np.zeros(len(values), bool)
    for r in np.flatnonzero(np.diff(ends)):
        size = ends[r + 1] - ends[r]
        again[ends[r] : ends[r + 1]] = np.unpackbits(np.frombuffer(bits[int(r)], np.uint8), count=size)
    return again[back]


SENT = "block long, part int, hashes binary, twice binary"


def rows_to_send(block: int, hashes: np.ndarray, ranges: int) -> Iterator[pa.RecordBatch]:
    found = list(sent(hashes, ranges))
    for at in range(0, len(found), 64):
        some = found[at : at + 64]
        yield pa.RecordBatch.from_arrays(
            [pa.array([block] * len(some), pa.int64()), pa.array([f[0] for f in some], pa.int32()), pa.array([f[1] for f in some], pa.binary()), pa.array([f[2] for f in some], pa.binary())],
            names=["block", "part", "hashes", "twice"],
        )


def compared(parts: DataFrame) -> DataFrame:
    """For each block and range, a bit for each hash: whether it occurs again, here or in another block."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        values = [np.frombuffer(h, np.uint64) for h in pdf["hashes"]]
        twice = [np.unpackbits(np.frombuffer(t, np.uint8), count=len(v)) for t, v in zip(pdf["twice"], values, strict=True)]
        _, back, counts = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
        again = (counts[back] > 1) | (np.concatenate(twice) > 0)
        cuts = np.cumsum([len(v) for v in values])[:-1]
        bits = [np.packbits(b).tobytes() for b in np.split(again, cuts)]
        return pd.DataFrame({"block": pdf["block"], "part": pdf["part"], "again": bits})

    return parts.groupBy("part").applyInPandas(run, "block long, part int, again binary")


def ranges_for(packed: DataFrame, hashes_a_byte: float) -> int:
    """How many ranges keep a range's hashes near ``RANGE_HASHES``."""
    total = packed.agg(F.sum("size")).collect()[0][0] or 0
    return max(16, int(total * hashes_a_byte / RANGE_HASHES) + 1)


def bits(told) -> dict[int, bytes]:
    """A block's answers by range."""
    return {x["part"]: x["again"] for x in told or []}


def answers(parts: DataFrame, name: str) -> DataFrame:
    """One row a block: its ranges and their bits, as lists in the same order."""
    return compared(parts).groupBy("block").agg(F.collect_list(F.struct("part", "again")).alias(name))
