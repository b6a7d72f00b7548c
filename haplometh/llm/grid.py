"""A query set against all vectors, in blocks: packing, the grid of blocks, the merge.

Vectors are packed into blocks of bounded size where they lie; query blocks and
candidate blocks meet in the cells of a grid, each a task's bounded work; a
cell keeps a few rows for each query, which heaps merge in one sorted pass.

Vectors that are null or hold null or non-finite components take no part, nor
do rows without an id. Vectors of different lengths are compared over the
shorter one (missing components are zero). Rows that repeat an id are all
candidates; as a query, an id counts once, with its smallest vector, and never
meets a row of its own id.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haplometh.storage import materialize

#: Vectors in a block; a block's arrays and a tile of its scores fit a task many times over.
BLOCK_ROWS = 4096
#: Queries whose scores against a block are held at once.
TILE = 256

Encode = Callable[[np.ndarray, np.ndarray], dict[str, bytes]]
#: (query ids, query columns, candidate ids, candidate columns) to rows (query, ids, scores)
Kernel = Callable[[np.ndarray, dict, np.ndarray, dict], Iterator[tuple[int, np.ndarray, np.ndarray]]]


def usable(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", zero: bool = True) -> DataFrame:
    """Key and vector (as doubles) of the rows that take part; ``zero`` keeps zero vectors."""
    x = F.col(vector).cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), x.alias("vector")).filter(F.col(key).isNotNull() & x.isNotNull() & fine)
    return rows if zero else rows.filter(F.exists("vector", lambda v: v != 0))


def pack(rows: DataFrame, encode: Encode, columns: list[str], most: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of at most ``most`` vectors: ``ids`` and the encoded ``columns``, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        parts: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            width = max(p.shape[1] for p in parts)
            joined = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])
            names = np.concatenate(ids)
            told = encode(names, joined)
            return pa.RecordBatch.from_arrays(
                [pa.array([len(names)], pa.int32()), pa.array([names.tobytes()], pa.binary()), *[pa.array([told[c]], pa.binary()) for c in columns]],
                names=["size", "ids", *columns],
            )

        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                piece = batch.slice(at, most)
                if held and held + piece.num_rows > most:
                    yield block()
                    ids, parts, held = [], [], 0
                ids.append(piece.column(0).to_numpy())
                parts.append(matrix(piece.column(1)))
                held += piece.num_rows
        if held:
            yield block()

    return rows.select("vec_id", "vector").mapInArrow(run, "size int, ids binary, " + ", ".join(f"{c} binary" for c in columns))


def matrix(lists: pa.Array) -> np.ndarray:
    sizes = pa.compute.list_value_length(lists).to_numpy()
    flat = lists.flatten().to_numpy()
    width = int(sizes.max()) if len(sizes) else 0
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes])] = flat
    return out


def search(rows: DataFrame, is_query, k: int, encode: Encode, columns: list[str], kernel: Kernel, score: str) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (of SQL type ``score``) of each query's ``k`` best."""
    candidates = materialize(pack(rows, encode, columns), "vector-blocks")
    asked = materialize(rows.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")), "vector-queries")
    blocks, slots = max(1, -(-asked.count() // BLOCK_ROWS)), max(1, candidates.count())
    packed = materialize(pack(asked.repartition(blocks), encode, columns), "query-blocks")
    left = packed.select(*[F.col(c).alias(f"q_{c}") for c in ("ids", *columns)], F.xxhash64("ids").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    listed = packed.agg(F.sort_array(F.collect_list(F.xxhash64("ids"))).alias("b")).collect()[0]["b"]  # one number a query block
    right = candidates.select(*[F.col(c).alias(f"c_{c}") for c in ("ids", *columns)], F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int").alias("slot"))
    right = right.withColumn("block", F.explode(F.lit(listed).cast("array<bigint>")))
    cells = left.hint("merge").join(right, ["block", "slot"])  # either side grows with the input: never broadcast
    order = [f"{side}_{c}" for side in "qc" for c in ("ids", *columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in range(batch.num_rows):
                got = {name: batch.column(name)[cell].as_buffer() for name in order}
                ids = {side: np.frombuffer(got[f"{side}_ids"], np.int64) for side in "qc"}
                told = {side: {c: got[f"{side}_{c}"] for c in columns} for side in "qc"}
                found = list(kernel(ids["q"], told["q"], ids["c"], told["c"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int64())), pa.array([f[2] for f in found], pa.list_(_TYPES[score]))],
                    names=["query_id", "ids", "scores"],
                )

    near = cells.select(*order).mapInArrow(run, f"query_id long, ids array<long>, scores array<{score}>")
    return merge(near, k, score)


_TYPES = {"long": pa.int64(), "double": pa.float64()}


def merge(near: DataFrame, k: int, score: str) -> DataFrame:
    """The ``k`` best of all cells' rows for each query; ties go to the smaller id.

    The rows of a query follow each other after the sort, so one heap is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, heap = None, []

        def result() -> pa.RecordBatch:
            best = sorted(heap, reverse=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([query] * len(best), pa.int64()), pa.array(range(1, len(best) + 1), pa.int32()), pa.array([-b[1] for b in best], pa.int64()), pa.array([b[0] for b in best], _TYPES[score])],
                names=["query_id", "rank", "vec_id", "score"],
            )

        for batch in batches:
            for q, ids, scores in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if q != query:
                    if heap:
                        yield result()
                    query, heap = q, []
                for item in zip(scores, (-i for i in ids), strict=True):
                    if len(heap) < k:
                        heapq.heappush(heap, item)
                    elif item > heap[0]:
                        heapq.heapreplace(heap, item)
        if heap:
            yield result()

    return near.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(run, f"query_id long, rank int, vec_id long, score {score}")


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best, best first, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]
