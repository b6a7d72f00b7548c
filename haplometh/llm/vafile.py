"""Exact search by inner product over vector-approximation files.

Components become the integers floor(256 x). A block's file holds, for each
vector and dimension, the number of a cell between fixed cuts; the cell's ends
bound the component, hence the inner product with a query. A scan of the cells
bounds every candidate; exact vectors are then read in the order of their
bounds until no unread one can be among the best.

What takes part and how repeated ids count is said in ``grid``. Scores are
exact integers; ones beyond 64 bits are cut to the largest or smallest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame

from haplometh.llm import grid

#: Cells a dimension, and exact vectors read at a time.
CELLS, READ = 64, 32
#: Sums of products up to this size are exact in double precision.
EXACT = float(1 << 53)
LONG = np.iinfo(np.int64)


def encode(ids: np.ndarray, x: np.ndarray) -> dict[str, bytes]:
    """The exact integers (as doubles), the cells, and the cuts of the cells."""
    whole = np.floor(256.0 * x)
    if not len(whole) or not whole.shape[1]:
        return {"exact": b"", "cell": b"", "cut": b""}
    low, high = whole.min(axis=0), whole.max(axis=0)
    step = np.maximum((high - low) / CELLS, np.finfo(float).tiny)
    cell = np.minimum((whole - low) / step, CELLS - 1).astype(np.uint8)
    # a cell's ends are the extremes of what lies in it: bounds hold whatever the rounding above
    cuts = np.empty((2, whole.shape[1], CELLS))
    cuts[0], cuts[1] = np.inf, -np.inf
    dims = np.broadcast_to(np.arange(whole.shape[1]), whole.shape)
    np.minimum.at(cuts[0], (dims, cell), whole)
    np.maximum.at(cuts[1], (dims, cell), whole)
    return {"exact": whole.tobytes(), "cell": cell.tobytes(), "cut": cuts.tobytes()}


def kernel(k: int) -> grid.Kernel:
    def near(q_ids: np.ndarray, q: dict, c_ids: np.ndarray, c: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        asked = np.frombuffer(q["exact"]).reshape(len(q_ids), -1)
        exact = np.frombuffer(c["exact"]).reshape(len(c_ids), -1)
        width = min(asked.shape[1], exact.shape[1])
        asked = asked[:, :width]
        if not width or np.abs(asked).max() * np.abs(exact).max() * width >= EXACT:
            yield from plain(q_ids, asked, c_ids, exact[:, :width], k)
            return
        cell = np.frombuffer(c["cell"], np.uint8).reshape(exact.shape)[:, :width]
        cuts = np.frombuffer(c["cut"]).reshape(2, exact.shape[1], CELLS)
        low, high = (cuts[i][np.arange(width), cell].T for i in (0, 1))
        exact = exact[:, :width]
        for at in range(0, len(q_ids), grid.TILE):
            tile = asked[at : at + grid.TILE]
            up, down = np.maximum(tile, 0), np.minimum(tile, 0)
            most, least = up @ high + down @ low, up @ low + down @ high
            own = q_ids[at : at + grid.TILE, None] == c_ids
            most[own] = least[own] = -np.inf
            for i, query in enumerate(q_ids[at : at + grid.TILE]):
                chosen = read(tile[i], most[i], least[i], exact, c_ids, k)
                if len(chosen[0]):
                    yield int(query), *chosen

    return near


def read(query: np.ndarray, most: np.ndarray, least: np.ndarray, exact: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of a block, reading exact vectors by falling upper bound."""
    floor = np.partition(least, -k)[-k] if len(least) > k else -np.inf
    open_ = np.flatnonzero((most >= floor) & (most > -np.inf))
    order = open_[np.argsort(-most[open_], kind="stable")]
    best_ids, best = np.empty(0, np.int64), np.empty(0)
    for at in range(0, len(order), READ):
        if len(best) == k and most[order[at]] < best[-1]:
            break
        part = order[at : at + READ]
        best, best_ids = np.append(best, exact[part] @ query), np.append(best_ids, ids[part])
        keep = grid.best_rows(best, best_ids, k)
        best, best_ids = best[keep], best_ids[keep]
    return best_ids, best.astype(np.int64)


def plain(q_ids: np.ndarray, asked: np.ndarray, c_ids: np.ndarray, exact: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For numbers too large for exact products of doubles: whole numbers of any size."""
    other = [list(map(int, row)) for row in exact]
    for query, row in zip(q_ids, asked, strict=True):
        mine = list(map(int, row))
        scored = sorted((-sum(a * b for a, b in zip(mine, o, strict=True)), int(i)) for o, i in zip(other, c_ids, strict=True) if i != query)[:k]
        if scored:
            yield int(query), np.array([i for _, i in scored]), np.array([max(LONG.min, min(LONG.max, -s)) for s, _ in scored])


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    return grid.search(grid.usable(vectors), is_query, k, encode, ["exact", "cell", "cut"], kernel(k), "long")
