"""Nearest neighbours by inner product from tiles of int8 products.

Each vector is rounded to int8 with a scale of its own; the norms of what is
kept and of what is lost bound the error of a product of two rounded vectors.
A tile of whole-number products then gives an interval for every pair; pairs
whose interval reaches the kth lower end are computed again in double
precision, term by term in order, and heaps merge the blocks. The bounds are
certain, so the result is the exact one; a pair whose bound overflows (very
large components) is computed again whatever its bound. A score that overflows
is infinite.

Zero vectors take no part; for the rest see ``grid``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame

from haplometh.llm import grid

#: Relative room for the rounding of the bounds themselves.
SLACK = 1e-9
#: Widest vectors whose int8 products are exact in single precision (127 * 127 * width < 2 ** 24).
SINGLE = 1040


def encode(ids: np.ndarray, x: np.ndarray) -> dict[str, bytes]:
    top = np.abs(x).max(axis=1, initial=0.0)
    scale = np.where(top > 0, top, 1.0) / 127.0
    scale = np.where(scale > 0, scale, np.finfo(float).tiny)
    whole = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
    kept = whole * scale[:, None]
    norms = np.stack([scale, *(np.linalg.norm(y, axis=1) for y in (kept, x - kept, x))])
    return {"exact": x.tobytes(), "small": whole.tobytes(), "norm": norms.tobytes()}


def kernel(k: int) -> grid.Kernel:
    def near(q_ids: np.ndarray, q: dict, c_ids: np.ndarray, c: dict) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        x, y = (np.frombuffer(s["exact"]).reshape(len(i), -1) for s, i in ((q, q_ids), (c, c_ids)))
        a, b = (np.frombuffer(s["small"], np.int8).reshape(len(i), -1) for s, i in ((q, q_ids), (c, c_ids)))
        (_, _, lost_q, norm_q), (_, kept_c, lost_c, _) = norms = [np.frombuffer(s["norm"]).reshape(4, -1) for s in (q, c)]
        width = min(a.shape[1], b.shape[1])
        kind = np.float32 if width <= SINGLE else np.float64
        right = b[:, :width].astype(kind).T
        for at in range(0, len(q_ids), grid.TILE):
            rows = slice(at, at + grid.TILE)
            about = (a[rows, :width].astype(kind) @ right).astype(np.float64)
            about *= norms[0][0][rows, None]
            about *= norms[1][0]
            room = lost_q[rows, None] * kept_c + norm_q[rows, None] * lost_c
            room += SLACK * (norm_q[rows, None] * (kept_c + lost_c))
            own = q_ids[rows, None] == c_ids
            # products of very large components: no bound, so the pair goes to the exact score
            wild = ~(np.isfinite(about) & np.isfinite(room))
            about[wild], room[wild] = 0.0, np.inf
            least = np.where(own, -np.inf, about - room)
            floor = np.partition(least, -k, axis=1)[:, -k] if len(c_ids) > k else np.full(len(about), -np.inf)
            i, j = np.nonzero((about + room >= floor[:, None]) & ~own)
            score = np.zeros(len(i))
            for d in range(width):
                score += x[at + i, d] * y[j, d]
            ends = np.searchsorted(i, np.arange(len(about) + 1))
            for t in range(len(about)):
                part = slice(ends[t], ends[t + 1])
                keep = grid.best_rows(score[part], c_ids[j[part]], k)
                if len(keep):
                    yield int(q_ids[at + t]), c_ids[j[part]][keep], score[part][keep]

    return near


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    return grid.search(grid.usable(vectors, zero=False), is_query, k, encode, ["exact", "small", "norm"], kernel(k), "double")
