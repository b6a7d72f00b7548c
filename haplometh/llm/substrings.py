"""Removing passages that repeat anywhere, found by difference-cover anchors.

A window of ``SIZE`` words is repeated when its words also start at another
place, in the same document or not; words under such windows go. Of any two
equal windows some offset puts both at places of a difference cover modulo
``PERIOD``, so it is enough to hash the ``SIZE - PERIOD + 1`` words at cover
places: if an anchor occurs once in the corpus, no window over it at that offset
repeats. Only windows around repeated anchors are extended to full length and
compared in a second exchange, which decides exactly (by 64-bit hashes).

Texts travel in packed blocks and repeats are found by ``blocks``' exchange, so a
hot passage costs one hash a block.

Null and empty texts have no words. Repeated rows are documents of their own
(so they repeat each other); ``doc_id`` may be null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from haplometh.llm.blocks import SENT, answered, answers, bits, blocks, ranges_for, rows_to_send, unpacked
from haplometh.llm.words import Words, mixed, rolling, words
from haplometh.storage import materialize

SIZE, PERIOD = 35, 21
#: A difference cover modulo 21; every difference occurs.
COVER = (0, 1, 6, 8, 18)
ANCHOR = SIZE - PERIOD + 1


class Block:
    """The windows of a block's documents that do not cross from one document to the next."""

    def __init__(self, ids, texts: bytes):
        self.words: Words = words(unpacked(ids, texts))
        first, n = self.words.first, len(self.words.hash)
        self.left = np.repeat(first[1:], np.diff(first)) - np.arange(n)  # words from here to the document's end
        self.at = np.arange(n) - np.repeat(first[:-1], np.diff(first))

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the anchors, and their hashes."""
        hashed = rolling(self.words.hash, ANCHOR)
        cover = np.isin(np.arange(PERIOD), COVER)
        places = np.flatnonzero(cover[self.at[: len(hashed)] % PERIOD] & (self.left[: len(hashed)] >= ANCHOR))
        return places, hashed[places]

    def windows(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the windows that hold one of the ``anchors`` within their first words, and their hashes."""
        n = len(self.words.hash)
        near = np.zeros(n + 1, np.int64)
        np.add.at(near, np.maximum(anchors - (PERIOD - 1), anchors - self.at[anchors]), 1)
        np.add.at(near, anchors + 1, -1)
        hashed = rolling(self.words.hash, SIZE)
        places = np.flatnonzero((np.cumsum(near)[: len(hashed)] > 0) & (self.left[: len(hashed)] >= SIZE))
        return places, mixed(hashed[places])

    def covered(self, windows: np.ndarray) -> np.ndarray:
        """Which words are under the windows at these places."""
        edge = np.zeros(len(self.words.hash) + 1, np.int64)
        np.add.at(edge, windows, 1)
        np.add.at(edge, windows + SIZE, -1)
        return np.cumsum(edge)[:-1] > 0


def deduplicate(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_text`` (kept words joined by a space) of every row."""
    packed = blocks(docs)
    ranges = ranges_for(packed, 0.05)  # a quarter of the words, of five letters or so

    def anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, texts in zip(*(batch.column(c) for c in ("block", "ids", "texts")), strict=True):
                _, hashes = Block(ids, texts.as_py()).anchors()
                yield from rows_to_send(block.as_py(), hashes, ranges)

    anchors = answers(packed.select("block", "ids", "texts").mapInArrow(anchor_rows, SENT), "anchors")
    anchors = materialize(anchors, "substring-anchors")

    def window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, texts, told in zip(*(batch.column(c) for c in ("block", "ids", "texts", "anchors")), strict=True):
                b = Block(ids, texts.as_py())
                places, hashes = b.anchors()
                repeated = places[answered(hashes, ranges, bits(told.as_py()))]
                yield from rows_to_send(block.as_py(), b.windows(repeated)[1], ranges)

    with_anchors = packed.join(anchors, "block", "left")
    windows = answers(with_anchors.select("block", "ids", "texts", "anchors").mapInArrow(window_rows, SENT), "windows")
    windows = materialize(windows, "substring-windows")

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts, told, full in zip(*(batch.column(c) for c in ("ids", "texts", "anchors", "windows")), strict=True):
                b = Block(ids, texts.as_py())
                places, hashes = b.anchors()
                spots, hashes = b.windows(places[answered(hashes, ranges, bits(told.as_py()))])
                gone = b.covered(spots[answered(hashes, ranges, bits(full.as_py()))])
                w, kept = b.words, ~gone
                spans = list(zip(w.start.tolist(), w.end.tolist(), strict=True))
                texts_kept = []
                for a, z in zip(w.first[:-1], w.first[1:], strict=True):
                    texts_kept.append(b" ".join([w.buffer[s:e] for (s, e), k in zip(spans[a:z], kept[a:z].tolist(), strict=True) if k]))
                n = np.diff(w.first)
                removed = np.diff(np.concatenate(([0], np.cumsum(gone)))[w.first])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids.as_py(), pa.int64()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts_kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_text"],
                )

    final = with_anchors.join(windows, "block", "left").select("ids", "texts", "anchors", "windows")
    return final.mapInArrow(results, "doc_id long, n_words long, n_removed long, kept_text string")
