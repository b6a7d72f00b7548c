"""Ranked lexical search: an inverted index in shards, searched by Block-Max MaxScore.

*Index.* A shard is a run of documents of one task; of each of its terms it has
one row of postings in blocks of ``BLOCK``, packed to the bytes they need. A
block keeps its largest frequencies by document length (the pairs that no other
one beats on both), so its exact largest score follows once the statistics of
the whole corpus are known, without unpacking it.

*Search.* Terms of the queries meet their postings, and every shard answers a
block of queries. With the k-th best score so far as threshold, the lists whose
bounds together stay below it are not essential: a document on these alone is
out. Blocks of essential lists that cannot reach the threshold with all other
bounds are skipped. What is left is completed from the other lists, largest
bound first, and dropped as soon as score, block maximum and the bounds of the
rest fall short, before the block is unpacked. A task's heaps and thresholds go
on from shard to shard; at the end the heaps of all tasks are merged. A document
is dropped only below the threshold, never at it, so ties are settled by doc_id
and the result is exact.

Postings are dealt by shard, so a term of a third of all documents is one row a
shard and never one task. Terms are told apart by 64-bit hashes inside a shard.

Null and empty texts have no terms and do not count as documents. Repeated rows
are documents of their own. Among equal scores a null doc_id comes last. A query
without terms, or whose terms occur nowhere, has no rows; queries that share an
item_id are answered one by one. Empty tables give no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from haplometh.llm.arrow import steps
from haplometh.llm.words import hashes
from haplometh.operators.ordering import numbered
from haplometh.storage import materialize

#: Bytes of text and documents of a shard (a text beyond is a shard of its own), postings of a block.
SHARD_BYTES, SHARD_DOCS, BLOCK = 8 << 20, 1 << 16, 128
#: Queries that a shard answers together, and parts among which the postings of a term are dealt when they meet the queries.
QUERIES, SALTS = 256, 16

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_IS_TERM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_HEAD = np.dtype([("first", "<i4"), ("last", "<i4"), ("n", "<i4"), ("at", "<i4"), ("peaks", "<i4"), ("wide", "u1"), ("tall", "u1")])
_PEAK = np.dtype([("tf", "<i8"), ("length", "<i8")])
#: Postings of a term in a shard; the row without a term holds the shard's document lengths (``peaks``), ids and their nulls.
INDEX = "shard long, term string, df long, tokens long, heads binary, peaks binary, data binary, ids array<long>"


def terms_of(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts joined in lower case, and start, end and text number of every term."""
    joined = b"\n".join(texts).lower()
    kind = np.zeros(len(joined) + 2, np.int8)
    kind[1:-1] = _IS_TERM[np.frombuffer(joined, np.uint8)]
    edge = np.diff(kind)
    start, end = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    return joined, start, end, np.searchsorted(begins, start, "right") - 1


def _byte_width(most: np.ndarray) -> np.ndarray:
    return np.select([most < 1 << 8, most < 1 << 16], [1, 2], 4)


def _put(out: np.ndarray, where: np.ndarray, width: np.ndarray, values: np.ndarray) -> None:
    for k in range(4):
        some = width > k
        out[where[some] + k] = (values[some] >> (8 * k)) & 255


def _slices(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Bytes of ``data`` cut at ``ends``."""
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def postings(texts: list[bytes]) -> tuple[np.ndarray, pa.RecordBatch]:
    """Terms in each text, and a row of packed postings for each term."""
    joined, start, end, owner = terms_of(texts)
    lengths = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    hashed = hashes(np.frombuffer(joined, np.uint8), start, end)
    order = np.argsort(hashed, kind="stable")
    hashed, owner = hashed[order], owner[order]
    new_term = np.concatenate(([True], hashed[1:] != hashed[:-1])) if len(hashed) else np.empty(0, bool)
    new_doc = new_term.copy()
    new_doc[1:] |= owner[1:] != owner[:-1]
    at = np.flatnonzero(new_doc)
    doc, tf = owner[at].astype(np.int64), np.diff(np.append(at, len(owner)))
    opens = np.flatnonzero(new_term[at])  # first posting of each term
    df = np.diff(np.append(opens, len(doc)))

    place = np.arange(len(doc)) - np.repeat(opens, df)
    head = place % BLOCK == 0
    block = np.cumsum(head) - 1
    first = np.flatnonzero(head)
    delta = np.where(head, 0, np.diff(doc, prepend=0))
    heads = np.zeros(len(first), _HEAD)
    sizes = np.diff(np.append(first, len(doc)))
    heads["first"], heads["n"] = doc[first], sizes
    heads["last"] = doc[first + sizes - 1]
    term_of_block = np.cumsum(new_term[at][first]) - 1
    first_block = np.flatnonzero(place[first] == 0)
    if len(first):
        wide, tall = _byte_width(np.maximum.reduceat(delta, first)), _byte_width(np.maximum.reduceat(tf, first))
    else:
        wide = tall = np.empty(0, np.int64)
    heads["wide"], heads["tall"] = wide, tall
    spans = sizes * (wide + tall)
    begins = np.cumsum(spans) - spans
    data = np.zeros(int(spans.sum()), np.uint8)
    inside = np.arange(len(doc)) - first[block] if len(first) else np.empty(0, np.int64)
    _put(data, begins[block] + inside * wide[block], wide[block], delta)
    _put(data, begins[block] + sizes[block] * wide[block] + inside * tall[block], tall[block], tf)
    heads["at"] = begins - begins[first_block][term_of_block]

    # Peaks: by ascending length, postings with more occurrences than all shorter documents of the block.
    rank = np.empty(len(texts), np.int64)
    rank[np.argsort(lengths, kind="stable")] = np.arange(len(texts))
    by_length = np.argsort(block * (len(texts) + 1) + rank[doc], kind="stable")
    level = block[by_length] * (int(tf.max(initial=0)) + 1) + tf[by_length]
    best = np.maximum.accumulate(level) if len(level) else level
    peak = by_length[np.concatenate(([True], level[1:] > best[:-1]))] if len(level) else by_length
    peaks = np.zeros(len(peak), _PEAK)
    peaks["tf"], peaks["length"] = tf[peak], lengths[doc[peak]]
    peak_from = np.searchsorted(block[peak], np.arange(len(first)))
    heads["peaks"] = peak_from - peak_from[first_block][term_of_block]

    block_ends = np.append(first_block[1:], len(first)) if len(first_block) else first_block
    named = order[at[opens]]
    words = pa.array([joined[a:b] for a, b in zip(start[named].tolist(), end[named].tolist(), strict=True)], pa.binary()).cast(pa.string())
    return lengths, pa.RecordBatch.from_arrays(
        [
            words,
            pa.array(df, pa.int64()),
            _slices(heads.view(np.uint8), block_ends * _HEAD.itemsize),
            _slices(peaks.view(np.uint8), np.append(peak_from, len(peak))[block_ends] * _PEAK.itemsize),
            _slices(data, np.append(begins, len(data))[block_ends]),
        ],
        names=["term", "df", "heads", "peaks", "data"],
    )


def index(docs: DataFrame) -> DataFrame:
    """The inverted index of ``docs`` (``doc_id``, ``text``), written to the shared folder; columns ``INDEX``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        ids: list[int | None] = []
        texts: list[bytes] = []
        held = 0

        def shard() -> Iterator[pa.RecordBatch]:
            lengths, rows = postings(texts)
            one = {"shard": [number], "term": [None], "df": [int((lengths > 0).sum())], "tokens": [int(lengths.sum())], "heads": [None], "peaks": [lengths.tobytes()], "data": [None], "ids": [ids]}
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(one.values(), kinds, strict=True)], names=list(one))
            for at in range(0, rows.num_rows, 4096):
                some = rows.slice(at, 4096)
                n = some.num_rows
                columns = [pa.array(np.full(n, number), pa.int64()), some.column("term"), some.column("df"), pa.array(np.zeros(n, np.int64)), some.column("heads"), some.column("peaks"), some.column("data"), pa.nulls(n, kinds[-1])]
                yield pa.RecordBatch.from_arrays(columns, names=list(one))

        for batch in batches:
            for step in steps(batch, "text", SHARD_BYTES):
                size = step.column("text").nbytes
                if texts and (held + size > SHARD_BYTES or len(texts) + step.num_rows > SHARD_DOCS):
                    yield from shard()
                    number, ids, texts, held = number + 1, [], [], 0
                ids += step.column("doc_id").to_pylist()
                texts += [(t or "").encode() for t in step.column("text").to_pylist()]
                held += size
        if texts:
            yield from shard()

    return materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, INDEX), "lexical-index")


# Scoring.


@dataclass
class Statistics:
    """Documents with a term, and terms, of the whole corpus."""

    docs: int
    tokens: int

    def norm(self, lengths: np.ndarray) -> np.ndarray:
        return 25 + (75 * lengths * self.docs) // self.tokens


def impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * norm)


@dataclass
class List:
    """A term's postings in a shard, with the exact bound of every block."""

    weight: int
    heads: np.ndarray
    data: bytes
    norm: np.ndarray
    bounds: np.ndarray
    opened: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    @classmethod
    def of(cls, weight: int, heads: bytes, peaks: bytes, data: bytes, norm: np.ndarray, told: Statistics) -> List:
        blocks, peak = np.frombuffer(heads, _HEAD), np.frombuffer(peaks, _PEAK)
        most = np.maximum.reduceat(impact(peak["tf"], told.norm(peak["length"])), blocks["peaks"])
        return cls(weight, blocks, data, norm, weight * most)

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of a block, unpacked."""
        if b not in self.opened:
            head = self.heads[b]
            n, at, wide, tall = (int(head[c]) for c in ("n", "at", "wide", "tall"))
            doc = int(head["first"]) + np.cumsum(np.frombuffer(self.data, f"<u{wide}", n, at), dtype=np.int64)
            tf = np.frombuffer(self.data, f"<u{tall}", n, at + n * wide).astype(np.int64)
            self.opened[b] = doc, self.weight * impact(tf, self.norm[doc])
        return self.opened[b]

    def blocks(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.block(int(b)) for b in which]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


class Heap:
    """The best documents of one query so far."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.unnamed, self.doc = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)

    @property
    def threshold(self) -> int:
        """A score below this is out."""
        return max(1, int(self.score[-1]) if len(self.score) == self.k else 1)

    def add(self, score: np.ndarray, unnamed: np.ndarray, doc: np.ndarray) -> None:
        score, unnamed, doc = np.append(self.score, score), np.append(self.unnamed, unnamed), np.append(self.doc, doc)
        best = np.lexsort((doc, unnamed, -score))[: self.k]
        self.score, self.unnamed, self.doc = score[best], unnamed[best], doc[best]


def best_of_shard(lists: list[tuple[List, int]], n_docs: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the documents that reach ``threshold``; ``lists`` with how often the query has the term."""
    lists = sorted(lists, key=lambda x: int(x[0].bounds.max()) * x[1])
    upper = np.array([int(l.bounds.max()) * times for l, times in lists], np.int64)
    below = np.concatenate(([0], np.cumsum(upper)))  # bound of all lists before
    essential = int(np.searchsorted(below[1:], threshold))  # all before together stay under the threshold
    score = np.zeros(n_docs, np.int64)
    for (own, times), bound in zip(lists[essential:], upper[essential:], strict=True):
        able = np.flatnonzero(own.bounds * times + (below[-1] - bound) >= threshold)
        if len(able):
            doc, gain = own.blocks(able)
            score[doc] += gain * times
    found = np.flatnonzero(score)
    for i in range(essential - 1, -1, -1):
        own, times = lists[i]
        found = found[score[found] + below[i + 1] >= threshold]
        block = np.minimum(np.searchsorted(own.heads["last"], found), len(own.heads) - 1)
        held = (own.heads["first"][block] <= found) & (found <= own.heads["last"][block])
        able = score[found] + np.where(held, own.bounds[block] * times, 0) + below[i] >= threshold
        found, block, held = found[able], block[able], held[able]
        if held.any():
            doc, gain = own.blocks(np.unique(block[held]))
            at = np.minimum(np.searchsorted(doc, found), len(doc) - 1)
            score[found] += np.where(doc[at] == found, gain[at] * times, 0)
    found = found[score[found] >= threshold]
    return found, score[found]


def search(built: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the ``k`` best documents of each row of ``queries`` (``item_id``, ``text``)."""
    n, length = built.filter("term is null").agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).collect()[0]
    told = Statistics(int(n), max(1, int(length)))
    items = materialize(numbered(queries.select("item_id", "text"), ["item_id", "text"], "item"), "lexical-items")
    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    wanted = items.select("item", F.explode(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))).alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))
    wanted = materialize(wanted, "lexical-terms")
    listed = built.filter("term is not null")
    df = listed.select("term", "df").join(wanted.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("all"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * told.docs + 2)) / (2 * F.col("all") + 1).cast("double"))).cast("long")
    # at most QUERIES uses of a term in a block of queries
    uses = wanted.groupBy(F.floor(F.col("item") / QUERIES).cast("int").alias("part"), "term").agg(F.collect_list(F.struct("item", "times")).alias("uses"))
    asked = materialize(uses.join(df.select("term", weight.alias("weight")), "term"), "lexical-asked")
    salted = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = listed.withColumn("salt", F.pmod(F.xxhash64("shard"), F.lit(SALTS)).cast("int")).join(salted, ["term", "salt"])
    columns = ["part", "shard", "weight", "uses", "heads", "peaks", "data", "ids"]
    parts = F.explode(F.sequence(F.lit(0), F.lit(max(0, -(-items.count() // QUERIES) - 1))))
    shards = built.filter("term is null").withColumn("part", parts).withColumns({"weight": F.lit(None).cast("long"), "uses": F.lit(None).cast(asked.schema["uses"].dataType)})
    rows = shards.select(*columns).unionByName(met.select(*columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, heaps = None, {}
        lists: list[tuple[List, list]] = []
        ids, unnamed, norm = None, None, None

        def answer() -> None:
            of: dict[int, list] = {}
            for own, used in lists:
                for use in used:
                    of.setdefault(use["item"], []).append((own, use["times"]))
            for item, own in of.items():
                heap = heaps.setdefault(item, Heap(k))
                found, score = best_of_shard(own, len(ids), heap.threshold)
                if len(found):
                    heap.add(score, unnamed[found], ids[found])

        def told_heaps() -> pa.RecordBatch:
            items = [i for i, h in heaps.items() for _ in h.doc]
            docs = [None if u else int(d) for h in heaps.values() for d, u in zip(h.doc, h.unnamed, strict=True)]
            scores = [int(s) for h in heaps.values() for s in h.score]
            return pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())], names=["item", "doc_id", "score"])

        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at] for c in columns}
                weight = row["weight"].as_py()
                if weight is None:  # a shard begins
                    if lists:
                        answer()
                    lists = []
                    if row["part"].as_py() != part:
                        if heaps:
                            yield told_heaps()
                        part, heaps = row["part"].as_py(), {}
                    own = row["ids"].values
                    unnamed = own.is_null().to_numpy(zero_copy_only=False)
                    ids = own.fill_null(0).to_numpy(zero_copy_only=False)
                    norm = told.norm(np.frombuffer(row["peaks"].as_buffer(), np.int64))
                else:
                    lists.append((List.of(weight, row["heads"].as_py(), row["peaks"].as_py(), row["data"].as_py(), norm, told), row["uses"].as_py()))
        if lists:
            answer()
        if heaps:
            yield told_heaps()

    dealt = rows.repartition("part", "shard").sortWithinPartitions("part", "shard", F.col("weight").asc_nulls_first())
    heaps = dealt.select(*columns).mapInArrow(run, "item long, doc_id long, score long")
    # at most k rows of a query from each task, and again from each task of the merge
    turn = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = heaps.withColumn("rank", F.row_number().over(turn)).filter(F.col("rank") <= k)
    return best.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
