"""Near-duplicate texts: an exact join by Jaccard similarity in metric regions.

A text is the set of its word shingles; distance is one less the similarity,
which is a metric. Equal sets are folded into classes first. Then:

*Cells.* Almost all texts are at distance 1 from each other, where no pivot
tells anything apart. So the space is first cut by projections: at a level of
sizes whose sets can differ in at most d shingles, shingles are dealt into more
than d parts by hash, and two similar sets must agree on some part. A part that
occurs once in the corpus is dropped (the exchange of ``blocks``), the rest are
cells. Parts with hardly a shingle are left out when a set has few enough of
them that another part must agree. An empty part says nothing and is never a
cell: sets with so many of them that two could agree on these alone also send
their first shingles in the order of hashes, of which similar sets share one.
Where a level allows no difference the set is one part, and its cell one class.

*Regions.* The smallest class of a cell is its pivot; the cells of a pivot make
its region, and a class stands in the region of every pivot that it meets, so
any two similar sets meet in a region.

*Parting a region.* Each set has a sketch: the parity of its shingles in a few
hundred hash places. The distance between two sketches is at most the number of
shingles in which the sets differ, so sets that are connected by no steps short
enough for similar sets are parted before any set is sent, and sets are fetched
only for classes that are still with another one.

*Joining a region.* Pivots are taken from the region and all distances to them
computed. Each set belongs to the nearest pivot and is copied to the regions of
those that are at most two thresholds further: by the triangle inequality no
similar pair is torn apart. Regions are joined again in the same way until they
are small or no longer shrink; there, a set is compared unless it was a pivot, or
every set within a threshold of its own distance to the pivot is in its
component already.

A region beyond ``REGION_SHINGLES`` is cut into slices and each pair of slices
joined, so a task's memory is bounded whatever the region. Links go to
``components``; no link between different sets is lost.

Null, empty and blank texts have an empty set and are linked with nothing; a
text with fewer words than a shingle is one shingle. Repeated rows are rows of
one class. A null doc_id is never the name of a component unless all its rows
have one. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haplometh.llm import blocks
from haplometh.llm.arrow import frugal
from haplometh.llm.components import connected
from haplometh.llm.words import mixed, shingles, words
from haplometh.storage import materialize

#: Steps of the size levels, spare parts of a level, and shingles in a part that may be left out.
STEP, SPARE, POOR = 1.25, 0.3, 1
#: Shingles of a region, or of two slices of one, that are joined in one task.
REGION_SHINGLES = 1 << 22
#: Pivots of a region, and sets of a region that is a pair and needs none.
PIVOTS, LEAF = 12, 2
#: Sets of a region that are parted by their sketches; larger regions stay whole.
PARTED = 8192
#: Smallest and largest number of places in a sketch (a power of two near the set's size).
PLACES = (256, 1 << 16)
#: Bytes of a shingle's hash in a region.
HASH_BYTES = 6


def sets_of(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, in order."""
    w = words(texts, fold=True)
    whole = shingles(w.hash, size)
    out = []
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        n = b - a
        own = whole[a : b - size + 1] if n >= size else shingles(w.hash[a:b], n) if n else np.empty(0, np.uint64)
        out.append(np.unique(own))
    return out


def class_of(own: np.ndarray) -> bytes:
    """Sixteen bytes that stand for the set."""
    return np.array([mixed(own).sum(dtype=np.uint64), mixed(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(own))], np.uint64).tobytes()


def levels(n: int, percent: int) -> list[tuple[int, int]]:
    """Levels at which a set of ``n`` is cut, each with the most shingles in which similar sets differ there.

    From its own level to that of the largest set that can be similar.
    """
    own = int(math.log(n) / math.log(STEP) + 1e-9)
    out = []
    for level in itertools.count(own):
        if level > own and n * 100 < percent * math.ceil(STEP**level):
            break  # no similar set is that large
        most = math.ceil(STEP ** (level + 1)) - 1
        differ = 2 * most * (100 - percent) // (100 + percent)
        out.append((level, differ))
    return out


def signatures(own: np.ndarray, percent: int) -> np.ndarray:
    """A hash for each part of the set that stands for it in the join."""
    found, bare = [], False
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(own))))
    for level, differ in levels(len(own), percent) if len(own) else []:
        spare = max(1, int(differ * SPARE)) if differ else 0
        parts = differ + 1 + spare
        part = ((own >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        ends = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
        content = sums[ends[1:]] - sums[ends[:-1]]
        names = mixed(np.arange(parts, dtype=np.uint64) + np.uint64(level << 32))
        filled, rich = np.diff(ends) > 0, np.diff(ends) > POOR
        keep = rich if (~rich).sum() <= spare else filled
        bare |= bool((~filled).sum() > spare)  # more than ``spare`` parts agree, perhaps empty ones alone
        found.append(mixed(content + names)[keep])
    if bare:
        found.append(mixed(own[: len(own) * (100 - percent) // 100 + 1] ^ np.uint64(0x5851F42D4C957F2D)))
    return np.concatenate(found) if found else np.empty(0, np.uint64)


# Sketches.


def sketch(own: np.ndarray) -> bytes:
    """The parity of the set's shingles in each place, packed."""
    places = min(max(PLACES[0], 1 << max(0, len(own) - 1).bit_length()), PLACES[1])
    counts = np.bincount((own & np.uint64(places - 1)).astype(np.int64), minlength=places)
    return np.packbits(counts & 1).tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """The sketches at the size of the smallest, as rows of words: halves of a sketch add up to a smaller one."""
    size = min(map(len, sketches))
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, size // 8), axis=0) for x in sketches])


def parts_of(sketches: list[bytes], sizes: np.ndarray, percent: int) -> np.ndarray:
    """For each set of a region, the number of its part: similar sets are always in the same one."""
    rows, label = folded(sketches), np.arange(len(sizes))
    step = max(1, (1 << 21) // rows.size)
    for at in range(0, len(rows), step):
        apart = np.bitwise_count(rows[at : at + step, None] ^ rows).sum(axis=2, dtype=np.int64)
        near = apart * (100 + percent) <= (sizes[at : at + step, None] + sizes) * (100 - percent)
        for i in np.flatnonzero(near.sum(axis=1) > 1):  # each is near itself
            for other in np.unique(label[near[i]]):
                if other != label[at + i]:
                    label[label == other] = label[at + i]
    return label


# Inside a region.


class Region:
    """Sets that are joined in one task; ``links`` is a spanning forest of the similar pairs found."""

    def __init__(self, own: list[np.ndarray], percent: int):
        self.percent, self.reach = percent, 1 - percent / 100 + 1e-9
        self.size = np.array([len(s) for s in own])
        m = len(own)
        _, term, counts = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        doc = np.repeat(np.arange(m), self.size)
        shared = counts[term] > 1
        term, doc = term[shared], doc[shared]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=m))))
        self.term = term
        order = np.argsort(term, kind="stable")
        self.holders = doc[order]
        self.held = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=len(counts)))))
        self.label, self.met = np.arange(m), np.zeros(m, bool)
        self.links: list[tuple[int, int]] = []

    def distances(self, i: int) -> np.ndarray:
        """From set ``i`` to all; similar sets are linked on the way."""
        self.met[i] = True
        terms = self.term[self.first[i] : self.first[i + 1]]
        start, sizes = self.held[terms], self.held[terms + 1] - self.held[terms]
        where = np.repeat(start - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        common = np.bincount(self.holders[where], minlength=len(self.size))
        union = self.size[i] + self.size - common
        for j in np.flatnonzero(100 * common >= self.percent * union):
            if self.label[j] != self.label[i]:
                self.links.append((i, int(j)))
                self.label[self.label == self.label[j]] = self.label[i]
        return 1 - common / np.maximum(union, 1)

    def join(self, ids: np.ndarray) -> None:
        if len(ids) < 2 or (self.label[ids] == self.label[ids[0]]).all():
            return
        if len(ids) <= LEAF:
            self.compare(ids, ids, np.zeros(len(self.size)))
            return
        pivots = ids[:: -(-len(ids) // PIVOTS)]
        far = np.stack([self.distances(int(p)) for p in pivots])
        nearest = far[:, ids].argmin(axis=0)
        limit = far[:, ids].min(axis=0) + 2 * self.reach
        for k in range(len(pivots)):
            inside, region = ids[nearest == k], ids[far[k, ids] <= limit]
            if len(region) <= 0.7 * len(ids):
                self.join(region)
            else:
                self.compare(inside, region, far[k])

    def compare(self, inside: np.ndarray, region: np.ndarray, far: np.ndarray) -> None:
        for i in inside[~self.met[inside]]:
            apart = self.label[region] != self.label[i]
            if (np.abs(far[region[apart]] - far[i]) <= self.reach).any():
                self.distances(int(i))


def link_region(own: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    region = Region(own, percent)
    region.join(np.argsort(region.size, kind="stable"))
    return region.links


def packed_hashes(own: np.ndarray) -> bytes:
    return own.view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()


def unpacked_hashes(raw) -> np.ndarray:
    rows = np.frombuffer(raw, np.uint8).reshape(-1, HASH_BYTES)
    out = np.zeros((len(rows), 8), np.uint8)
    out[:, :HASH_BYTES] = rows
    return out.view(np.uint64).ravel()


# The join.


def components(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row.

    Rows are linked when a hundred times their common ``size``-word shingles
    are at least ``percent`` times all shingles of both.
    """
    _, members, names = classified(blocks.blocks(docs), size, percent)
    rows = members.join(names, "class", "left")
    return rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("named")).otherwise(F.col("doc_id")).alias("component_id"))


def representatives(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """One row of each component of ``docs``, with all columns: one with the smallest doc_id.

    Rows with an empty set are alone in theirs and stay. Of repeated rows one stays.
    """
    packed, members, names = classified(blocks.blocks(docs, rows=True), size, percent)
    rows = members.filter("n_shingles > 0").join(names, "class")
    # the row of a component that carries its name; a component is known by its label
    first = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "block", "place")).alias("at"))
    kept = first.select("at.block", "at.place").unionByName(members.filter("n_shingles = 0").select("block", "place"))
    return blocks.chosen_rows(packed, kept, docs)


def classified(packed: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The blocks, a row for each document (``members``), and each class's ``label`` and ``named`` doc_id."""
    if not 1 <= percent <= 100:
        raise ValueError(f"no similarity of {percent} percent")
    ranges = blocks.ranges_for(packed, 0.08)

    def member_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, texts in zip(*(batch.column(c) for c in ("block", "ids", "texts")), strict=True):
                own = sets_of(blocks.unpacked(ids, texts.as_py()), size)
                names = [class_of(s) for s in own]
                first = {name: i for i, name in reversed(list(enumerate(names)))}
                drawn = [sketch(s) if len(s) and first[name] == i else None for i, (name, s) in enumerate(zip(names, own, strict=True))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.as_py()] * len(own), pa.int64()), pa.array(range(len(own)), pa.int32()), pa.array(ids.as_py(), pa.int64()), pa.array([len(s) for s in own], pa.int64()), pa.array(names, pa.binary()), pa.array(drawn, pa.binary())],
                    names=["block", "place", "doc_id", "n_shingles", "class", "sketch"],
                )

    bare = packed.select("block", "ids", "texts")
    members = materialize(bare.mapInArrow(frugal(member_rows), "block long, place int, doc_id long, n_shingles long, class binary, sketch binary"), "jaccard-members")

    def signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, texts in zip(*(batch.column(c) for c in ("block", "ids", "texts")), strict=True):
                distinct = {class_of(s): s for s in sets_of(blocks.unpacked(ids, texts.as_py()), size)}
                found = [signatures(s, percent) for s in distinct.values()]
                yield from blocks.rows_to_send(block.as_py(), np.concatenate(found or [np.empty(0, np.uint64)]), ranges)

    repeated = materialize(blocks.answers(bare.mapInArrow(frugal(signature_rows), blocks.SENT), "told"), "jaccard-repeated")

    def cell_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts, told in zip(*(batch.column(c) for c in ("ids", "texts", "told")), strict=True):
                distinct = {class_of(s): s for s in sets_of(blocks.unpacked(ids, texts.as_py()), size)}
                found = [signatures(s, percent) for s in distinct.values()]
                if not found:
                    continue
                every = np.concatenate(found)
                again = blocks.answered(every, ranges, blocks.bits(told.as_py()))
                owner = np.repeat(np.arange(len(found)), [len(f) for f in found])[again]
                names, counts = list(distinct), [len(s) for s in distinct.values()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(every[again].view(np.int64)), pa.array([names[i] for i in owner], pa.binary()), pa.array([counts[i] for i in owner], pa.int64())], names=["cell", "class", "n"]
                )

    cells = packed.join(repeated, "block", "left").select("ids", "texts", "told").mapInArrow(frugal(cell_rows), "cell long, class binary, n long")
    cells = materialize(cells.distinct(), "jaccard-cells")
    pivots = cells.groupBy("cell").agg(F.min("class").alias("pivot"), F.count("*").alias("held")).filter("held > 1").drop("held")
    meets = materialize(cells.join(pivots, "cell").select("pivot", "class", "n").distinct(), "jaccard-regions")
    drawn = members.filter("sketch is not null").select("class", "sketch").join(meets.select("class").distinct(), "class", "left_semi")
    drawn = materialize(drawn.groupBy("class").agg(F.first("sketch").alias("sketch")), "jaccard-sketches")
    near = materialize(parted(meets, drawn, percent), "jaccard-parts")
    sets = materialize(sets_by_class(packed, members, near, size), "jaccard-sets")
    links = materialize(link(near, sets, percent), "jaccard-links")
    return packed, members, named(members, connected(links))


def sets_by_class(packed: DataFrame, members: DataFrame, meets: DataFrame, size: int) -> DataFrame:
    """``class`` and its packed ``hashes``, for the classes in ``meets``, read from one row of each."""
    wanted = members.join(meets.select("class").distinct(), "class", "left_semi").groupBy("class").agg(F.min(F.struct("block", "place")).alias("at"))
    listed = wanted.select("class", "at.*").groupBy("block").agg(F.collect_list(F.struct("place", "class")).alias("wanted"))  # at most a block's documents

    def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts, chosen in zip(*(batch.column(c) for c in ("ids", "texts", "wanted")), strict=True):
                all_texts, chosen = blocks.unpacked(ids, texts.as_py()), chosen.as_py()
                own = sets_of([all_texts[x["place"]] for x in chosen], size)
                for at in range(0, len(own), 256):
                    some = slice(at, at + 256)
                    yield pa.RecordBatch.from_arrays([pa.array([x["class"] for x in chosen[some]], pa.binary()), pa.array([packed_hashes(s) for s in own[some]], pa.binary())], names=["class", "hashes"])

    return packed.join(listed, "block").select("ids", "texts", "wanted").mapInArrow(frugal(set_rows), "class binary, hashes binary")


def parted(meets: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """``meets`` with the ``part`` of each class in its region, by ``sketches``; classes alone in theirs are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, held, whole = None, [], False

        def rows(held: list, label: np.ndarray) -> pa.RecordBatch:
            _, number, counts = np.unique(label, return_inverse=True, return_counts=True)
            some = [(pivot, int(part), name, n) for part, (name, n, _) in zip(number, held, strict=True) if whole or counts[part] > 1]
            kinds = (pa.binary(), pa.int32(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in some], k) for i, k in enumerate(kinds)], names=["pivot", "part", "class", "n"])

        def done() -> pa.RecordBatch:
            return rows(held, np.zeros(len(held), int) if whole else parts_of([h[2] for h in held], np.array([h[1] for h in held]), percent))

        for batch in batches:
            for key, name, n, drawn in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != pivot:
                    if held:
                        yield done()
                    pivot, held, whole = key, [], False
                held.append((name, n, drawn))
                if len(held) > PARTED:
                    whole = True  # and so is what follows of this region
                    yield done()
                    held = []
        if held:
            yield done()

    near = meets.join(sketches, "class").select("pivot", "class", "n", "sketch")
    return near.repartition("pivot").sortWithinPartitions("pivot").mapInArrow(frugal(run), "pivot binary, part int, class binary, n long")


def link(meets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a``, ``b`` between classes: a spanning forest of the similar pairs of each part of a region."""
    slices = meets.groupBy("pivot", "part").agg(F.ceil(2 * F.sum("n") / REGION_SHINGLES).cast("int").alias("slices"))
    cut = meets.join(slices.filter("slices > 2"), ["pivot", "part"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    own = F.pmod(F.xxhash64("class"), F.col("slices")).cast("int")
    cut = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    rows = cut.select("pivot", "part", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "class").join(sets.select("class", "hashes"), "class")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, own = None, [], []

        def joined() -> pa.RecordBatch:
            found = link_region(own, percent)
            return pa.RecordBatch.from_arrays([pa.array([names[x[s]] for x in found], pa.binary()) for s in (0, 1)], names=["a", "b"])

        for batch in batches:
            for *place, name, hashes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place != key:
                    if len(own) > 1:
                        yield joined()
                    key, names, own = place, [], []
                names.append(name)
                own.append(unpacked_hashes(hashes))
        if len(own) > 1:
            yield joined()

    region = ["pivot", "part", "i", "j"]
    dealt = rows.select(*region, "class", "hashes").repartition(*region).sortWithinPartitions(*region)
    return dealt.mapInArrow(frugal(run), "a binary, b binary")


def named(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``class``, the ``label`` of its component, and the smallest doc_id there (``named``)."""
    classes = members.filter("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("first"))
    labelled = labels.select(F.col("node").alias("class"), "label").join(classes, "class")
    smallest = labelled.groupBy("label").agg(F.min("first").alias("least"))
    linked = labelled.join(smallest, "label").select("class", "label", "least")
    return materialize(classes.join(linked, "class", "left").select("class", F.coalesce("label", "class").alias("label"), F.coalesce("least", "first").alias("named")), "jaccard-names")
