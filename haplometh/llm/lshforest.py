"""Near-duplicate texts by an LSH forest: sorted orders of MinHash signatures, confirmed on full shingle sets.

Equal shingle sets are one class. A class has ``TREES`` signatures of ``DEEP``
min-hashes; two sets of similarity s agree in the first d of a tree with
probability s^d.

*Orders.* In the sorted order of a tree, classes with a common prefix stand
together: a region. A class is a candidate where its longest common prefix with
another one has ``LEAST`` values at least.

*Adaptive depth.* A region of more than ``WIDE`` classes is divided by the next
value, down to ``DEEP``, so depth follows density. What is still larger there
is not searched for the best neighbours but taken as candidates of each other
as a whole, so no candidate is dropped.

*Inside a region* neighbours in the sorted order are compared first, then what
they left apart: the share of equal min-hashes of all trees estimates the
similarity, and sets estimated far below the threshold (``MARGIN``) part. Only
a spanning forest of the near ones leaves the task, never all pairs.

*Confirming.* The candidates' components get each set once and are joined
exactly; only links with enough common shingles count.

At the threshold of 0.8 a pair meets nowhere with probability
(1 - 0.8^3)^24 = 3e-8, in regions divided down to ``DEEP`` everywhere 7e-5, and
an estimate is six standard deviations off with probability 1e-9; links to
others of the same component come on top. So links are found almost surely, and
none is reported that is not one (but for hashes of 64 bits that collide).

Null, empty and blank texts have an empty set and are linked with nothing; a
text with fewer words than a shingle is one shingle. Repeated rows are rows of
one class. A null doc_id is never the name of a component unless all its rows
have one. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haplometh.llm import blocks
from haplometh.llm.components import connected
from haplometh.llm.jaccard import class_of, link, named, sets_by_class, sets_of
from haplometh.llm.words import mixed
from haplometh.storage import materialize

#: Sorted orders, and the smallest and largest length of a common prefix that makes a region.
TREES, LEAST, DEEP = 24, 3, 5
#: Classes of a region that are compared in one task.
WIDE = 4096
#: How far below the threshold an estimated similarity may lie: six standard deviations of the share of equal min-hashes.
MARGIN = 6 * (0.8 * 0.2 / (TREES * DEEP)) ** 0.5
#: Bytes of a min-hash in a signature; the estimate uses the last one of each.
WIDTH = 2
_FACTORS = mixed(np.arange(1, TREES * DEEP + 1, dtype=np.uint64)) | np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``TREES * DEEP`` min-hashes for each set, none of them empty."""
    every = np.concatenate(sets)
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), len(_FACTORS)), ">u2")
    for k, factor in enumerate(_FACTORS):
        out[:, k] = mixed(np.minimum.reduceat(every * factor, first)) >> np.uint64(48)
    return out


def near_parts(drawn: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of rows that connect all rows whose estimates are near; ``drawn`` in the region's order."""
    enough = (percent / 100 - MARGIN) * drawn.shape[1]
    label, pairs = np.arange(len(drawn)), []

    def tie(i: int, j: int) -> None:
        if label[i] != label[j]:
            pairs.append((i, j))
            label[label == label[j]] = label[i]

    for i in np.flatnonzero((drawn[1:] == drawn[:-1]).sum(axis=1) >= enough):
        tie(int(i), int(i) + 1)
    for i in range(len(drawn)):
        others = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
        for j in others[(drawn[others] == drawn[i]).sum(axis=1) >= enough]:
            tie(i, int(j))
    return pairs


def described(packed: DataFrame, size: int) -> DataFrame:
    """A row for each document: ``block``, ``place``, ``doc_id``, ``n_shingles``, ``class``, and at a class's first place in a block its ``signature``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, texts in zip(*(batch.column(c) for c in ("block", "ids", "texts")), strict=True):
                own = sets_of(blocks.unpacked(ids, texts.as_py()), size)
                names = [class_of(s) for s in own]
                first = {name: i for i, name in reversed(list(enumerate(names))) if len(own[i])}
                drawn: list[bytes | None] = [None] * len(own)
                if first:
                    rows = signatures([own[i] for i in first.values()])
                    for i, row in zip(first.values(), rows, strict=True):
                        drawn[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block.as_py()] * len(own), pa.int64()),
                        pa.array(range(len(own)), pa.int32()),
                        pa.array(ids.as_py(), pa.int64()),
                        pa.array([len(s) for s in own], pa.int64()),
                        pa.array(names, pa.binary()),
                        pa.array(drawn, pa.binary()),
                    ],
                    names=["block", "place", "doc_id", "n_shingles", "class", "signature"],
                )

    return packed.select("block", "ids", "texts").mapInArrow(run, "block long, place int, doc_id long, n_shingles long, class binary, signature binary")


def prefix(tree, depth: int):
    """A hash of the first ``depth`` min-hashes of a tree's signature."""
    return F.xxhash64(tree, F.substring(F.col("signature"), tree * DEEP * WIDTH + 1, F.lit(depth * WIDTH)))


def regions(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (``key``, ``tree``, ``class``) of the regions that are searched, and candidate pairs (``a``, ``b``) of those taken whole."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    rows = classes.withColumn("tree", tree).select(prefix(F.col("tree"), LEAST).alias("key"), "tree", "class")
    searched, whole = None, None
    for depth in range(LEAST, DEEP + 1):
        held = rows.groupBy("key").agg(F.count(F.lit(1)).alias("held"), F.min("class").alias("least")).filter("held > 1")
        rows = materialize(rows.join(held, "key"), "forest-regions")
        fine = rows.filter(F.col("held") <= WIDE).select("key", "tree", "class")
        searched = fine if searched is None else searched.unionByName(fine)
        dense = rows.filter(F.col("held") > WIDE)
        whole = dense.filter("class != least").select(F.col("class").alias("a"), F.col("least").alias("b"))
        if depth == DEEP or dense.isEmpty():
            break
        rows = dense.select("tree", "class").join(classes, "class").select(prefix(F.col("tree"), depth + 1).alias("key"), "tree", "class")
    return searched, whole


def candidates(searched: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) that connect the classes of each region that may be similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, drawn = None, [], []

        def tied() -> pa.RecordBatch:
            rows = np.frombuffer(b"".join(drawn), np.uint8).reshape(len(drawn), -1)[:, WIDTH - 1 :: WIDTH]
            found = near_parts(np.ascontiguousarray(rows), percent)
            return pa.RecordBatch.from_arrays([pa.array([names[p[s]] for p in found], pa.binary()) for s in (0, 1)], names=["a", "b"])

        for batch in batches:
            for own, name, signature in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != key:
                    if len(names) > 1:
                        yield tied()
                    key, names, drawn = own, [], []
                names.append(name)
                drawn.append(signature)
        if len(names) > 1:
            yield tied()

    order = F.substring(F.col("signature"), F.col("tree") * DEEP * WIDTH + 1, F.lit(DEEP * WIDTH))
    rows = searched.join(classes, "class").select("key", "class", "signature", order.alias("order"))
    dealt = rows.repartition("key").sortWithinPartitions("key", "order", "class")
    return dealt.select("key", "class", "signature").mapInArrow(run, "a binary, b binary")


def components(docs: DataFrame, size: int = 4, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Rows are linked when a hundred times their common ``size``-word shingles
    are at least ``percent`` times all shingles of both; ``kept`` are the rows
    that carry the name of their component.
    """
    packed = blocks.blocks(docs)
    members = materialize(described(packed, size), "forest-members")
    first = members.filter("signature is not null").groupBy("class").agg(F.first("n_shingles").alias("n"), F.first("signature").alias("signature"))
    classes = materialize(first, "forest-classes")
    searched, whole = regions(classes)
    near = materialize(candidates(searched, classes.select("class", "signature"), percent).unionByName(whole).distinct(), "forest-candidates")
    groups = connected(near).withColumnsRenamed({"node": "class", "label": "pivot"})
    meets = materialize(groups.join(classes.select("class", "n"), "class").select("pivot", F.lit(0).alias("part"), "class", "n"), "forest-groups")
    sets = materialize(sets_by_class(packed, members, meets, size), "forest-sets")
    links = materialize(link(meets, sets, percent), "forest-links")
    rows = members.join(named(members, connected(links)), "class", "left")
    name = F.when(F.col("n_shingles") > 0, F.col("named")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", name.alias("component_id"), F.col("doc_id").eqNullSafe(name).alias("kept"))
