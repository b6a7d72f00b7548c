"""A Merkle manifest of a corpus: one tree a language, one over their roots, and a proof for every row.

A leaf is the digest of a row's fields, each written as its length in bytes, a
colon and its value. Leaves of a language ascend by doc_id; every two
consecutive nodes are hashed into one until one is left, a last node without
partner alone. These subroots, in order of language, are the leaves of the tree
on top.

*Trees.* Places come from distributed row numbers. A task hashes runs of
``RUN`` neighbours up ``RUN_LEVELS`` levels at once and hands one node to the
next pass, so there is one pass for every ten levels.

*Proofs by pointer jumping.* Each node holds the segment of siblings on the
way to an ancestor, at first its parent. A self-join on that ancestor doubles
the distance and puts both segments together, until every leaf points to the
root: a number of joins that grows with the logarithm of the height. Shorter
trees are prolonged by nodes without a sibling, so all leaves are at one
distance, and after a join only the nodes at multiples of the new distance are
kept, as no leaf meets the others again. An ancestor at distance d has at most
2^d descendants and there are N / 2^d of them: either they are small, which
Spark sees from the written table's size, or they are many and no key is hot.

A null language is a tree of its own and comes first. A null doc_id comes first
in its tree; rows with the same doc_id follow by digest, and rows that are equal
in all five fields are leaves of their own beside each other. Empty texts are
fields of length 0, unlike null. An empty table has no rows and no root. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haplometh.operators.ordering import numbered
from haplometh.storage import materialize

RUN_LEVELS = 10
RUN = 1 << RUN_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: First byte of a step: the sibling stands on the left, on the right, or there is none and the node is hashed alone.
LEFT, RIGHT, ALONE = b"L", b"R", b"N"
TOP = -1


def written(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(**changed: Column) -> Column:
    """The digest of a row, with some of its fields ``changed``."""
    return F.sha2(F.concat(*[written(changed.get(f, F.col(f))) for f in FIELDS]), 256)


def joined(*digests: bytes) -> bytes:
    """The digest of digests, which are hashed as hexadecimal text."""
    return sha256(b"".join(d.hex().encode() for d in digests)).digest()


NODE = "tree int, level int, at long, step binary, digest binary"


def climbed(base: DataFrame, level: int) -> DataFrame:
    """Nodes of trees from ``base`` (``tree``, ``at``, ``digest``, ``n`` nodes of the tree at this ``level``), at most ``RUN_LEVELS`` up.

    Rows with a ``step`` are nodes below a tree's root; those with a ``digest`` go on, or are roots.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, n = None, [], 0

        def nodes() -> pa.RecordBatch:
            (tree, block), row, out = key, held, []
            for up in range(min(RUN_LEVELS, (n - 1).bit_length())):
                first = block << (RUN_LEVELS - up)
                for i, own in enumerate(row):
                    if i ^ 1 < len(row):
                        out.append((tree, level + up, first + i, (LEFT if i & 1 else RIGHT) + row[i ^ 1], None))
                    else:
                        out.append((tree, level + up, first + i, ALONE, None))
                row = [joined(*row[i : i + 2]) for i in range(0, len(row), 2)]  # one node of a tree's last run climbs on alone
            out.append((tree, level + RUN_LEVELS, block, None, row[0]))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["tree", "level", "at", "step", "digest"])

        for batch in batches:
            for tree, block, digest, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (tree, block) != key:
                    if held:
                        yield nodes()
                    key, held, n = (tree, block), [], size
                held.append(digest)
        if held:
            yield nodes()

    run_of = F.shiftright("at", RUN_LEVELS).alias("block")
    dealt = base.select("tree", run_of, "at", "digest", "n").repartition("tree", "block").sortWithinPartitions("tree", "block", "at")
    return dealt.select("tree", "block", "digest", "n").mapInArrow(run, NODE)


def forest(leaves: DataFrame, highest: int) -> tuple[DataFrame, DataFrame]:
    """All nodes below the roots (``tree``, ``level``, ``at``, ``step``), and the roots (``tree``, ``digest``).

    ``leaves`` as in ``climbed``; ``highest`` is the number of levels of the tallest tree.
    """
    spark = leaves.sparkSession
    nodes, roots, base, level = None, None, leaves, 0
    while True:
        done = base.filter("n = 1").select("tree", "digest")
        roots = done if roots is None else roots.unionByName(done)
        if level >= highest:
            break
        passed = materialize(climbed(base.filter("n > 1"), level), "merkle-nodes")
        below = passed.filter("step is not null").select("tree", "level", "at", "step")
        nodes = below if nodes is None else nodes.unionByName(below)
        sizes = base.filter("n > 1").select("tree", "n").distinct()
        base = passed.filter("digest is not null").select("tree", "at", "digest").join(sizes, "tree")
        base = materialize(base.withColumn("n", F.floor((F.col("n") + (RUN - 1)) / RUN).cast("long")), "merkle-level")
        level += RUN_LEVELS
    return (spark.createDataFrame([], "tree int, level int, at long, step binary") if nodes is None else nodes), roots


def height(n: Column) -> Column:
    """How often ``n`` nodes are halved, rounding up, until one is left."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(F.lit(0))


def jumped(leaves: DataFrame, nodes: DataFrame, root_level: int) -> DataFrame:
    """``leaves`` with the whole ``path`` of steps to the root.

    Both hold ``path`` and the node it leads to (``up_tree``, ``up_level``, ``up_at``), at distance 1 at first.
    """
    place = ("tree", "level", "at")

    def doubled(rows: DataFrame) -> DataFrame:
        further = nodes.select(*[F.col(c).alias(f"__{c}") for c in place], F.col("path").alias("__path"), *[F.col(f"up_{c}").alias(f"__up_{c}") for c in place])
        met = rows.join(further, [F.col(f"up_{c}") == F.col(f"__{c}") for c in place], "left")
        ups = [F.coalesce(f"__up_{c}", f"up_{c}").alias(f"up_{c}") for c in place]
        rest = [c for c in rows.columns if c != "path" and not c.startswith("up_")]
        return met.select(*rest, F.concat("path", F.coalesce("__path", F.lit(b""))).alias("path"), *ups)

    distance = 1
    while distance < root_level:
        leaves = doubled(leaves)
        distance *= 2
        if distance < root_level:
            nodes = materialize(doubled(nodes.filter(F.col("level") % distance == 0)), "merkle-jumps")
    return leaves


def manifest(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """``doc_id``, ``lang``, ``leaf``, ``altered``, ``subroot``, ``root`` and ``path`` of every row.

    Digests are raw bytes. ``altered`` is the leaf of the row after a change of
    ``n_chars`` to the given column (null: none). ``path`` holds the steps from
    the leaf to the root: a byte, and the sibling's digest if there is one.
    """
    other = F.lit(None).cast("binary") if altered is None else F.when(altered.isNotNull(), F.unhex(leaf(n_chars=altered)))
    rows = docs.select("doc_id", "lang", F.unhex(leaf()).alias("leaf"), other.alias("altered"))
    rows = materialize(numbered(rows, ["lang", "doc_id", "leaf"]), "merkle-leaves")
    trees = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("first"))
    trees = numbered(trees, ["first"], "tree").withColumn("tree", F.col("tree").cast("int")).withColumnRenamed("lang", "of")
    trees = materialize(trees.withColumn("height", height(F.col("n"))), "merkle-trees")
    tall, many = trees.agg(F.coalesce(F.max("height"), F.lit(0)), F.count(F.lit(1))).collect()[0]
    rows = rows.join(trees, F.col("lang").eqNullSafe(F.col("of"))).withColumn("at", F.col("position") - F.col("first"))
    rows = materialize(rows.select("doc_id", "lang", "leaf", "altered", "tree", "at", "n"), "merkle-places")

    below, subroots = forest(rows.select("tree", "at", F.col("leaf").alias("digest"), "n"), tall)
    subroots = materialize(subroots.withColumnRenamed("digest", "subroot"), "merkle-subroots")
    top = subroots.select(F.lit(TOP).alias("tree"), F.col("tree").cast("long").alias("at"), F.col("subroot").alias("digest"), F.lit(many).cast("long").alias("n"))
    top = materialize(top, "merkle-top")  # read back: a constant tree would turn joins on it into nested loops
    total = tall + (many - 1).bit_length() if many else 0
    above, roots = forest(top, total - tall)
    root = next((bytes(r["digest"]) for r in roots.collect()), None)  # one row

    longer = trees.filter(F.col("height") < tall).select("tree", F.explode(F.sequence("height", F.lit(tall - 1))).alias("level"), F.lit(0).cast("long").alias("at"), F.lit(b"").alias("step"))
    nodes = below.unionByName(longer).unionByName(above.withColumn("level", F.col("level") + tall))
    # a language's root, at level ``tall``, is a leaf of the tree on top
    ends = (F.col("tree") != TOP) & (F.col("level") + 1 == tall)
    up = {"up_tree": F.when(ends, F.lit(TOP)).otherwise(F.col("tree")), "up_level": F.col("level") + 1, "up_at": F.when(ends, F.col("tree").cast("long")).otherwise(F.shiftright("at", 1))}
    nodes = materialize(nodes.withColumns(up).withColumnRenamed("step", "path"), "merkle-jumps")
    if tall == 0:  # each language is one leaf
        rows = rows.withColumns({"at": F.col("tree").cast("long"), "tree": F.lit(TOP)}).withColumn("of", F.col("at").cast("int"))
    else:
        rows = rows.withColumn("of", F.col("tree"))
    steps = nodes.filter("level = 0").drop("level")
    placed = rows.join(steps, ["tree", "at"], "left").withColumn("path", F.coalesce("path", F.lit(b"")))
    proved = jumped(placed, nodes.filter("level > 0"), total)
    proved = proved.join(subroots.withColumnRenamed("tree", "of"), "of")
    return proved.select("doc_id", "lang", "leaf", "altered", "subroot", F.lit(root).cast("binary").alias("root"), "path")


def steps_of(path: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Side and sibling (empty, if there is none) of each step."""
    at = 0
    while at < len(path):
        side = path[at : at + 1]
        size = 0 if side == ALONE else 32
        yield side, path[at + 1 : at + 1 + size]
        at += 1 + size


def folded(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf's digest and its path lead to."""
    for side, sibling in steps_of(path):
        digest = joined(sibling, digest) if side == LEFT else joined(digest, sibling) if side == RIGHT else joined(digest)
    return digest


def audit(proved: DataFrame) -> DataFrame:
    """``manifest`` with hexadecimal digests, the digest of each proof's siblings and the root that the (altered) leaf leads to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, altered, paths = (batch.column(c).to_pylist() for c in ("leaf", "altered", "path"))
            proofs = [joined(*[s for _, s in steps_of(p)]).hex() for p in paths]
            ends = [folded(own if new is None else new, p).hex() for own, new, p in zip(leaves, altered, paths, strict=True)]
            sides = [[d.hex() for d in batch.column(c).to_pylist()] for c in ("leaf", "subroot", "root")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (*sides, proofs, ends))], names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    kind = proved.schema["doc_id"].dataType.simpleString()
    told = proved.mapInArrow(run, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))
