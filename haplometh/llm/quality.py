"""Quality by importance resampling over hashed n-gram models.

Two generative models count the words and word pairs of texts in ``BUCKETS``
hashed places: one of a sample of documents labelled good (the target), one of
all documents (raw). A document's log weight is the sum over its n-grams of the
log ratio of both models; with Gumbel noise added, the k largest sums are a
sample without replacement in proportion to the weights. k is the share of good
labels of all documents that have a word.

Words are runs of letters and digits, and runs of ASCII punctuation are words
of their own; a pair of equal words is one n-gram whatever the word. Null,
empty and blank texts have no n-gram and are never selected. Without a good
label both models agree and every other document is kept. A repeated row is
judged as often as it occurs and all its copies get one verdict; a null
doc_id draws noise like any other value. Noise is a hash of ``doc_id``, so
reruns agree; keys that tie with the kth are kept too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haplometh.llm.arrow import frugal, steps
from haplometh.llm.words import shingles, words
from haplometh.storage import materialize

#: Places of the hashed models, and how many go together in a row of counts.
BUCKETS, PER_ROW = 1 << 16, 1 << 10
#: Bounds of the labelled sample that makes the target model, and weight of the raw model in it.
TARGET_DOCS, PRIOR = 20_000, 50_000.0
#: Bins of a round of the search for the kth key, and rows that are small enough to sort.
BINS, FEW = 1024, 4096
_SHIFT = np.uint64(64 - (BUCKETS - 1).bit_length())
_SAME = np.uint64(0x5851F42D4C957F2D)


def ngrams(texts) -> tuple[np.ndarray, np.ndarray]:
    """Places of all words and pairs of words, and the text each is from."""
    w = words(texts, marks=True)
    owner = w.owner()
    pairs = np.where(w.hash[1:] == w.hash[:-1], _SAME, shingles(w.hash, 2))
    inside = owner[1:] == owner[:-1]
    places = np.concatenate((w.hash, pairs[inside])) >> _SHIFT
    return places.astype(np.int64), np.concatenate((owner, owner[1:][inside]))


def good_sample(labels: DataFrame, most: int = TARGET_DOCS) -> DataFrame:
    """At most ``most`` ids labelled good, those with the smallest hashes."""
    good = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality")).filter("quality = 1")
    return good.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def good_share(labels: DataFrame) -> float | None:
    """The share of good labels; None without labels."""
    return labels.agg(F.avg((F.col("quality") == 1).cast("double"))).collect()[0][0]


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """The log ratio of target to raw model in each place; raw counts are those of all documents."""
    marked = F.broadcast(good_sample(labels).withColumn("target", F.lit(True)))  # a bounded sample
    rows = docs.select("doc_id", "text").join(marked, "doc_id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for whole in batches:
            for batch in steps(whole):
                places, owner = ngrams(batch.column("text").to_pylist())
                target = batch.column("target").to_numpy(zero_copy_only=False)
                counts[0] += np.bincount(places, minlength=BUCKETS)
                counts[1] += np.bincount(places[target[owner]], minlength=BUCKETS)
        parts = range(0, BUCKETS, PER_ROW)
        blobs = [counts[:, p : p + PER_ROW].tobytes() for p in parts]
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "counts"])

    def total(parts: pd.DataFrame) -> pd.DataFrame:  # one row of 16 KB a task
        summed = np.zeros((2, PER_ROW), np.int64)
        for blob in parts["counts"]:
            summed += np.frombuffer(blob, np.int64).reshape(2, PER_ROW)
        return pd.DataFrame({"part": parts["part"][:1], "raw": [summed[0].tolist()], "target": [summed[1].tolist()]})

    partial = rows.mapInArrow(frugal(count), "part int, counts binary")
    summed = partial.groupBy("part").applyInPandas(total, "part int, raw array<long>, target array<long>")
    raw, target = np.ones(BUCKETS), np.zeros(BUCKETS)
    for part, r, t in summed.collect():  # BUCKETS numbers, whatever the input
        raw[part : part + PER_ROW] += r
        target[part : part + PER_ROW] += t
    if not target.any():
        return np.zeros(BUCKETS)
    raw /= raw.sum()
    target += PRIOR * raw
    return np.log(target / target.sum()) - np.log(raw)


def score(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``docs`` with ``log_weight`` (null without n-grams) in front of its columns."""
    told = docs.sparkSession.sparkContext.broadcast(ratio)  # a fixed size
    names = ["log_weight", *docs.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in steps(whole):
                places, owner = ngrams(batch.column("text").to_pylist())
                n = np.bincount(owner, minlength=batch.num_rows)
                sums = np.bincount(owner, told.value[places], batch.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(sums, pa.float64(), mask=n == 0), *batch.columns], names=names)

    return docs.mapInArrow(frugal(run), "log_weight double, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))


def kth_largest(rows: DataFrame, column: str, k: int) -> float | None:
    """The exact ``k``-th largest value, by counting in ever narrower bins; None beyond the last row."""
    low, high, n = rows.agg(F.min(column), F.max(column), F.count(column)).collect()[0]
    if k > n or k < 1:
        return None
    while n > FEW and low < high:
        width = (high - low) / BINS
        place = F.least(F.floor((F.col(column) - low) / F.lit(width)), F.lit(BINS - 1))
        inside = rows.filter(F.col(column).between(low, high))
        counts = inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for _, size, start, end in sorted(map(tuple, counts.collect()), reverse=True):  # at most BINS rows
            if k <= size:
                low, high, n = start, end, size
                break
            k -= size
    if low == high:
        return low
    return sorted((r[0] for r in rows.filter(F.col(column).between(low, high)).select(column).collect()), reverse=True)[k - 1]


def keyed(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``docs`` with ``log_weight`` and ``key`` in front; rows without a word are left out."""
    scored = score(docs, ratio).filter(F.col("log_weight").isNotNull())
    hashed = F.xxhash64(F.col("doc_id").cast("string"), F.lit("gumbel"))
    draw = (F.pmod(F.shiftright(hashed, 11), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    key = F.col("log_weight") - F.log(-F.log(draw))
    return scored.select("log_weight", key.alias("key"), *[F.col(f"`{c}`") for c in docs.columns])


def threshold(keys: DataFrame, labels: DataFrame) -> float:
    """The smallest key that is selected; without labels, or with good ones only, any."""
    share = good_share(labels)
    if not share or share >= 1:
        return float("-inf")
    least = kth_largest(keys, "key", max(1, round(share * keys.count())))
    return float("-inf") if least is None else least


def resample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``log_weight`` and ``key`` of the selected documents."""
    keys = materialize(keyed(docs.select("doc_id", "text"), fit(docs, labels)).drop("text"), "quality-keys")
    return keys.filter(F.col("key") >= threshold(keys, labels)).select("doc_id", "log_weight", "key")


def select(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The selected rows of ``docs`` with all their columns.

    The narrow keys give the threshold; the texts are then scored once more
    where they lie, which costs less than moving them to their verdicts.
    """
    ratio = fit(docs, labels)
    keys = materialize(keyed(docs.select("doc_id", "text"), ratio).select("key"), "quality-keys")
    kept = keyed(docs.withColumnsRenamed({c: f"__own_{c}" for c in docs.columns if c in ("log_weight", "key")}), ratio).filter(F.col("key") >= threshold(keys, labels))
    return kept.select(*[F.col(f"`__own_{c}`" if c in ("log_weight", "key") else f"`{c}`").alias(c) for c in docs.columns])
