"""Orders, samples and row numbers that survive repartitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from haplometh.functions.chroms import with_version_order
from haplometh.functions.methylation import locus
from haplometh.operators.joins import rows_at
from haplometh.storage import materialize


def version_sort(df: DataFrame, *, start: str = "start") -> DataFrame:
    """Rows in genome order: by chromosome number, then name, then start."""
    ranked, order = with_version_order(df, start=start)
    return ranked.orderBy(*order).select(*df.columns)


def position_sort(df: DataFrame, columns: Sequence[str] = ("chrom", "start", "end")) -> DataFrame:
    """Rows in plain alphabetical chromosome order."""
    return df.orderBy(*columns)


def numbered(df: DataFrame, order: Sequence[str | Column], position: str = "position") -> DataFrame:
    """``df`` with each row's place in ``order``, from 0; no task sorts more than a range of the rows."""
    return positions(df.repartitionByRange(*order).sortWithinPartitions(*order), position)


def positions(ordered: DataFrame, position: str = "position") -> DataFrame:
    """Rows of an ordered table (``version_sort``, ``orderBy``) with their place in it, from 0.

    Rows are written with their place inside the partition, and moved up by the
    number of rows in the partitions before theirs: one count a partition,
    summed up in order. No window holds more than these counts.
    """
    placed = materialize(ordered.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    # Fixed by the id's definition: the partition in the upper bits, the row in the lower 33.
    part, row = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    ahead = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)  # one row a partition
    before = counts.select("__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0).cast("long")).alias("__before"))
    moved = placed.withColumn("__part", part).join(F.broadcast(before), "__part")  # bounded by the number of partitions
    return moved.select(*ordered.columns, (F.col("__before") + row).alias(position))


def seeded_sample(df: DataFrame, n: int, seed: int, keys: Sequence[str] | None = None) -> DataFrame:
    """``n`` rows picked by a seeded digest of ``keys``: the same rows whatever the partitioning.

    Runs as a top-k, so each task keeps ``n`` rows and nothing else is sorted.
    """
    keys = list(keys or df.columns)
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return df.orderBy(digest, *keys).limit(n)


def preview(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by ``keys``; each task keeps ``n`` rows."""
    return df.orderBy(*keys).limit(n)


def sample_at_double_variants(labelled: DataFrame, n: int, seed: int) -> DataFrame:
    """All rows of ``n`` sampled CpGs that overlap two SNVs and have both count levels."""
    where = ["chrom", "start_cpg", "end_cpg"]
    candidates = labelled.filter(
        (F.col("num_SNVs_overlapping_CG") == 2)
        & F.col("methylation_level_pat_count").isNotNull()
        & F.col("methylation_level_mat_count").isNotNull()
    )
    chosen = seeded_sample(candidates.select(*where).distinct(), n, seed)
    return rows_at(labelled, chosen, where).withColumn("locus_cpg", locus())
