"""Chromosome names: contig filters and genome order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name parts of contigs outside the primary assembly, and the
# chromosomes on which methylation is not phased.
ALT_CONTIG_PARTS = ("_random", "chrEBV", "chrUn_")
UNPHASABLE_CHROMS = ("chrM", "chrX", "chrY")


def is_alt_contig(chrom: Column | str) -> Column:
    """True for unplaced, unlocalised and viral contigs."""
    name = F.col(chrom) if isinstance(chrom, str) else chrom
    hit = F.lit(False)
    for part in ALT_CONTIG_PARTS:
        hit = hit | name.contains(part)
    return hit


def drop_alt_contigs(df: DataFrame, chrom: str = "chrom") -> DataFrame:
    return df.filter(~is_alt_contig(chrom))


def is_phasable(chrom: str = "chrom") -> Column:
    """True on the autosomes (and on anything else that is not M, X or Y)."""
    return ~F.col(chrom).isin(*UNPHASABLE_CHROMS)


def chrom_rank(chrom: Column | str = "chrom") -> Column:
    """The first number in a chromosome name, null when it has none."""
    name = F.col(chrom) if isinstance(chrom, str) else chrom
    return F.regexp_extract(name, r"(\d+)", 1).try_cast("bigint")


def version_order(chrom: str = "chrom", start: str = "start") -> list[Column]:
    """Sort keys for chr1, chr2, chr10, chrM, chrX, chrY and then position."""
    return [
        chrom_rank(chrom).asc_nulls_last(),
        F.col(chrom).asc_nulls_last(),
        F.col(start).asc_nulls_last(),
    ]


def with_version_order(df: DataFrame, chrom: str = "chrom", start: str = "start") -> tuple[DataFrame, list[Column]]:
    """``df`` with the chromosome's rank as a column, and the sort keys of ``version_order`` on it.

    A sort evaluates a key that is an expression at every comparison, a column not.
    """
    ranked = df.withColumn("__rank", chrom_rank(chrom))
    return ranked, [F.col("__rank").asc_nulls_last(), *version_order(chrom, start)[1:]]
