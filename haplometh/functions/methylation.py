"""Per-row methylation expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def by_orientation(label: Column, hap1: Column, hap2: Column) -> Column:
    """The hap1 or hap2 value, as the block label ``<founder>_hap1|2`` says; null when unphased."""
    return F.when(label.endswith("_hap1"), hap1).when(label.endswith("_hap2"), hap2)


def founder_of(label: Column) -> Column:
    """The founder part of a block label."""
    return F.split_part(label, F.lit("_"), F.lit(1))


#: How many of two haplotype levels must be present.
LEVELS_NEEDED = {"any": 1, "all": 2}


def level_is_reported(first: Column, second: Column, logic: str) -> Column:
    """Whether any or all of two haplotype levels are present."""
    if logic not in LEVELS_NEEDED:
        raise ValueError(f"logic must be one of {list(LEVELS_NEEDED)}")
    present = first.isNotNull().cast("int") + second.isNotNull().cast("int")
    return present >= LEVELS_NEEDED[logic]


def locus(chrom: str = "chrom", start: str = "start_cpg", end: str = "end_cpg") -> Column:
    """``chrom:start-end`` as shown by genome browsers."""
    return F.format_string("%s:%d-%d", F.col(chrom), F.col(start), F.col(end))


def fraction(percent: Column) -> Column:
    return percent / 100
