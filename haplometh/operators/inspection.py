"""Filters with which finished tables are looked through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haplometh.functions.genotypes import HET
from haplometh.operators.methylation import MODES


def discordant_blocks(hap_map: DataFrame, below: float = 1.0) -> DataFrame:
    """Hap-map blocks in which some SNV disagrees with the block's orientation."""
    return hap_map.filter(F.col("haplotype_concordance") < below)


def of_unknown_flag(df: DataFrame, flag: str) -> DataFrame:
    """Rows whose flag is null: on their chromosome nothing was there to decide it."""
    return df.filter(F.col(flag).isNull())


def inside_blocks(df: DataFrame, side: str = "") -> DataFrame:
    """Rows in a hap-map block; of a trio's table, ``side`` is ``_pat`` or ``_mat``."""
    return df.filter(F.col(f"start_hap_map_block{side}").isNotNull())


def outside_blocks(df: DataFrame, side: str = "") -> DataFrame:
    """Rows in no hap-map block, whose haplotypes stay unphased."""
    return df.filter(F.col(f"start_hap_map_block{side}").isNull())


def partly_phased(df: DataFrame, first: str = "pat", second: str = "mat") -> DataFrame:
    """Rows in a block that have a level of one parental haplotype and none of the other, in either mode."""
    apart = F.lit(False)
    for mode in MODES:
        a, b = (F.col(f"methylation_level_{side}_{mode}").isNull() for side in (first, second))
        apart = apart | (a != b)
    return inside_blocks(df).filter(apart)


def het_beside_others(df: DataFrame, genotypes: str = "snv_genotypes") -> DataFrame:
    """CpGs with several SNVs of which one is heterozygous."""
    listed = F.split(genotypes, ",")
    return df.filter((F.size(listed) > 1) & F.array_contains(listed, HET))
