"""Haplotype maps: which of two haplotypes matches a parent, block by block.

A block is the intersection of two kinds of phase block. Over its SNVs, the
share of agreeing alleles decides the orientation. Both are sums, so a block
costs one hash aggregate with map-side partials, however many SNVs it holds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HapMapSpec:
    """One comparison: the block keys, the two allele columns and the labels to give.

    ``labels`` names an output column with the SQL expressions of its value in a
    matching and in an opposite block.
    """

    keys: tuple[str, ...]
    starts: tuple[str, str]
    ends: tuple[str, str]
    observed: str
    expected: str
    labels: tuple[tuple[str, str, str], ...]
    count_name: str


def founder_spec() -> HapMapSpec:
    pat, mat = "founder_label_pat_iht_block", "founder_label_mat_iht_block"
    return HapMapSpec(
        keys=(
            "chrom",
            "start_phase_block",
            "end_phase_block",
            "start_iht_block",
            "end_iht_block",
            "founder_label_pat_iht_block",
            "founder_label_mat_iht_block",
        ),
        starts=("start_phase_block", "start_iht_block"),
        ends=("end_phase_block", "end_iht_block"),
        observed="allele_hap1",
        expected="allele_pat",
        labels=(
            ("paternal_haplotype", f"{pat} || '_hap1'", f"{pat} || '_hap2'"),
            ("maternal_haplotype", f"{mat} || '_hap2'", f"{mat} || '_hap1'"),
        ),
        count_name="num_het_SNVs",
    )


def parent_spec(parent: str) -> HapMapSpec:
    """Kid's inherited allele against haplotype A of ``dad`` or C of ``mom``."""
    side, column, hap1, hap2 = {
        "dad": ("pat", "paternal_haplotype", "A", "B"),
        "mom": ("mat", "maternal_haplotype", "C", "D"),
    }[parent]
    starts = ("start_phase_block_kid", f"start_phase_block_{parent}")
    ends = ("end_phase_block_kid", f"end_phase_block_{parent}")
    return HapMapSpec(
        keys=("chrom", starts[0], ends[0], starts[1], ends[1]),
        starts=starts,
        ends=ends,
        observed=f"kid_allele_{side}",
        expected=f"{parent}_allele_{hap1}",
        labels=((column, f"'{hap1}'", f"'{hap2}'"),),
        count_name="num_het_SNVs_in_parent",
    )


def _differs(spec: HapMapSpec) -> Column:
    return F.col(spec.observed) != F.col(spec.expected)


def block_concordance(snvs: DataFrame, spec: HapMapSpec, *, by: Sequence[str] = ()) -> DataFrame:
    """Per block: number of SNVs, orientation and concordance.

    A tie goes to the opposite orientation.
    """
    counted = snvs.groupBy(*by, *spec.keys).agg(
        F.count(F.lit(1)).alias(spec.count_name),
        F.sum(_differs(spec).cast("bigint")).alias("__differing"),
    )
    similarity = 1 - F.col("__differing") / F.col(spec.count_name)
    return (
        counted.withColumn("__similarity", similarity)
        .withColumn("__matches", F.col("__similarity") > 0.5)
        .withColumn(
            "haplotype_concordance",
            F.when(F.col("__matches"), F.col("__similarity")).otherwise(1.0 - F.col("__similarity")),
        )
    )


def hap_map(snvs: DataFrame, spec: HapMapSpec, *, by: Sequence[str] = ()) -> DataFrame:
    """Hap-map blocks with haplotype labels, concordance and SNV count."""
    return block_concordance(snvs, spec, by=by).select(
        *by,
        "chrom",
        F.greatest(*spec.starts).alias("start"),
        F.least(*spec.ends).alias("end"),
        *[F.when(F.col("__matches"), F.expr(a)).otherwise(F.expr(b)).alias(name) for name, a, b in spec.labels],
        "haplotype_concordance",
        spec.count_name,
    )


def mismatch_sites(snvs: DataFrame, spec: HapMapSpec, *, by: Sequence[str] = ()) -> DataFrame:
    """SNVs that disagree with the orientation of their block."""
    keys = [*by, *spec.keys]
    oriented = block_concordance(snvs, spec, by=by).select(*keys, "__matches")
    s, b = snvs.alias("s"), oriented.alias("b")
    same_block = F.lit(True)
    for key in keys:
        same_block = same_block & F.col(f"s.{key}").eqNullSafe(F.col(f"b.{key}"))
    return (
        s.join(b, same_block, "inner")
        .filter(_differs(spec) == F.col("__matches"))
        .select(*[F.col(f"s.{c}") for c in (*by, "chrom", "start", "end", "REF", "ALT")])
    )


def het_sites(snvs: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """All SNVs that entered the comparison."""
    return snvs.select(*by, "chrom", "start", "end", "REF", "ALT")
