"""Expand phased methylation to all CpGs, and scan a reference for CpGs."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from haplometh.operators import expand, qc
from haplometh.operators.intervals import WORD
from haplometh.operators.methylation import MEMBERS
from haplometh.operators.ordering import version_sort
from haplometh.plans.counts import Counts
from haplometh.sinks import text
from haplometh.sources import bed, genome, vcf

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Expansion:
    """The final table and its QC fractions."""

    table: DataFrame
    qc: DataFrame
    #: rows and columns by stage; ``phased-not-in-sites`` are phased rows that no site takes up
    counts: dict[str, dict[str, int]] = field(default_factory=dict)


def _phased_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The phased table, or None with a warning: a founder has none."""
    try:
        return bed.read_bed_and_header(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no phased methylation at %s; a founder cannot be phased by inheritance", path)
        return None


def _finish(
    df: DataFrame, variants: DataFrame, roles: tuple[str, ...], report: DataFrame, path: str, source: str, counts: Counts
) -> Expansion:
    """Flag, then write the table as Parquet and as compressed BED, and its QC."""
    root = path.removesuffix(".bed")
    flagged = expand.flag_allele_specific(df, variants, roles, hot_keys=True)
    counts.clustered(flagged, "expanded", f"{root}.parquet", start="start_cpg", end="end_cpg")
    report.write.mode("overwrite").parquet(f"{root}.qc.parquet")
    spark = df.sparkSession
    # The sort of the text output samples its input, so it reads the finished table.
    final = spark.read.parquet(f"{root}.parquet")
    text.write_methylation(final, path, source)
    return Expansion(final, spark.read.parquet(f"{root}.qc.parquet"), counts)


def expand_to_all_cpgs(
    spark: SparkSession,
    *,
    uid: str,
    bed_all_cpgs_in_reference: str,
    bed_meth_count_unphased: str,
    bed_meth_model_unphased: str,
    bed_meth_founder_phased: str,
    vcf_joint_called: str | list[str],
    bed_out: str,
    bed_het_site_mismatches: str | None = None,
    damaged_variants_out: str | None = None,
    partitions: int | None = None,
) -> Expansion | None:
    """The 22-column table of one sample and its QC; None when there is no phased input.

    Damaged rows of the variant files are passed over; with
    ``damaged_variants_out`` they are written there, one scan more, and counted.
    """
    source = f"{expand_to_all_cpgs.__name__} with args {_shown(locals())}"
    phased = _phased_or_none(spark, bed_meth_founder_phased)
    if phased is None:
        return None
    counts = Counts()
    sites = expand.all_sites_founder(
        bed.read_all_cpgs_in_reference(spark, bed_all_cpgs_in_reference),
        bed.read_meth_level(spark, bed_meth_count_unphased, "count", partitions=partitions),
        bed.read_meth_level(spark, bed_meth_model_unphased, "model", partitions=partitions),
    )
    mismatches = bed_het_site_mismatches and bed.read_bed_and_header(spark, bed_het_site_mismatches)
    df = expand.flag_proximity(expand.attach_phased(sites, phased, words=True), mismatches or None)
    df = counts.step(df.drop(WORD), "all-cpgs")
    counts.lost(expand.phased_outside(df, phased), "phased-not-in-sites")
    if damaged_variants_out:
        _set_aside(spark, vcf_joint_called, damaged_variants_out, counts)
    variants = vcf.read_joint_variants(spark, vcf_joint_called, uid, partitions=partitions)
    return _finish(df, variants, ("",), qc.qc_founder(df), bed_out, source, counts)


def expand_to_all_cpgs_trio(
    spark: SparkSession,
    *,
    kid_id: str,
    dad_id: str,
    mom_id: str,
    bed_all_cpgs_in_reference: str,
    beds_unphased: Mapping[tuple[str, str], str],
    bed_meth_parent_phased: str,
    bed_het_site_mismatches_pat: str,
    bed_het_site_mismatches_mat: str,
    vcf_joint_called: str | list[str],
    bed_out: str,
    output_dir: str,
    damaged_variants_out: str | None = None,
    partitions: int | None = None,
) -> Expansion | None:
    """The 49-column table of a trio and its QC; ``beds_unphased`` by ``(member, mode)``.

    Also writes the six tracks of unphased levels, phased input or not.
    """
    source = f"{expand_to_all_cpgs_trio.__name__} with args {_shown(locals())}"
    ids = {"kid": kid_id, "dad": dad_id, "mom": mom_id}
    counts = Counts()
    sites = counts.step(
        expand.all_sites_trio(
            bed.read_all_cpgs_in_reference(spark, bed_all_cpgs_in_reference),
            {
                key: bed.read_meth_level(spark, path, key[1], partitions=partitions)
                for key, path in beds_unphased.items()
            },
        ),
        "trio-unphased",
    )
    text.write_tracks_of(
        sites, text.combined_track_columns(ids), f"{output_dir.rstrip('/')}/combined.tracks", compression="gzip"
    )
    phased = _phased_or_none(spark, bed_meth_parent_phased)
    if phased is None:
        return None
    df = expand.attach_phased(sites, phased, words=True)
    for side, path in (("_pat", bed_het_site_mismatches_pat), ("_mat", bed_het_site_mismatches_mat)):
        df = expand.flag_proximity(df, bed.read_bed_and_header(spark, path), side)
    df = counts.step(df.drop(WORD), "trio-all-cpgs")
    counts.lost(expand.phased_outside(df, phased), "phased-not-in-sites")
    if damaged_variants_out:
        _set_aside(spark, vcf_joint_called, damaged_variants_out, counts)
    variants = vcf.read_joint_variants(spark, vcf_joint_called, ids, partitions=partitions)
    return _finish(df, variants, MEMBERS, qc.qc_trio(df), bed_out, source, counts)


def _set_aside(spark: SparkSession, path: str | list[str], out: str, counts: Counts) -> None:
    """Write the damaged rows of variant files, and count them."""
    vcf.read_damaged_variants(spark, path).write.mode("overwrite").parquet(out)
    written = spark.read.parquet(out)
    counts["damaged-variants"] = {"rows": written.count(), "columns": len(written.columns)}


def _shown(arguments: dict) -> dict:
    return {k: v for k, v in arguments.items() if k != "spark"}


def write_all_cpgs_in_reference(spark: SparkSession, reference: str | list[str], bed_out: str) -> str:
    """Every CpG of a FASTA reference as a 3-column BED in genome order."""
    text.write_table(version_sort(genome.scan_fasta(spark, reference)), bed_out)
    return bed_out
