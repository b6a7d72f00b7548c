"""Phase one pedigree member's methylation to founder haplotypes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from haplometh.operators import hapmap, methylation, phasing
from haplometh.operators.intervals import adaptive_bins
from haplometh.operators.ordering import version_sort
from haplometh.plans.counts import Counts
from haplometh.sinks import text
from haplometh.sources import bed, blocks, vcf


@dataclass(frozen=True)
class FounderPhasing:
    """The job's tables, read back from what it wrote."""

    hap_map: DataFrame
    sites: DataFrame
    mismatches: DataFrame
    methylation: DataFrame
    #: rows and columns by stage
    counts: dict[str, dict[str, int]] = field(default_factory=dict)


def phase_meth_to_founder_haps(
    spark: SparkSession,
    *,
    uid: str,
    vcf_read_phased: str | list[str],
    tsv_read_phase_blocks: str,
    vcf_iht_phased: str | list[str],
    txt_iht_blocks: str,
    beds: Mapping[tuple[str, str], str],
    output_dir: str,
    partitions: int | None = None,
) -> FounderPhasing:
    """``beds`` holds the four pileup files by ``(mode, haplotype)``: count/model, hap1/hap2.

    Writes the hap map (whole, and per parent), mismatch sites (BED and VCF),
    the phased table as BED and as Parquet, and one bedGraph track per parent and mode.
    """
    out, counts = output_dir.rstrip("/"), Counts()
    iht_blocks = blocks.read_inheritance_blocks(spark, txt_iht_blocks, uid)
    snvs = counts.step(
        phasing.founder_phasing(
            vcf.read_read_phasing(spark, vcf_read_phased, partitions=partitions),
            blocks.read_read_phase_blocks(spark, tsv_read_phase_blocks),
            vcf.read_inheritance_phasing(spark, vcf_iht_phased, uid, partitions=partitions),
            iht_blocks,
            bin_size=adaptive_bins(iht_blocks),
        ),
        "founder-snvs",
    )
    spec = hapmap.founder_spec()
    hap_map = counts.step(hapmap.hap_map(snvs, spec), "founder-hap-map")
    mismatches = counts.step(hapmap.mismatch_sites(snvs, spec), "founder-mismatches")
    for parental in ("paternal", "maternal"):
        text.write_hap_map_blocks(hap_map, out, uid, parental)
    text.write_bed(hap_map.orderBy("chrom", "start", "end"), out, f"{uid}.hap-map-blocks")
    text.write_mismatches(mismatches, out, uid)

    files = {
        (mode, hap): bed.read_meth_level(spark, path, mode, partitions=partitions)
        for (mode, hap), path in beds.items()
    }
    phased = methylation.founder_phased_methylation(
        files, hap_map, bin_size=adaptive_bins(hap_map)
    )
    table = f"{out}/{uid}.dna-methylation.parquet"
    counts.clustered(phased, "founder-methylation", table)
    phased = spark.read.schema(phased.schema).parquet(table)
    text.write_bed(version_sort(phased), out, f"{uid}.dna-methylation")
    text.write_tracks_of(phased, text.founder_track_columns(), f"{out}/{uid}.dna-methylation.tracks", compression="gzip")
    return FounderPhasing(hap_map, hapmap.het_sites(snvs), mismatches, phased, counts)

