"""Phase a trio's methylation to the parents' haplotypes."""

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
class ParentPhasing:
    """The job's tables; maps and mismatches by side, ``pat`` and ``mat``."""

    hap_maps: dict[str, DataFrame]
    mismatches: dict[str, DataFrame]
    methylation: DataFrame
    #: rows and columns by stage
    counts: dict[str, dict[str, int]] = field(default_factory=dict)


def phase_meth_to_parent_haps(
    spark: SparkSession,
    *,
    kid_id: str,
    dad_id: str,
    mom_id: str,
    vcf_phased: str | list[str],
    block_files: Mapping[str, str],
    beds: Mapping[tuple[str, str, str], str],
    output_dir: str,
    partitions: int | None = None,
) -> ParentPhasing:
    """``block_files`` by member, ``beds`` the twelve pileup files by ``(member, mode, haplotype)``."""
    out, counts = output_dir.rstrip("/"), Counts()
    ids = {"kid": kid_id, "dad": dad_id, "mom": mom_id}
    bounds = {m: blocks.read_phase_blocks(spark, block_files[m], uid) for m, uid in ids.items()}
    pairs = dict(zip(("dad", "mom"), vcf.read_trio_pairs(spark, vcf_phased, kid_id, dad_id, mom_id, partitions=partitions)))
    bin_size = adaptive_bins(bounds["kid"])

    maps, mismatches = {}, {}
    for side, parent in (("pat", "dad"), ("mat", "mom")):
        snvs = counts.step(
            phasing.parent_phasing(pairs[parent], bounds["kid"], bounds[parent], parent, bin_size=bin_size),
            f"{parent}-snvs",
        )
        spec = hapmap.parent_spec(parent)
        maps[side] = counts.step(hapmap.hap_map(snvs, spec), f"{parent}-hap-map")
        mismatches[side] = counts.step(hapmap.mismatch_sites(snvs, spec), f"{parent}-mismatches")
        text.write_hap_map_blocks(maps[side], out, kid_id, f"{side}ernal")
        text.write_mismatches(mismatches[side], out, kid_id, f"{side}ernal")

    files = {
        key: bed.read_meth_level(spark, path, key[1], partitions=partitions) for key, path in beds.items()
    }
    phased = methylation.parent_phased_methylation(
        files, maps["pat"], maps["mat"], bin_size=adaptive_bins(maps["pat"])
    )
    table = f"{out}/trio.dna-methylation.parquet"
    counts.clustered(phased, "trio-methylation", table)
    phased = spark.read.schema(phased.schema).parquet(table)
    text.write_bed(version_sort(phased), out, "trio.dna-methylation")
    text.write_tracks_of(phased, text.trio_track_columns(ids), f"{out}/trio.dna-methylation.tracks", compression="gzip")
    return ParentPhasing(maps, mismatches, phased, counts)
