"""Tables of heterozygous SNVs that carry two independent phasings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haplometh.keys import SITE, with_by
from haplometh.operators.intervals import BLOCK_BIN, Bins, overlap_join


def attach_read_blocks(snvs: DataFrame, blocks: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Read-phased SNVs with the bounds of their phase block, matched by block id.

    SNVs without phase set have the id ``.`` and may be many; no block has that
    id unless the block table says so, and they are dropped before the shuffle
    by the runtime filter or broadcast Spark picks for the small block table.
    """
    bounds = blocks.select(
        *by,
        "chrom",
        "phase_block_id",
        F.col("start").alias("start_phase_block"),
        F.col("end").alias("end_phase_block"),
        F.col("num_variants").alias("num_variants_phase_block"),
    )
    return snvs.join(bounds, [*by, "chrom", "phase_block_id"], "inner")


def join_phasings(read: DataFrame, inherited: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """SNVs found by both callers: same position and same alleles."""
    return read.join(inherited, with_by(by, (*SITE, "REF", "ALT")), "inner")


def attach_inheritance_blocks(
    snvs: DataFrame, blocks: DataFrame, *, by: Sequence[str] = (), bin_size: int | Bins = BLOCK_BIN
) -> DataFrame:
    """SNVs with every inheritance block they overlap."""
    renamed = blocks.withColumnsRenamed(
        {c: f"{c}_iht_block" for c in ("founder_label_pat", "founder_label_mat")}
    )
    return overlap_join(snvs, renamed, "inner", suffix="_iht_block", by=by, bin_size=bin_size)


def founder_phasing(
    read: DataFrame,
    read_blocks: DataFrame,
    inherited: DataFrame,
    inherited_blocks: DataFrame,
    *,
    by: Sequence[str] = (),
    bin_size: int | Bins = BLOCK_BIN,
) -> DataFrame:
    """All SNVs with both phasings and both kinds of block."""
    both = join_phasings(attach_read_blocks(read, read_blocks, by=by), inherited, by=by)
    placed = attach_inheritance_blocks(both, inherited_blocks, by=by, bin_size=bin_size)
    return placed.drop("phase_block_id", "num_variants_phase_block")


def attach_blocks_by_position(
    snvs: DataFrame, blocks: DataFrame, person: str, *, by: Sequence[str] = (), bin_size: int | Bins = BLOCK_BIN
) -> DataFrame:
    """SNVs with one person's phase blocks, matched by position; nested blocks give several rows."""
    bounds = blocks.select(*by, "chrom", "start", "end")
    return overlap_join(snvs, bounds, "inner", suffix=f"_phase_block_{person}", by=by, bin_size=bin_size)


def parent_phasing(
    pairs: DataFrame,
    kid_blocks: DataFrame,
    parent_blocks: DataFrame,
    parent: str,
    *,
    by: Sequence[str] = (),
    bin_size: int | Bins = BLOCK_BIN,
) -> DataFrame:
    """Kid and parent alleles at the parent's het SNVs, inside phase blocks of both."""
    placed = attach_blocks_by_position(pairs, kid_blocks, "kid", by=by, bin_size=bin_size)
    return attach_blocks_by_position(placed, parent_blocks, parent, by=by, bin_size=bin_size)
