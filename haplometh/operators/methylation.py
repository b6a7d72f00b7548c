"""Per-site methylation: two read haplotypes, two modes, one or three people.

Count mode and model mode describe the same sites. Every table holds
``total_read_count`` and ``methylation_level`` columns, told apart by suffixes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haplometh.functions.methylation import by_orientation, founder_of
from haplometh.keys import SITE, with_by
from haplometh.operators.intervals import BLOCK_BIN, Bins, overlap_join, with_bin
from haplometh.operators.joins import ONCE, align_unique_sites, at_sites, full_outer
from haplometh.storage import materialize

MODES = ("count", "model")

# The person haplotypes of a trio, and which read haplotype each
# one is; the prefix is the side of the pedigree that phases it.
TRIO_HAPLOTYPES = {
    "kid_pat": ("kid", "hap1", "pat"),
    "kid_mat": ("kid", "hap2", "mat"),
    "dad_A": ("dad", "hap1", "pat"),
    "dad_B": ("dad", "hap2", "pat"),
    "mom_C": ("mom", "hap1", "mat"),
    "mom_D": ("mom", "hap2", "mat"),
}
MEMBERS = ("kid", "dad", "mom")

FOUNDER_COMMON = (
    "start_hap_map_block",
    "end_hap_map_block",
    "haplotype_concordance_in_hap_map_block",
    "num_het_SNVs_in_hap_map_block",
    "total_read_count_pat",
    "total_read_count_mat",
    "founder_haplotype_pat",
    "founder_haplotype_mat",
)
FOUNDER_LEVELS = tuple(f"methylation_level_{side}_{mode}" for mode in MODES for side in ("pat", "mat"))


def suffixed(df: DataFrame, suffix: str, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in columns})


def join_haplotypes(
    hap1: DataFrame, hap2: DataFrame, *, by: Sequence[str] = (), hot_keys: bool = False
) -> DataFrame:
    """Levels of both read haplotypes side by side; a site may be on one of them only."""
    values = ["total_read_count", "methylation_level"]
    sides = suffixed(hap1, "_hap1", values), suffixed(hap2, "_hap2", values)
    return full_outer(*sides, with_by(by), hot_keys=hot_keys)


def _hap_map_columns(hap_map: DataFrame) -> DataFrame:
    renames = {
        "haplotype_concordance": "haplotype_concordance_in_hap_map_block",
        "num_het_SNVs": "num_het_SNVs_in_hap_map_block",
    }
    return hap_map.withColumnsRenamed(renames)


def phase_to_founders(
    meth: DataFrame, hap_map: DataFrame, *, by: Sequence[str] = (), bin_size: int | Bins = BLOCK_BIN
) -> DataFrame:
    """Turn read haplotypes into paternal and maternal ones, keeping unphased sites.

    A site inside several hap-map blocks gives one row per block.
    """
    placed = overlap_join(
        meth, _hap_map_columns(hap_map), "left", suffix="_hap_map_block", by=by, bin_size=bin_size
    )
    sides = {"pat": F.col("paternal_haplotype"), "mat": F.col("maternal_haplotype")}
    swapped = [
        by_orientation(label, F.col(f"{value}_hap1"), F.col(f"{value}_hap2")).alias(f"{value}_{side}")
        for value in ("methylation_level", "total_read_count")
        for side, label in sides.items()
    ]
    founders = [founder_of(label).alias(f"founder_haplotype_{side}") for side, label in sides.items()]
    return placed.select(*with_by(by), *FOUNDER_COMMON[:4], *swapped, *founders)


def combine_modes(
    count: DataFrame, model: DataFrame, *, by: Sequence[str] = (), hot_keys: bool = False
) -> DataFrame:
    """Founder-phased count and model levels in one row, joined on all they have in common (null equals null)."""
    levels = ("methylation_level_pat", "methylation_level_mat")
    on = with_by(by, (*SITE, *FOUNDER_COMMON))
    sides = suffixed(count, "_count", levels), suffixed(model, "_model", levels)
    return full_outer(*sides, on, null_safe=True, hot_keys=hot_keys).select(*on, *FOUNDER_LEVELS)


def founder_phased_methylation(
    files: Mapping[tuple[str, str], DataFrame],
    hap_map: DataFrame,
    *,
    by: Sequence[str] = (),
    bin_size: int | Bins = BLOCK_BIN,
) -> DataFrame:
    """Same table as joining haplotypes, phasing each mode and combining the modes, in one pass.

    ``files`` holds the four site tables by ``(mode, haplotype)``. They are
    lined up by one shuffle, and the interval join runs once instead of once
    per mode, on the rows as they lie; what is written are the phased rows. Modes meet in one row when they agree on the read counts; where
    they do not, a phased site keeps one row per mode, as it would after a join
    that includes the counts. Sites that a file repeats, and only these, go
    through the steps one by one, with joins that multiply the copies and split
    hot ones.
    """
    tables = {f"{mode}_{hap}": df for (mode, hap), df in files.items()}
    values = {
        name: {"total_read_count": f"reads_{name}", "methylation_level": f"level_{name}"} for name in tables
    }

    def phased_sites(aligned: DataFrame) -> DataFrame:
        return _phased_in_one_pass(aligned, list(tables), hap_map, by=by, bin_size=bin_size)

    once, repeated = align_unique_sites(tables, values, by=by, presence=tuple(tables), bins=bin_size, then=phased_sites)
    if repeated is None:
        return once
    files = at_sites(files, repeated, by=by)
    modes = []
    for mode in MODES:
        haplotypes = join_haplotypes(files[mode, "hap1"], files[mode, "hap2"], by=by, hot_keys=True)
        # written, as its copies may be many and the next join reads it twice
        phased = phase_to_founders(haplotypes, hap_map, by=by, bin_size=bin_size)
        modes.append(materialize(phased, f"repeated-{mode}"))
    return once.unionByName(combine_modes(*modes, by=by, hot_keys=True))


def _phased_in_one_pass(
    aligned: DataFrame, names: Sequence[str], hap_map: DataFrame, *, by: Sequence[str], bin_size: int | Bins
) -> DataFrame:
    """Both modes of aligned sites, dealt by bin, on the hap map."""
    in_count = F.col("has_count_hap1") | F.col("has_count_hap2")
    in_model = F.col("has_model_hap1") | F.col("has_model_hap2")
    same_reads = F.col("reads_count_hap1").eqNullSafe(F.col("reads_model_hap1")) & F.col(
        "reads_count_hap2"
    ).eqNullSafe(F.col("reads_model_hap2"))
    placed = overlap_join(
        aligned.withColumn("__in_count", in_count)
        .withColumn("__clash", in_count & in_model & ~same_reads)
        .drop(*[f"has_{name}" for name in names]),
        _hap_map_columns(hap_map),
        "left",
        suffix="_hap_map_block",
        by=by,
        bin_size=bin_size,
        dealt=True,
    )
    split = F.col("__clash") & F.col("paternal_haplotype").isNotNull()
    # One row normally; "count" and "model" rows apart where the modes clash.
    parts = placed.withColumn(
        "__part",
        F.explode(F.when(split, F.array(F.lit("count"), F.lit("model"))).otherwise(F.array(F.lit("both")))),
    )
    sides = {"pat": F.col("paternal_haplotype"), "mat": F.col("maternal_haplotype")}

    def read_count(side: str):
        def of(mode: str):
            return by_orientation(
                sides[side], F.col(f"reads_{mode}_hap1"), F.col(f"reads_{mode}_hap2")
            )

        from_count = F.when(F.col("__part") == "both", F.col("__in_count")).otherwise(F.col("__part") == "count")
        return F.when(from_count, of("count")).otherwise(of("model")).alias(f"total_read_count_{side}")

    def level(side: str, mode: str):
        own = F.col("__part").isin("both", mode)
        value = by_orientation(sides[side], F.col(f"level_{mode}_hap1"), F.col(f"level_{mode}_hap2"))
        return F.when(own, value).alias(f"methylation_level_{side}_{mode}")

    return parts.select(
        *with_by(by),
        *FOUNDER_COMMON[:4],
        *[read_count(side) for side in sides],
        *[founder_of(label).alias(f"founder_haplotype_{side}") for side, label in sides.items()],
        *[level(side, mode) for mode in MODES for side in sides],
        ONCE,
    )


def combine_modes_of_member(
    count: DataFrame, model: DataFrame, *, by: Sequence[str] = (), hot_keys: bool = False
) -> DataFrame:
    """Count and model levels of one person; read counts are those of the count table."""
    levels = ("methylation_level_hap1", "methylation_level_hap2")
    lean = model.select(*with_by(by), *levels)
    sides = suffixed(count, "_count", levels), suffixed(lean, "_model", levels)
    return full_outer(*sides, with_by(by), hot_keys=hot_keys)


def name_member_haplotypes(df: DataFrame, member: str) -> DataFrame:
    """Rename read haplotypes to the person's own: pat/mat, A/B or C/D."""
    renames = {}
    for name, (person, hap, _) in TRIO_HAPLOTYPES.items():
        if person == member:
            renames[f"total_read_count_{hap}"] = f"total_read_count_{name}"
            for mode in MODES:
                renames[f"methylation_level_{hap}_{mode}"] = f"methylation_level_{name}_{mode}"
    return df.withColumnsRenamed(renames)


def join_members(tables: Sequence[DataFrame], *, by: Sequence[str] = (), hot_keys: bool = False) -> DataFrame:
    """Full outer join of the members' tables by site."""
    joined = tables[0]
    for table in tables[1:]:
        joined = full_outer(joined, table, with_by(by), hot_keys=hot_keys)
    return joined


def trio_columns(member: str) -> list[str]:
    """One member's columns in output order."""
    first, second = [n for n, (person, _, _) in TRIO_HAPLOTYPES.items() if person == member]
    return [
        f"total_read_count_{first}",
        f"methylation_level_{first}_count",
        f"total_read_count_{second}",
        f"methylation_level_{second}_count",
        f"methylation_level_{first}_model",
        f"methylation_level_{second}_model",
    ]


def phase_to_parents(
    trio: DataFrame,
    pat_map: DataFrame,
    mat_map: DataFrame,
    *,
    by: Sequence[str] = (),
    bin_size: int | Bins = BLOCK_BIN,
    keep: Sequence[str] = (),
    dealt: bool = False,
) -> DataFrame:
    """Place trio sites in the paternal and maternal hap maps; values outside a map become null.

    ``keep`` names columns to carry along; with ``dealt`` the rows have their bins, as for ``overlap_join``.
    """
    # Both joins are on the same bins: the rows move to them once at most.
    placed = trio if dealt else with_bin(trio, bin_size)
    for side, parent, hap_map in (("pat", "dad", pat_map), ("mat", "mom", mat_map)):
        renamed = hap_map.withColumnsRenamed(
            {
                "haplotype_concordance": f"{side}ernal_concordance",
                "num_het_SNVs_in_parent": f"num_het_SNVs_in_{parent}",
            }
        )
        placed = overlap_join(
            placed, renamed, "left", suffix=f"_hap_map_block_{side}", by=by, bin_size=bin_size, dealt=True
        )
    kept = []
    for member in MEMBERS:
        for column in trio_columns(member):
            side = next(side for name, (_, _, side) in TRIO_HAPLOTYPES.items() if f"_{name}" in column)
            phased = F.col(f"{side}ernal_haplotype").isNotNull()
            kept.append(F.when(phased, F.col(column)).alias(column))
    blocks = []
    for side, parent in (("pat", "dad"), ("mat", "mom")):
        blocks += [
            f"start_hap_map_block_{side}",
            f"end_hap_map_block_{side}",
            f"{side}ernal_haplotype",
            f"{side}ernal_concordance",
            f"num_het_SNVs_in_{parent}",
        ]
    return placed.select(*with_by(by), *kept, *blocks, *keep)


def parent_phased_methylation(
    files: Mapping[tuple[str, str, str], DataFrame],
    pat_map: DataFrame,
    mat_map: DataFrame,
    *,
    by: Sequence[str] = (),
    bin_size: int | Bins = BLOCK_BIN,
) -> DataFrame:
    """``phase_to_parents`` of ``trio_methylation``: sites are placed in the hap maps as they lie, with no exchange between."""

    def phased(trio: DataFrame, **kind) -> DataFrame:
        return phase_to_parents(trio, pat_map, mat_map, by=by, bin_size=bin_size, **kind)

    aligned, joined = _trio_sites(files, by, bin_size, lambda trio: phased(trio, keep=(ONCE,), dealt=True))
    return aligned if joined is None else aligned.unionByName(phased(joined))


def trio_methylation(
    files: Mapping[tuple[str, str, str], DataFrame], *, by: Sequence[str] = ()
) -> DataFrame:
    """The trio's twelve site tables, keyed ``(member, mode, haplotype)``, lined up by one shuffle.

    Sites that a file repeats, and only these, are joined pairwise, multiplying copies.
    """
    ordered = [*with_by(by), *[c for member in MEMBERS for c in trio_columns(member)]]
    aligned, joined = _trio_sites(files, by)
    aligned = aligned.select(*ordered)
    return aligned if joined is None else aligned.unionByName(joined.select(*ordered))


def _trio_sites(
    files: Mapping[tuple[str, str, str], DataFrame],
    by: Sequence[str],
    bins: int | Bins = BLOCK_BIN,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """The aligned sites, or what ``then`` makes of them, and the joined rows of the sites that a file repeats, or None."""
    tables, values = {}, {}
    for (member, mode, hap), df in files.items():
        name = next(n for n, (person, h, _) in TRIO_HAPLOTYPES.items() if (person, h) == (member, hap))
        tables[f"{name}_{mode}"] = df
        values[f"{name}_{mode}"] = {"methylation_level": f"methylation_level_{name}_{mode}"}
        if mode == "count":
            values[f"{name}_{mode}"]["total_read_count"] = f"total_read_count_{name}"
    aligned, repeated = align_unique_sites(tables, values, by=by, bins=bins, then=then)
    if repeated is None:
        return aligned, None
    files, members = at_sites(files, repeated, by=by), []
    for member in MEMBERS:
        modes = [
            materialize(join_haplotypes(files[member, mode, "hap1"], files[member, mode, "hap2"], by=by, hot_keys=True), "repeated-haplotypes")
            for mode in MODES
        ]
        combined = combine_modes_of_member(*modes, by=by, hot_keys=True)
        members.append(materialize(name_member_haplotypes(combined, member), "repeated-member"))
    return aligned, join_members(members, by=by, hot_keys=True)
