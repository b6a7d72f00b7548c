"""The same results in plain SQL: composite CTEs and one SELECT per query."""

from __future__ import annotations

from checks.views import with_views

SITE = "chrom, start_, end_"
OUT_SITE = 'chrom, start_ AS start, end_ AS "end"'
OUT_SNV = f'{OUT_SITE}, ref AS "REF", alt AS "ALT"'

CTES: dict[str, str] = {}

_BLOCK_KEYS = (
    "chrom, start_phase_block, end_phase_block, start_iht_block, end_iht_block, "
    "founder_label_pat_iht_block, founder_label_mat_iht_block"
)
CTES["o_read_blocks"] = """
SELECT r.*, b.start_ AS start_phase_block, b.end_ AS end_phase_block, b.num_variants AS num_variants_phase_block
FROM fx_read r JOIN fx_phase_block b ON r.chrom = b.chrom AND r.phase_block_id = CAST(b.phase_block_id AS STRING)"""
CTES["o_snvs"] = """
SELECT r.chrom, r.start_, r.end_, r.ref, r.alt, r.allele_hap1, r.allele_hap2, r.start_phase_block, r.end_phase_block,
       i.allele_pat, i.allele_mat, h.start_ AS start_iht_block, h.end_ AS end_iht_block,
       h.founder_label_pat AS founder_label_pat_iht_block, h.founder_label_mat AS founder_label_mat_iht_block
FROM o_read_blocks r
JOIN fx_iht i ON r.chrom = i.chrom AND r.start_ = i.start_ AND r.end_ = i.end_ AND r.ref = i.ref AND r.alt = i.alt
JOIN fx_iht_block h ON r.chrom = h.chrom AND r.start_ < h.end_ AND h.start_ < r.end_"""
# The rows of a cohort's variant files that their readers keep: one base for one base, every seventh phased the other way.
CTES["o_snvs_read"] = """
SELECT * REPLACE (CASE WHEN start_ % 7 = 0 THEN allele_hap2 ELSE allele_hap1 END AS allele_hap1)
FROM o_snvs WHERE length(ref) = 1 AND alt IN ('A', 'C', 'G', 'T')"""
for _read in ("", "_read"):
    CTES[f"o_blocks{_read}"] = f"""
SELECT {_BLOCK_KEYS}, count(*) AS n,
       1 - sum(CASE WHEN allele_hap1 <> allele_pat THEN 1 ELSE 0 END) / count(*) AS similarity
FROM o_snvs{_read} GROUP BY ALL"""
    CTES[f"o_hap_map{_read}"] = f"""
SELECT chrom, greatest(start_phase_block, start_iht_block) AS start_, least(end_phase_block, end_iht_block) AS end_,
       founder_label_pat_iht_block || CASE WHEN similarity > 0.5 THEN '_hap1' ELSE '_hap2' END AS paternal_haplotype,
       founder_label_mat_iht_block || CASE WHEN similarity > 0.5 THEN '_hap2' ELSE '_hap1' END AS maternal_haplotype,
       CASE WHEN similarity > 0.5 THEN similarity ELSE 1.0 - similarity END AS haplotype_concordance,
       n AS num_het_SNVs
FROM o_blocks{_read}"""
    CTES[f"o_mismatch{_read}"] = f"""
SELECT s.chrom, s.start_, s.end_, s.ref, s.alt FROM o_snvs{_read} s JOIN o_blocks{_read} b USING ({_BLOCK_KEYS})
WHERE (s.allele_hap1 <> s.allele_pat) = (b.similarity > 0.5)"""

for _member in ("kid", "dad", "mom"):
    for _mode in ("count", "model"):
        CTES[f"o_{_member}_{_mode}"] = f"""
SELECT {SITE}, a.total_read_count AS total_read_count_hap1, a.methylation_level AS methylation_level_hap1,
       b.total_read_count AS total_read_count_hap2, b.methylation_level AS methylation_level_hap2
FROM fx_{_member}_{_mode}_hap1 a FULL JOIN fx_{_member}_{_mode}_hap2 b USING ({SITE})"""


def _phased(source: str, hap_map: str = "o_hap_map") -> str:
    def swap(value: str, side: str) -> str:
        label = f"{side}ernal_haplotype"
        return (
            f"CASE WHEN {label} LIKE '%\\_hap1' ESCAPE '\\' THEN m.{value}_hap1 "
            f"WHEN {label} LIKE '%\\_hap2' ESCAPE '\\' THEN m.{value}_hap2 END AS {value}_{side}"
        )

    swapped = ", ".join(swap(v, s) for v in ("methylation_level", "total_read_count") for s in ("pat", "mat"))
    return f"""
SELECT m.chrom, m.start_, m.end_, h.start_ AS start_hap_map_block, h.end_ AS end_hap_map_block,
       h.haplotype_concordance AS haplotype_concordance_in_hap_map_block,
       h.num_het_SNVs AS num_het_SNVs_in_hap_map_block, {swapped},
       split_part(paternal_haplotype, '_', 1) AS founder_haplotype_pat,
       split_part(maternal_haplotype, '_', 1) AS founder_haplotype_mat
FROM {source} m LEFT JOIN {hap_map} h ON m.chrom = h.chrom AND m.start_ < h.end_ AND h.start_ < m.end_"""


CTES["o_phased_count"] = _phased("o_kid_count")
CTES["o_phased_model"] = _phased("o_kid_model")
_COMMON = (
    "chrom start_ end_ start_hap_map_block end_hap_map_block haplotype_concordance_in_hap_map_block "
    "num_het_SNVs_in_hap_map_block total_read_count_pat total_read_count_mat "
    "founder_haplotype_pat founder_haplotype_mat"
).split()


def _both_modes(count: str, model: str) -> str:
    return f"""
SELECT {", ".join(f"coalesce(c.{k}, m.{k}) AS {k}" for k in _COMMON)},
       c.methylation_level_pat AS methylation_level_pat_count, c.methylation_level_mat AS methylation_level_mat_count,
       m.methylation_level_pat AS methylation_level_pat_model, m.methylation_level_mat AS methylation_level_mat_model
FROM {count} c FULL JOIN {model} m
ON {" AND ".join(f"c.{k} IS NOT DISTINCT FROM m.{k}" for k in _COMMON)}"""


CTES["o_founder"] = _both_modes("o_phased_count", "o_phased_model")

# Trio phasing.
for _parent, _side, _place, _names, _kid in (
    ("dad", "pat", 1, ("A", "B"), "kid_allele_pat"),
    ("mom", "mat", 3, ("C", "D"), "kid_allele_mat"),
):
    CTES[f"o_pairs_{_parent}"] = f"""
SELECT {SITE}, ref, alt, substr(gt_kid, {_place}, 1) AS {_kid}, substr(gt_{_parent}, 1, 1) AS {_parent}_allele_{_names[0]},
       substr(gt_{_parent}, 3, 1) AS {_parent}_allele_{_names[1]}
FROM fx_trio_snv
WHERE length(ref) = 1 AND length(alt) = 1 AND gt_{_parent} IN ('0|1', '1|0')
  AND (gt_kid LIKE '%|%' OR substr(gt_kid, 1, 1) = substr(gt_kid, 3, 1)) AND substr(gt_kid, {_place}, 1) <> '.'"""
    CTES[f"o_snvs_{_parent}"] = f"""
SELECT p.*, k.start_ AS start_phase_block_kid, k.end_ AS end_phase_block_kid,
       q.start_ AS start_phase_block_{_parent}, q.end_ AS end_phase_block_{_parent}
FROM o_pairs_{_parent} p
JOIN fx_kid_block k ON p.chrom = k.chrom AND p.start_ < k.end_ AND k.start_ < p.end_
JOIN fx_{_parent}_block q ON p.chrom = q.chrom AND p.start_ < q.end_ AND q.start_ < p.end_"""
    _keys = f"chrom, start_phase_block_kid, end_phase_block_kid, start_phase_block_{_parent}, end_phase_block_{_parent}"
    CTES[f"o_blocks_{_parent}"] = f"""
SELECT {_keys}, count(*) AS n,
       1 - sum(CASE WHEN {_kid} <> {_parent}_allele_{_names[0]} THEN 1 ELSE 0 END) / count(*) AS similarity
FROM o_snvs_{_parent} GROUP BY ALL"""
    CTES[f"o_hap_map_{_side}"] = f"""
SELECT chrom, greatest(start_phase_block_kid, start_phase_block_{_parent}) AS start_,
       least(end_phase_block_kid, end_phase_block_{_parent}) AS end_,
       CASE WHEN similarity > 0.5 THEN '{_names[0]}' ELSE '{_names[1]}' END AS {_side}ernal_haplotype,
       CASE WHEN similarity > 0.5 THEN similarity ELSE 1.0 - similarity END AS haplotype_concordance,
       n AS num_het_SNVs_in_parent
FROM o_blocks_{_parent}"""
    CTES[f"o_mismatch_{_side}"] = f"""
SELECT s.chrom, s.start_, s.end_, s.ref, s.alt FROM o_snvs_{_parent} s JOIN o_blocks_{_parent} b USING ({_keys})
WHERE (s.{_kid} <> s.{_parent}_allele_{_names[0]}) = (b.similarity > 0.5)"""

_HAPS = {"kid": ("kid_pat", "kid_mat"), "dad": ("dad_A", "dad_B"), "mom": ("mom_C", "mom_D")}
for _member, _haps in _HAPS.items():
    CTES[f"o_{_member}_modes"] = f"""
SELECT {SITE}, {", ".join(
        f"c.total_read_count_hap{i} AS total_read_count_{h}, c.methylation_level_hap{i} AS methylation_level_{h}_count, "
        f"m.methylation_level_hap{i} AS methylation_level_{h}_model" for i, h in enumerate(_haps, 1))}
FROM o_{_member}_count c FULL JOIN o_{_member}_model m USING ({SITE})"""
CTES["o_trio"] = f"""
SELECT * FROM o_kid_modes FULL JOIN o_dad_modes USING ({SITE}) FULL JOIN o_mom_modes USING ({SITE})"""


def _trio_values() -> str:
    out = []
    for member, haps in _HAPS.items():
        for i, h in enumerate(haps):
            side = ("pat", "mat")[i] if member == "kid" else {"dad": "pat", "mom": "mat"}[member]
            for c in (f"total_read_count_{h}", f"methylation_level_{h}_count", f"methylation_level_{h}_model"):
                out.append(f"CASE WHEN {side}ernal_haplotype IS NOT NULL THEN {c} END AS {c}")
    return ",\n       ".join(out)


CTES["o_parents"] = f"""
SELECT t.chrom, t.start_, t.end_, {_trio_values()},
       p.start_ AS start_hap_map_block_pat, p.end_ AS end_hap_map_block_pat, p.paternal_haplotype,
       p.haplotype_concordance AS paternal_concordance, p.num_het_SNVs_in_parent AS num_het_SNVs_in_dad,
       m.start_ AS start_hap_map_block_mat, m.end_ AS end_hap_map_block_mat, m.maternal_haplotype,
       m.haplotype_concordance AS maternal_concordance, m.num_het_SNVs_in_parent AS num_het_SNVs_in_mom
FROM o_trio t
LEFT JOIN o_hap_map_pat p ON t.chrom = p.chrom AND t.start_ < p.end_ AND p.start_ < t.end_
LEFT JOIN o_hap_map_mat m ON t.chrom = m.chrom AND t.start_ < m.end_ AND m.start_ < t.end_"""

# Expansion.
CTES["o_unphased"] = f"""
SELECT {SITE}, c.total_read_count AS total_read_count_count, c.methylation_level AS methylation_level_count,
       m.total_read_count AS total_read_count_model, m.methylation_level AS methylation_level_model
FROM fx_kid_count_combined c FULL JOIN fx_kid_model_combined m USING ({SITE})"""
CTES["o_sites"] = f"""
SELECT {SITE}, total_read_count_count AS total_read_count, methylation_level_count, methylation_level_model
FROM fx_reference FULL JOIN o_unphased USING ({SITE})"""
CTES["o_expanded"] = f"SELECT * FROM o_sites LEFT JOIN o_founder USING ({SITE})"

# A cohort: the trio's members as samples, all with the pedigree's SNVs and blocks but their own pileups.
COHORT = ("dad", "kid", "mom")
for _member in COHORT:
    for _mode in ("count", "model"):
        # pileup files hold percentages
        CTES[f"o_pair_{_member}_{_mode}"] = f"""
SELECT * REPLACE (methylation_level_hap1/100 AS methylation_level_hap1, methylation_level_hap2/100 AS methylation_level_hap2)
FROM o_{_member}_{_mode}"""
        CTES[f"o_sample_{_member}_{_mode}"] = _phased(f"o_pair_{_member}_{_mode}", "o_hap_map_read")
    CTES[f"o_sample_{_member}"] = _both_modes(f"o_sample_{_member}_count", f"o_sample_{_member}_model")
    CTES[f"o_sample_{_member}_sites"] = f"""
SELECT {SITE}, r.reads AS total_read_count, r.count_level AS methylation_level_count, r.model_level AS methylation_level_model
FROM fx_reference FULL JOIN (
  SELECT {SITE}, c.total_read_count AS reads, c.methylation_level/100 AS count_level, m.methylation_level/100 AS model_level
  FROM fx_{_member}_count_combined c FULL JOIN fx_{_member}_model_combined m USING ({SITE})) r USING ({SITE})"""
CTES["o_cohort"] = " UNION ALL ".join(f"SELECT '{m}' AS sample, * FROM o_sample_{m}" for m in COHORT)
CTES["o_cohort_expanded"] = " UNION ALL ".join(
    f"SELECT '{m}' AS sample, * FROM o_sample_{m}_sites LEFT JOIN o_sample_{m} USING ({SITE})" for m in COHORT
)
for _member in ("kid", "dad", "mom"):
    CTES[f"o_unphased_{_member}"] = f"""
SELECT {SITE}, c.total_read_count AS total_read_count_{_member}, c.methylation_level AS methylation_level_{_member}_count,
       m.methylation_level AS methylation_level_{_member}_model
FROM fx_{_member}_count_combined c FULL JOIN fx_{_member}_model_combined m USING ({SITE})"""
CTES["o_unphased_trio"] = f"""
SELECT * FROM o_unphased_kid FULL JOIN o_unphased_dad USING ({SITE}) FULL JOIN o_unphased_mom USING ({SITE})"""
CTES["o_expanded_trio"] = f"""
SELECT * FROM fx_reference FULL JOIN o_unphased_trio USING ({SITE}) LEFT JOIN o_parents USING ({SITE})"""


def _distances(cpgs: str, sites: str) -> str:
    """Distance of every distinct CpG position to the nearest site of its chromosome, by brute force."""
    return f"""
SELECT c.chrom, c.start_, c.end_, min(greatest(0, m.start_ - c.end_, c.start_ - m.end_)) AS distance
FROM (SELECT DISTINCT {SITE} FROM {cpgs}) c JOIN (SELECT DISTINCT chrom, start_, end_ FROM {sites}) m ON c.chrom = m.chrom
GROUP BY ALL"""


CTES["o_distance_fx"] = _distances("fx_cpg", "fx_mismatch")
CTES["o_distance"] = _distances("o_expanded", "o_mismatch")
CTES["o_distance_cohort"] = _distances("o_cohort_expanded", "o_mismatch_read")
CTES["o_distance_pat"] = _distances("o_expanded_trio", "o_mismatch_pat")
CTES["o_distance_mat"] = _distances("o_expanded_trio", "o_mismatch_mat")
CTES["o_near"] = f"""
SELECT o_expanded.*, distance < 50 AS is_within_50bp_of_mismatch_site
FROM o_expanded LEFT JOIN o_distance USING ({SITE})"""
CTES["o_near_cohort"] = f"""
SELECT o_cohort_expanded.*, distance < 50 AS is_within_50bp_of_mismatch_site
FROM o_cohort_expanded LEFT JOIN o_distance_cohort USING ({SITE})"""
CTES["o_near_trio"] = f"""
SELECT o_expanded_trio.*, p.distance < 50 AS is_within_50bp_of_mismatch_site_pat,
       m.distance < 50 AS is_within_50bp_of_mismatch_site_mat
FROM o_expanded_trio LEFT JOIN o_distance_pat p USING ({SITE}) LEFT JOIN o_distance_mat m USING ({SITE})"""

# Every chromosome has het sites at any scale, so these flags are never null.
CTES["o_distance_het"] = _distances("o_expanded", "o_snvs")
CTES["o_distance_het_pat"] = _distances("o_expanded_trio", "o_snvs_dad")
CTES["o_distance_het_mat"] = _distances("o_expanded_trio", "o_snvs_mom")
CTES["o_near_het"] = f"""
SELECT o_expanded.*, distance < 50 AS is_within_50bp_of_mismatch_site
FROM o_expanded LEFT JOIN o_distance_het USING ({SITE})"""
CTES["o_near_het_trio"] = f"""
SELECT o_expanded_trio.*, p.distance < 50 AS is_within_50bp_of_mismatch_site_pat,
       m.distance < 50 AS is_within_50bp_of_mismatch_site_mat
FROM o_expanded_trio LEFT JOIN o_distance_het_pat p USING ({SITE}) LEFT JOIN o_distance_het_mat m USING ({SITE})"""

CTES["o_variants"] = """
SELECT chrom, start_, end_, substr(split_part(gt_raw, ':', 1), 1, 1) AS allele_1, substr(split_part(gt_raw, ':', 1), 3, 1) AS allele_2
FROM fx_variant WHERE length(ref) = 1 AND len(list_filter(string_split(alt, ','), lambda a: length(a) <> 1)) = 0"""
CTES["o_variants_trio"] = f"""
SELECT {SITE}, {", ".join(f"substr(gt_{m}, {p}, 1) AS allele_{i}_{m}" for m in _HAPS for i, p in ((1, 1), (2, 3)))}
FROM fx_trio_snv WHERE length(ref) = 1"""


def genotype_class(a: str, b: str) -> str:
    return (
        f"CASE WHEN {a} IS NULL AND {b} IS NULL THEN '.' WHEN {a} = '.' OR {b} = '.' THEN '.' "
        f"WHEN {a} = {b} THEN 'hom' ELSE 'het' END"
    )


def labelled(cpgs: str, variants: str, alleles: list[str]) -> str:
    """One row per CpG and overlapping SNV, coordinates still 1 base wide."""
    return f"""
SELECT c.*, v.start_ AS start_variant, v.end_ AS end_variant, {", ".join(f"v.{a}" for a in alleles)}
FROM (SELECT *, row_number() OVER () AS cpg_row FROM {cpgs}) c
LEFT JOIN {variants} v ON c.chrom = v.chrom AND c.start_ < v.end_ AND v.start_ < c.end_ + 1"""


_TRIO_ALLELES = [f"allele_{i}_{m}" for m in _HAPS for i in (1, 2)]
CTES["o_labelled_fx"] = labelled("fx_cpg", "o_variants", ["allele_1", "allele_2"])
CTES["o_labelled_fx_trio"] = labelled("fx_cpg", "o_variants_trio", _TRIO_ALLELES)
CTES["o_labelled"] = labelled("o_near", "o_variants", ["allele_1", "allele_2"])
CTES["o_labelled_trio"] = labelled("o_near_trio", "o_variants_trio", _TRIO_ALLELES)
CTES["o_labelled_cohort"] = labelled("o_near_cohort", "o_variants", ["allele_1", "allele_2"])


def flagged(source: str, columns: list[str], roles: tuple[str, ...]) -> str:
    """Allele-specific flags per CpG row of a labelled CTE."""
    infix = [f"_{r}" if r else "" for r in roles]
    classes = ", ".join(f"{genotype_class(f'allele_1{i}', f'allele_2{i}')} AS g{n}" for n, i in enumerate(infix))
    order = "start_variant, " + ", ".join(f"g{n}" for n in range(len(roles)))
    flags = ", ".join(
        f"string_agg(g{n}, ',' ORDER BY {order}) AS snv_genotypes{i}, bool_or(g{n} = 'het') AS cpg_is_allele_specific{i}"
        for n, i in enumerate(infix)
    )
    picked = ", ".join(f"any_value({c}) AS {_cpg_name(c)}" for c in columns)
    return f"""
SELECT chrom, start_ AS start_cpg, end_ + 1 AS end_cpg, {picked}, {flags},
       string_agg(g0, ',' ORDER BY {order}) <> '.' AS cpg_overlaps_at_least_one_snv
FROM (SELECT *, {classes} FROM {source}) g GROUP BY cpg_row, chrom, start_, end_"""


def _cpg_name(column: str) -> str:
    return f"cpg_{column}" if column.startswith("is_within") else column


FOUNDER_VALUES = [c for c in _COMMON[3:]] + [
    f"methylation_level_{s}_{m}" for m in ("count", "model") for s in ("pat", "mat")
]
EXPANDED_VALUES = ["total_read_count", "methylation_level_count", "methylation_level_model", *FOUNDER_VALUES]
TRIO_VALUES = (
    [c for m in _HAPS for c in (f"total_read_count_{m}", f"methylation_level_{m}_count", f"methylation_level_{m}_model")]
    + [
        c
        for haps in _HAPS.values()
        for h in haps
        for c in (f"total_read_count_{h}", f"methylation_level_{h}_count", f"methylation_level_{h}_model")
    ]
    + ["start_hap_map_block_pat", "end_hap_map_block_pat", "paternal_haplotype", "paternal_concordance"]
    + ["num_het_SNVs_in_dad", "start_hap_map_block_mat", "end_hap_map_block_mat", "maternal_haplotype"]
    + ["maternal_concordance", "num_het_SNVs_in_mom"]
)


def fractions(source: str, conditions: dict[str, str], by: str = "") -> str:
    """``(metric, fraction)`` rows over the autosomes, for each value of ``by``."""
    if by:
        means = ", ".join(f"avg(CASE WHEN {c} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS {n}" for n, c in conditions.items())
        return f"""
SELECT {by}, metric, fraction FROM (UNPIVOT (SELECT {by}, {means} FROM {source} WHERE chrom NOT IN ('chrM', 'chrX', 'chrY') GROUP BY {by})
ON {", ".join(conditions)} INTO NAME metric VALUE fraction)"""
    means = ", ".join(f"avg(CASE WHEN {c} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS {n}" for n, c in conditions.items())
    return f"""
SELECT metric, fraction FROM (UNPIVOT (SELECT {means} FROM {source} WHERE chrom NOT IN ('chrM', 'chrX', 'chrY'))
ON {", ".join(conditions)} INTO NAME metric VALUE fraction)"""


def mode_conditions(first: str, second: str, unphased: str) -> dict[str, str]:
    out = {}
    for mode in ("count", "model"):
        a, b = f"methylation_level_{first}_{mode} IS NOT NULL", f"methylation_level_{second}_{mode} IS NOT NULL"
        out[f"{mode}_{first}"] = a
        out[f"{mode}_{second}"] = b
        out[f"{mode}_at_least_one_parental_haplotype"] = f"{a} OR {b}"
        out[f"{mode}_both_parental_haplotypes"] = f"{a} AND {b}"
        out[f"{mode}_unphased"] = f"methylation_level{unphased}_{mode} IS NOT NULL"
    return out


def renamed(source: str, drop: str = "") -> str:
    """A CTE's columns under the library's names."""
    gone = f", {drop}" if drop else ""
    return f'SELECT start_ AS start, end_ AS "end", * EXCLUDE (start_, end_{gone}) FROM {source}'


def sql(select: str) -> str:
    return with_views(select, CTES)
