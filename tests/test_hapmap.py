import pytest
from pyspark.sql import functions as F

from haplometh.operators import hapmap, phasing

SNV = (
    "chrom string, start bigint, end bigint, REF string, ALT string, allele_hap1 string, allele_pat string, "
    "start_phase_block bigint, end_phase_block bigint, start_iht_block bigint, end_iht_block bigint, "
    "founder_label_pat_iht_block string, founder_label_mat_iht_block string"
)


def snvs(spark, hap1, pat, block=(100, 500), iht=(300, 900), at=310):
    rows = [
        ("chr1", at + i, at + i + 1, "A", "C", str(h), str(p), *block, *iht, "A", "E")
        for i, (h, p) in enumerate(zip(hap1, pat))
    ]
    return spark.createDataFrame(rows, SNV)


HAP1 = (0, 1, 0, 1, 1, 0, 1, 0)
SPEC = hapmap.founder_spec()


@pytest.mark.parametrize(
    "pat, labels, concordance, mismatches",
    [
        ((0, 1, 0, 1, 1, 0, 1, 1), ("A_hap1", "E_hap2"), 0.875, [317]),
        (tuple(1 - a for a in HAP1), ("A_hap2", "E_hap1"), 1.0, []),
        # A tie takes the opposite orientation, so the agreeing sites are the mismatches.
        ((0, 1, 0, 1, 0, 1, 0, 1), ("A_hap2", "E_hap1"), 0.5, [310, 311, 312, 313]),
    ],
)
def test_concordance(spark, rows, pat, labels, concordance, mismatches):
    table = snvs(spark, HAP1, pat)
    assert rows(hapmap.hap_map(table, SPEC)) == [("chr1", 300, 500, *labels, concordance, 8)]
    assert [r[0] for r in rows(hapmap.mismatch_sites(table, SPEC), "start")] == mismatches


def test_mismatches_add_up(spark):
    table = snvs(spark, (0, 1, 1, 0, 1), (0, 1, 0, 0, 1)).union(
        snvs(spark, (1, 1, 0), (0, 0, 0), block=(600, 800), at=650)
    )
    expected = hapmap.hap_map(table, SPEC).agg(
        F.sum(F.round(F.col("num_het_SNVs") * (1 - F.col("haplotype_concordance"))))
    ).first()[0]
    assert hapmap.mismatch_sites(table, SPEC).count() == expected == 2
    assert hapmap.het_sites(table).count() == 8


def test_parent_map_labels(spark, rows):
    schema = (
        "chrom string, start bigint, end bigint, REF string, ALT string, kid_allele_mat string, mom_allele_C string, "
        "start_phase_block_kid bigint, end_phase_block_kid bigint, start_phase_block_mom bigint, end_phase_block_mom bigint"
    )
    same = [("chr1", i, i + 1, "A", "C", "1", "1", 0, 90, 5, 80) for i in (10, 11)]
    other = [("chr2", i, i + 1, "A", "C", "1", "0", 0, 90, 5, 80) for i in (10, 11)]
    out = hapmap.hap_map(spark.createDataFrame(same + other, schema), hapmap.parent_spec("mom"))
    assert rows(out) == [("chr1", 5, 80, "C", 1.0, 2), ("chr2", 5, 80, "D", 1.0, 2)]


def test_founder_phasing_joins(spark, rows):
    site = "chrom string, start bigint, end bigint, REF string, ALT string, "
    read = spark.createDataFrame(
        [
            ("chr1", 10, 11, "A", "C", "7", "0", "1"),
            ("chr1", 20, 21, "A", "C", ".", "0", "1"),
            ("chr1", 30, 31, "A", "C", "7", "1", "0"),
        ],
        site + "phase_block_id string, allele_hap1 string, allele_hap2 string",
    )
    blocks = spark.createDataFrame(
        [(0, "s", "7", "chr1", 5, 60, 3)],
        "source_block_index bigint, sample_name string, phase_block_id string, chrom string, start bigint, "
        "end bigint, num_variants bigint",
    )
    iht = spark.createDataFrame(
        [("chr1", 10, 11, "A", "C", "0", "1"), ("chr1", 30, 31, "A", "G", "1", "0")],
        site + "allele_pat string, allele_mat string",
    )
    iht_blocks = spark.createDataFrame(
        [("chr1", 0, 15, "A", "E")],
        "chrom string, start bigint, end bigint, founder_label_pat string, founder_label_mat string",
    )
    out = phasing.founder_phasing(read, blocks, iht, iht_blocks)
    assert len(out.columns) == 15
    kept = rows(out, "start", "start_phase_block", "end_phase_block", "end_iht_block", "founder_label_pat_iht_block")
    assert kept == [(10, 5, 60, 15, "A")]
