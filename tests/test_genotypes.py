import pytest
from pyspark.sql import functions as F

from haplometh.functions import chroms, genotypes
from haplometh.functions import methylation as mfn
from haplometh.operators import ordering


def calls(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    gt = genotypes.genotype_text(F.col("raw"))
    a, b = genotypes.allele(gt, 0), genotypes.allele(gt, 1)
    out = df.select("i", a, b, genotypes.genotype_class(a, b), genotypes.is_het(a, b)).orderBy("i").collect()
    return [tuple(r)[1:] for r in out]


def test_genotype_classes(spark):
    assert calls(spark, "0|1:3", "1/1", "./.", None, "1", "0|.", "1/2:9:9", "") == [
        ("0", "1", "het", True),
        ("1", "1", "hom", False),
        (".", ".", ".", False),
        (None, None, ".", None),
        ("1", ".", ".", False),
        ("0", ".", ".", False),
        ("1", "2", "het", True),
        (".", ".", ".", False),
    ]


def test_snv_filters(spark):
    rows = [("AC", "G"), ("A", "G,T"), ("A", None), ("A", "GA"), ("A", "G"), ("A", "*")]
    df = spark.createDataFrame(rows, "REF string, ALT string")
    ref, alt = F.col("REF"), F.col("ALT")
    assert [r.ALT for r in df.filter(genotypes.is_biallelic_snv(ref, alt) & (ref == "A")).collect()] == ["G"]
    strict = {r.ALT for r in df.filter(genotypes.is_snv_any_alts(ref, alt)).collect()}
    assert strict == {"G,T", "G", "*"}


def test_letters_and_blocks(spark):
    df = spark.createDataFrame([("T", "A,C", "2", "77"), ("T", "A", ".", "-2147483648")], "r string, a string, i string, p string")
    out = df.select(
        genotypes.allele_letter(F.col("r"), F.col("a"), F.col("i")), genotypes.phase_block_id(F.col("p"))
    ).collect()
    assert [tuple(r) for r in out] == [("C", "77"), (".", ".")]


def test_contigs_and_version_sort(spark):
    names = ["chr10", "chrX", "chr2", "chrM", "chr1", "chrY", "chr1_X_random", "chrUn_1", "chrEBV"]
    df = spark.createDataFrame([(n, 5) for n in names] + [("chr2", 1)], "chrom string, start bigint")
    kept = ordering.version_sort(chroms.drop_alt_contigs(df)).collect()
    assert [tuple(r) for r in kept] == [
        ("chr1", 5), ("chr2", 1), ("chr2", 5), ("chr10", 5), ("chrM", 5), ("chrX", 5), ("chrY", 5),
    ]
    assert {r.chrom for r in df.filter(chroms.is_phasable()).collect()}.isdisjoint({"chrX", "chrY", "chrM"})


def test_level_logic_is_checked(spark):
    with pytest.raises(ValueError):
        mfn.level_is_reported(F.col("a"), F.col("b"), "some")


def test_seeded_sample_ignores_partitioning(spark, rows):
    df = spark.range(1000)
    once = rows(ordering.seeded_sample(df, 7, 42))
    assert once == rows(ordering.seeded_sample(df.repartition(13), 7, 42)) and len(once) == 7
    assert once != rows(ordering.seeded_sample(df, 7, 43))
