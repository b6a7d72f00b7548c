"""The five jobs from files to files."""

import pytest

from haplometh.plans import expansion, founders, parents
from haplometh.sources import bed

VCF_HEADER = "#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT".split()


class Folder:
    def __init__(self, root):
        self.root = root

    def put(self, name, lines):
        path = self.root / name
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    def vcf(self, name, samples, calls):
        """``calls``: position to (format, one call per sample)."""
        body = ["\t".join(["chr1", str(p), ".", "A", "C", ".", ".", ".", *c]) for p, c in calls.items()]
        return self.put(name, ["##fileformat=VCFv4.2", "\t".join([*VCF_HEADER, *samples]), *body])

    def pileup(self, name, mode, cells):
        body = [f"chr1\t{s}\t{s + 1}\t{percent}\tTotal\t{cov}" for s, (percent, cov) in cells.items()]
        return self.put(name, [f"##pileup-mode={mode}", "#chrom\tbegin\tend\tmod_score\ttype\tcov", *body])


@pytest.fixture
def folder(tmp_path):
    return Folder(tmp_path)


CPGS = {105: (50.0, 8), 150: (75.0, 4), 900: (20.0, 5)}
OTHER = {105: (10.0, 6), 160: (30.0, 3)}


def founder_job(spark, folder):
    het = {p: ("GT:PS", f"{a}|{1 - a}:7") for p, a in ((101, 0), (111, 1), (121, 0), (131, 1))}
    iht = {p: ("GT", f"{a}|{1 - a}", "0/1") for p, a in ((101, 1), (111, 0), (121, 1), (131, 1))}
    return founders.phase_meth_to_founder_haps(
        spark,
        uid="kid",
        vcf_read_phased=folder.vcf("read.vcf", ["kid"], het),
        tsv_read_phase_blocks=folder.put(
            "blocks.tsv",
            ["source_block_index\tsample_name\tphase_block_id\tchrom\tstart\tend\tnum_variants", "0\tkid\t7\tchr1\t90\t400\t4"],
        ),
        vcf_iht_phased=folder.vcf("iht.vcf", ["kid", "dad"], iht),
        txt_iht_blocks=folder.put(
            "iht.txt", ["#chrom start end dad kid marker_count len markers", "chr1 100 300 X/Y A|E 4 200 m"]
        ),
        beds={
            ("count", "hap1"): folder.pileup("c1.bed", "count", CPGS),
            ("count", "hap2"): folder.pileup("c2.bed", "count", OTHER),
            ("model", "hap1"): folder.pileup("m1.bed", "model", CPGS),
            ("model", "hap2"): folder.pileup("m2.bed", "model", OTHER),
        },
        output_dir=str(folder.root / "out"),
    )


def test_founder_and_expansion_jobs(spark, rows, folder):
    job = founder_job(spark, folder)
    assert rows(job.hap_map) == [("chr1", 100, 300, "A_hap2", "E_hap1", 0.75, 4)]
    assert rows(job.mismatches) == [("chr1", 130, 131, "A", "C")] and job.sites.count() == 4
    assert {stage: n["rows"] for stage, n in job.counts.items()} == {"founder-snvs": 4, "founder-hap-map": 1, "founder-mismatches": 1, "founder-methylation": 4}
    assert job.counts["founder-hap-map"]["columns"] == 7
    levels = rows(job.methylation, "start", "methylation_level_pat_count", "methylation_level_mat_model", "total_read_count_pat")
    assert levels == [(105, 0.1, 0.5, 6), (150, None, 0.75, None), (160, 0.3, None, 3), (900, None, None, None)]

    out = folder.root / "out"
    back = bed.read_bed_and_header(spark, str(out / "kid.dna-methylation.bed"))
    assert back.columns == job.methylation.columns and rows(back) == rows(job.methylation)
    made = {p.name for p in out.iterdir()}
    assert {
        "kid.hap-map-blocks.bed",
        "kid.hap-map-blocks.paternal.bed",
        "kid.hap-map-blocks.maternal.bed",
        "kid.bit-vector-sites-mismatches.bed",
        "kid.bit-vector-sites-mismatches.vcf",
        "kid.dna-methylation.tracks",
    } <= made

    unphased = {105: (30.0, 14), 150: (75.0, 4), 160: (30.0, 3), 900: (20.0, 5)}
    common = dict(
        uid="kid",
        bed_all_cpgs_in_reference=folder.put("ref.bed", ["chr1\t105\t106", "chr1\t700\t701", "chrX\t5\t6"]),
        bed_meth_count_unphased=folder.pileup("cu.bed", "count", unphased),
        bed_meth_model_unphased=folder.pileup("mu.bed", "model", unphased),
        vcf_joint_called=folder.vcf("joint.vcf", ["kid"], {106: ("GT", "0/1"), 107: ("GT", "1/1"), 701: ("GT", "./.")}),
        bed_out=str(folder.root / "final.bed"),
    )
    done = expansion.expand_to_all_cpgs(
        spark,
        bed_meth_founder_phased=str(out / "kid.dna-methylation.bed"),
        bed_het_site_mismatches=str(out / "kid.bit-vector-sites-mismatches.bed"),
        **common,
    )
    assert len(done.table.columns) == 22
    assert {stage: n["rows"] for stage, n in done.counts.items()} == {"all-cpgs": 6, "phased-not-in-sites": 0, "expanded": 6}
    flags = ("start_cpg", "cpg_is_within_50bp_of_mismatch_site", "cpg_overlaps_at_least_one_snv", "snv_genotypes", "cpg_is_allele_specific")
    assert rows(done.table, *flags) == [
        (5, None, False, ".", False),
        (105, True, True, "het,hom", True),
        (150, True, False, ".", False),
        (160, True, False, ".", False),
        (700, False, False, ".", False),
        (900, False, False, ".", False),
    ]
    fractions = {r.metric: r.fraction for r in done.qc.collect()}
    assert fractions["within_50bp_of_mismatch"] == 3 / 5 and fractions["count_unphased"] == 4 / 5

    fewer = common | {"bed_meth_count_unphased": folder.pileup("cf.bed", "count", {105: (30.0, 14)}), "bed_meth_model_unphased": folder.pileup("mf.bed", "model", {105: (30.0, 14)})}
    lost = expansion.expand_to_all_cpgs(spark, bed_meth_founder_phased=str(out / "kid.dna-methylation.bed"), **fewer)
    assert lost.counts["phased-not-in-sites"] == {"rows": 3, "columns": 3}  # 150, 160 and 900

    damaged = folder.put("damaged.vcf", [*open(common["vcf_joint_called"]).read().splitlines(), "chr1\tx\t.\tA\tC\t.\t.\t.\tGT\t0/1", "chr1\t151\t.\tA\tC\t.\t.\t.\tGT"])
    aside = str(folder.root / "aside.parquet")
    again = expansion.expand_to_all_cpgs(
        spark, bed_meth_founder_phased=str(out / "kid.dna-methylation.bed"), damaged_variants_out=aside, **(common | {"vcf_joint_called": damaged})
    )
    assert again.counts["damaged-variants"]["rows"] == 2
    assert rows(spark.read.parquet(aside), "reason", "left_out") == [("9 fields, not 10", False), ("no whole-number position", True)]

    plain = expansion.expand_to_all_cpgs(spark, bed_meth_founder_phased=str(out / "kid.dna-methylation.bed"), **common)
    assert not any(r[0] for r in rows(plain.table, "cpg_is_within_50bp_of_mismatch_site"))
    assert expansion.expand_to_all_cpgs(spark, bed_meth_founder_phased=str(folder.root / "none.bed"), **common) is None


def test_parent_and_expansion_jobs(spark, rows, folder):
    ids = {"kid": "K", "dad": "D", "mom": "M"}
    calls = {
        p: ("GT", f"{k}|{1 - k}", f"{d}|{1 - d}", f"{m}|{1 - m}")
        for p, k, d, m in ((101, 0, 1, 1), (111, 1, 0, 0), (121, 0, 1, 1), (131, 1, 1, 0))
    }
    blocks = {
        m: folder.put(f"{m}.tsv", ["#sample\tchromosome\tphase_set\tfrom\tto\tvariants", f"{uid}\tchr1\t9\t91\t{400 - n}\t4"])
        for n, (m, uid) in enumerate(ids.items())
    }
    beds = {
        (m, mode, hap): folder.pileup(f"{m}{mode}{hap}.bed", mode, CPGS if hap == "hap1" else OTHER)
        for m in ids
        for mode in ("count", "model")
        for hap in ("hap1", "hap2")
    }
    out = folder.root / "trio"
    job = parents.phase_meth_to_parent_haps(
        spark,
        **{f"{m}_id": uid for m, uid in ids.items()},
        vcf_phased=folder.vcf("trio.vcf", list(ids.values()), calls),
        block_files=blocks,
        beds=beds,
        output_dir=str(out),
    )
    assert rows(job.hap_maps["pat"]) == [("chr1", 90, 399, "B", 0.75, 4)]
    assert rows(job.hap_maps["mat"]) == [("chr1", 90, 398, "C", 1.0, 4)]
    assert rows(job.mismatches["pat"], "start") == [(130,)] and job.mismatches["mat"].count() == 0
    assert len(job.methylation.columns) == 3 + 18 + 10
    assert {stage: n["rows"] for stage, n in job.counts.items()} == {
        "dad-snvs": 4, "dad-hap-map": 1, "dad-mismatches": 1, "mom-snvs": 4, "mom-hap-map": 1, "mom-mismatches": 0, "trio-methylation": 4
    }
    values = rows(job.methylation, "start", "methylation_level_kid_pat_count", "total_read_count_mom_D", "paternal_haplotype")
    assert values == [(105, 0.5, 6, "B"), (150, 0.75, None, "B"), (160, None, 3, "B"), (900, None, None, None)]
    tracks = [p for p in (out / "trio.dna-methylation.tracks").iterdir() if p.name.startswith("track=")]
    assert len(tracks) == 12

    # chr1 has no maternal mismatch, so its proximity would be unknown there; add one.
    mat = str(out / "K.bit-vector-sites-mismatches.maternal.bed")
    from haplometh.sinks import text

    text.write_bed_and_header(job.mismatches["pat"], mat)
    done = expansion.expand_to_all_cpgs_trio(
        spark,
        **{f"{m}_id": uid for m, uid in ids.items()},
        bed_all_cpgs_in_reference=folder.put("ref.bed", ["chr1\t105\t106", "chr1\t700\t701"]),
        beds_unphased={(m, mode): folder.pileup(f"{m}{mode}u.bed", mode, CPGS) for m in ids for mode in ("count", "model")},
        bed_meth_parent_phased=str(out / "trio.dna-methylation.bed"),
        bed_het_site_mismatches_pat=str(out / "K.bit-vector-sites-mismatches.paternal.bed"),
        bed_het_site_mismatches_mat=mat,
        vcf_joint_called=folder.vcf("joint.vcf", list(ids.values()), {106: ("GT", "0/0", "0/1", "1/1")}),
        bed_out=str(folder.root / "trio-final.bed"),
        output_dir=str(out),
    )
    assert len(done.table.columns) == 49 and done.qc.count() == 12
    row = done.table.filter("start_cpg = 105").first()
    assert (row.snv_genotypes_kid, row.snv_genotypes_dad, row.snv_genotypes_mom) == ("hom", "het", "hom")
    assert row.cpg_overlaps_at_least_one_snv and row.cpg_is_allele_specific_dad
    assert row.cpg_is_within_50bp_of_mismatch_site_pat
    assert len([p for p in (out / "combined.tracks").iterdir() if p.name.startswith("track=")]) == 6


def test_reference_job(spark, rows, folder):
    fasta = folder.put("ref.fa", [">chr10 x", "ACG", "CGA", ">chr2", "cg", ">chr1_random", "CG"])
    path = expansion.write_all_cpgs_in_reference(spark, fasta, str(folder.root / "cpgs.bed"))
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines == ["chr2\t0\t1", "chr10\t1\t2", "chr10\t3\t4"]
    assert rows(bed.read_all_cpgs_in_reference(spark, path)) == [("chr10", 1, 2), ("chr10", 3, 4), ("chr2", 0, 1)]
