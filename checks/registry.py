"""Every registered query: a Spark callable and, where SQL can say it, its oracle."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle as o
from checks.views import pileup_names, spark_pileups, spark_view, table
from haplometh.functions import chroms, genotypes
from haplometh.functions import methylation as mfn
from haplometh.operators import expand, hapmap, inspection, intervals, joins, methylation, ordering, phasing, qc
from haplometh.plans import cohort as cohort_jobs
from haplometh.plans import expansion
from haplometh.sinks import clustered as clustered_sink
from haplometh.sinks import text
from haplometh.sources import bed, blocks, clustered, genome, reports, samples, vcf
from haplometh.storage import SITE_CODEC, materialize, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BIN = 1 << 14  # near the width of the views' blocks
MEMBERS = methylation.MEMBERS
HAPLOTYPES = ("hap1", "hap2")


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = o.sql(sql)
        return query

    return add


def as_variants(sites: DataFrame, fmt: Column, calls: list[Column]) -> DataFrame:
    """Sites under the column names of a variant file."""
    dot = F.lit(".")
    fixed = [F.col("chrom"), F.col("end").cast("string"), dot, F.col("REF"), F.col("ALT"), dot, dot, dot, fmt]
    return sites.select(*[c.alias(n) for c, n in zip(fixed, vcf.FIXED_COLUMNS)], *calls)


def through_lines(variants: DataFrame) -> DataFrame:
    """The same variants after being spelled out as lines and parsed again."""
    lines = variants.select(F.concat_ws("\t", *[F.col(f"`{c}`") for c in variants.columns]).alias("value"))
    return vcf.variants_from_lines(lines, "\t".join(variants.columns))


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder for what a query writes and reads back."""
    return f"{shared_folder(spark).rstrip('/')}/checks-{uuid.uuid4().hex}/{name}"


class Inputs:
    """The library's inputs, built from one data folder.

    With ``staged``, SNV tables, hap maps and mismatch sites are written once
    and read back, as the jobs in ``haplometh.plans`` do. The pileups of ``members``, of
    ``pileups`` haplotypes, are then built by one scan, and each file is a scan of that.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        staged: bool = False,
        pileups: tuple[str, ...] = ("hap1", "hap2", "combined"),
        members: tuple[str, ...] = ("kid",),
    ):
        self.spark, self.folder, self.staged, self.pileups, self.members = spark, folder, staged, pileups, members
        self.steps: dict[str, DataFrame] = {}

    def step(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.steps:
            self.steps[name] = materialize(build(), name, compression=SITE_CODEC) if self.staged else build()
        return self.steps[name]

    def view(self, name: str) -> DataFrame:
        return spark_view(self.spark, self.folder, name)

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    def read_blocks(self) -> DataFrame:
        return self.view("fx_phase_block").withColumn("phase_block_id", F.col("phase_block_id").cast("string"))

    def founder_snvs(self) -> DataFrame:
        def build() -> DataFrame:
            sides = self.view("fx_read"), self.read_blocks(), self.view("fx_iht"), self.view("fx_iht_block")
            return phasing.founder_phasing(*sides, bin_size=BIN)

        return self.step("founder-snvs", build)

    def hap_map(self) -> DataFrame:
        return self.step("founder-map", lambda: hapmap.hap_map(self.founder_snvs(), hapmap.founder_spec()))

    def mismatches(self) -> DataFrame:
        return self.step(
            "founder-mismatches", lambda: hapmap.mismatch_sites(self.founder_snvs(), hapmap.founder_spec())
        )

    def pileup(self, member: str, mode: str, hap: str) -> DataFrame:
        if not self.staged or hap not in self.pileups:
            return self.view(f"fx_{member}_{mode}_{hap}")
        members = self.members if member in self.members else (member,)
        files = self.step(
            f"{'-'.join(members)}-pileups", lambda: spark_pileups(self.spark, self.folder, members, self.pileups)
        )
        name = (member, mode, hap)
        values = {f"{kind}_{'_'.join(name)}": c for kind, c in (("reads", "total_read_count"), ("level", "methylation_level"))}
        held = F.getbit("files", F.lit(pileup_names(members, self.pileups).index(name))) == 1
        return files.filter(held).select("chrom", "start", "end", *[F.col(c).alias(n) for c, n in values.items()])

    def haplotypes(self, member: str, mode: str) -> DataFrame:
        return methylation.join_haplotypes(self.pileup(member, mode, "hap1"), self.pileup(member, mode, "hap2"))

    def founder(self) -> DataFrame:
        files = {(m, h): self.pileup("kid", m, h) for m in methylation.MODES for h in ("hap1", "hap2")}
        return methylation.founder_phased_methylation(files, self.hap_map(), bin_size=BIN)

    def trio_calls(self) -> DataFrame:
        """The trio's variants with the columns of a variant file."""
        calls = [F.col(f"gt_{m}").alias(m) for m in MEMBERS]
        return as_variants(self.view("fx_trio_snv"), F.lit("GT"), calls)

    def trio_pairs(self) -> dict[str, DataFrame]:
        return dict(zip(("dad", "mom"), vcf.trio_pairs(self.trio_calls(), *MEMBERS)))

    def parent_snvs(self, parent: str) -> DataFrame:
        def build() -> DataFrame:
            sides = self.trio_pairs()[parent], self.view("fx_kid_block"), self.view(f"fx_{parent}_block")
            return phasing.parent_phasing(*sides, parent, bin_size=BIN)

        return self.step(f"{parent}-snvs", build)

    def parent_map(self, parent: str) -> DataFrame:
        spec = hapmap.parent_spec(parent)
        return self.step(f"{parent}-map", lambda: hapmap.hap_map(self.parent_snvs(parent), spec))

    def parent_mismatches(self, parent: str) -> DataFrame:
        spec = hapmap.parent_spec(parent)
        return self.step(f"{parent}-mismatches", lambda: hapmap.mismatch_sites(self.parent_snvs(parent), spec))

    def trio_files(self) -> dict[tuple[str, str, str], DataFrame]:
        return {(p, m, h): self.pileup(p, m, h) for p in MEMBERS for m in methylation.MODES for h in ("hap1", "hap2")}

    def trio_sites(self) -> DataFrame:
        return methylation.trio_methylation(self.trio_files())

    def parents(self) -> DataFrame:
        return methylation.parent_phased_methylation(
            self.trio_files(), self.parent_map("dad"), self.parent_map("mom"), bin_size=BIN
        )

    def joint_calls(self) -> DataFrame:
        return as_variants(self.view("fx_variant"), F.lit("GT:AD:DP"), [F.col("gt_raw").alias("kid")])

    def variants(self) -> DataFrame:
        return vcf.joint_variants(self.joint_calls(), {"": "kid"})

    def trio_variants(self) -> DataFrame:
        return vcf.joint_variants(self.trio_calls(), {m: m for m in MEMBERS})

    def combined(self, member: str, mode: str) -> DataFrame:
        return self.pileup(member, mode, "combined")

    def expanded(self) -> DataFrame:
        sites = expand.all_sites_founder(
            self.view("fx_reference"), self.combined("kid", "count"), self.combined("kid", "model")
        )
        return expand.attach_phased(sites, self.founder(), words=True)

    def near(self) -> DataFrame:
        return expand.flag_proximity(self.expanded(), self.mismatches())

    def expanded_trio(self) -> DataFrame:
        files = {(p, m): self.combined(p, m) for p in MEMBERS for m in methylation.MODES}
        sites = expand.all_sites_trio(self.view("fx_reference"), files)
        return expand.attach_phased(sites, self.parents(), words=True)

    def near_trio(self) -> DataFrame:
        df = expand.flag_proximity(self.expanded_trio(), self.parent_mismatches("dad"), "_pat")
        return expand.flag_proximity(df, self.parent_mismatches("mom"), "_mat")


# ---------------------------------------------------------------- sources

PILEUP_NAMES = ("#chrom", "begin", "end", "mod_score", "type", "cov", "est_mod_count")


@register(
    "s1_meth_level",
    f"SELECT {o.OUT_SITE}, total_read_count, methylation_level/100 AS methylation_level FROM fx_kid_count_combined",
)
def s1(spark, folder):
    fields = ["chrom", "start", "end", "methylation_level", F.lit("Total"), "total_read_count", F.lit(0)]
    lines = Inputs(spark, folder).combined("kid", "count").select(F.concat_ws("\t", *fields).alias("value"))
    comments = ["##pileup-mode=count", "\t".join(PILEUP_NAMES)]
    return bed.meth_levels(bed.pileup_from_lines(lines, bed.check_pileup_header(comments, "count")))


@register("s2_k1_bed_roundtrip", f"SELECT {o.OUT_SNV} FROM o_mismatch")
def s2(spark, folder):
    path = text.write_bed_and_header(Inputs(spark, folder).mismatches(), scratch(spark, "mismatches.bed"))
    return bed.read_bed_and_header(spark, path)


@register("s3_k3_described_bed_roundtrip", o.renamed("o_hap_map"))
def s3(spark, folder):
    path = scratch(spark, "hap-map-described.bed")
    text.write_dataframe_to_bed(Inputs(spark, folder).hap_map(), path, "checks")
    return bed.read_dataframe_from_bed(spark, path)


_FINAL_OUT = o.flagged("o_labelled", [*o.EXPANDED_VALUES, "is_within_50bp_of_mismatch_site"], ("",))
_FINAL_TRIO_OUT = o.flagged(
    "o_labelled_trio",
    [*o.TRIO_VALUES, "is_within_50bp_of_mismatch_site_pat", "is_within_50bp_of_mismatch_site_mat"],
    MEMBERS,
)


@register(
    "s4_k8_final_table_roundtrip",
    f'SELECT start_cpg AS start, end_cpg AS "end", * EXCLUDE (start_cpg, end_cpg) FROM ({_FINAL_OUT}) f',
)
def s4(spark, folder):
    i = Inputs(spark, folder, staged=True)
    final = expand.flag_allele_specific(i.near(), i.variants())
    root = text.write_methylation(final, scratch(spark, "final.bed"), "checks")
    return bed.read_expanded(spark, f"{root}.sorted.bed.gz")


@register("s5_reference_cpgs_roundtrip", f"SELECT {o.OUT_SITE} FROM fx_reference")
def s5(spark, folder):
    path = scratch(spark, "reference.bed")
    text.write_table(Inputs(spark, folder).view("fx_reference"), path)
    return bed.read_all_cpgs_in_reference(spark, path)


_READ_VCF = """
SELECT s.*, CASE WHEN phase_block_id % 5 = 0 THEN 'GT' ELSE 'GT:DP:PS' END AS format,
       CASE WHEN gt_raw LIKE '0|1%' AND allele_hap1 = 1 THEN '1|0' ELSE split_part(gt_raw, ':', 1) END
       || CASE WHEN phase_block_id % 5 = 0 THEN '' WHEN phase_block_id % 7 = 0 THEN ':12:.'
               ELSE ':12:' || CAST(phase_block_id AS STRING) END AS call
FROM fx_snv s"""
o.CTES["o_read_vcf"] = _READ_VCF


@register(
    "s6_read_phasing",
    f"""SELECT {o.OUT_SNV}, CASE WHEN phase_block_id % 5 = 0 OR phase_block_id % 7 = 0 THEN '.'
        ELSE CAST(phase_block_id AS STRING) END AS phase_block_id,
        CAST(allele_hap1 AS STRING) AS allele_hap1, CAST(1 - allele_hap1 AS STRING) AS allele_hap2
        FROM o_read_vcf WHERE length(ref) = 1 AND length(alt) = 1 AND gt_raw LIKE '0|1%'""",
)
def s6(spark, folder):
    block, first = F.col("phase_block_id"), F.split_part("gt_raw", F.lit(":"), F.lit(1))
    call = F.when((first == "0|1") & (F.col("allele_hap1") == 1), "1|0").otherwise(first)
    rest = (
        F.when(block % 5 == 0, "").when(block % 7 == 0, ":12:.").otherwise(F.concat(F.lit(":12:"), block.cast("string")))
    )
    fmt = F.when(block % 5 == 0, "GT").otherwise("GT:DP:PS")
    calls = as_variants(Inputs(spark, folder).view("fx_snv"), fmt, [F.concat(call, rest).alias("kid")])
    return vcf.read_phasing(through_lines(calls))


@register(
    "s7_inheritance_phasing",
    f"""SELECT {o.OUT_SNV}, CAST(allele_pat AS STRING) AS allele_pat, CAST(1 - allele_pat AS STRING) AS allele_mat
        FROM fx_snv WHERE length(ref) = 1 AND length(alt) = 1 AND gt_raw LIKE '0|1%'""",
)
def s7(spark, folder):
    pat = F.col("allele_pat")
    het = F.concat_ws("|", pat.cast("string"), (1 - pat).cast("string"))
    call = F.when(F.col("gt_raw").startswith("0|1"), het).when(F.col("gt_raw").startswith("1/1"), "1/1").otherwise("./.")
    calls = [F.lit("0/1:9").alias("other"), F.concat(call, F.lit(":30")).alias("kid")]
    variants = as_variants(Inputs(spark, folder).view("fx_snv"), F.lit("GT:DP"), calls)
    return vcf.inheritance_phasing(through_lines(variants), "kid")


for _parent, _side in (("dad", "pat"), ("mom", "mat")):
    _names = {"dad": "dad_allele_A, dad_allele_B, kid_allele_pat", "mom": "mom_allele_C, mom_allele_D, kid_allele_mat"}

    @register(f"s8_trio_pairs_{_parent}", f"SELECT {o.OUT_SNV}, {_names[_parent]} FROM o_pairs_{_parent}")
    def s8(spark, folder, parent=_parent):
        pairs = vcf.trio_pairs(through_lines(Inputs(spark, folder).trio_calls()), *MEMBERS)
        return dict(zip(("dad", "mom"), pairs))[parent]


for _parent, _names in {"dad": "dad_allele_A, dad_allele_B, kid_allele_pat", "mom": "mom_allele_C, mom_allele_D, kid_allele_mat"}.items():

    @register(f"s8_trio_file_{_parent}", f"SELECT {o.OUT_SNV}, {_names} FROM o_pairs_{_parent}")
    def s8_file(spark, folder, parent=_parent):
        """Through a variant file that is scanned once for both parents."""
        calls = Inputs(spark, folder).trio_calls()
        path = scratch(spark, "trio.vcf")
        text.write_lines(calls, path, [text.VCF_FORMAT_LINE, "\t".join(calls.columns)], {"name": F.col("`#CHROM`"), "at": F.col("POS").cast("bigint")})
        return dict(zip(("dad", "mom"), vcf.read_trio_pairs(spark, path, *MEMBERS)))[parent]


@register("s9_joint_variants", f"SELECT {o.OUT_SITE}, allele_1, allele_2 FROM o_variants")
def s9(spark, folder):
    return vcf.joint_variants(through_lines(Inputs(spark, folder).joint_calls()), {"": "kid"})


_DAMAGED_POS = "CASE WHEN start_ % 11 = 0 THEN 'x' ELSE '' END || (start_ + 1)"
_DAMAGED_TAIL = "CASE WHEN start_ % 13 = 0 THEN '' ELSE chr(9) || gt_raw END"


@register(
    "s9_damaged_rows",
    f"""SELECT CASE WHEN start_ % 11 = 0 THEN 'no whole-number position' ELSE '9 fields, not 10' END AS reason, start_ % 11 = 0 AS left_out,
        concat_ws(chr(9), chrom, {_DAMAGED_POS}, '.', ref, alt, '.', '.', '.', 'GT:AD:DP') || {_DAMAGED_TAIL} AS line
        FROM fx_variant WHERE start_ % 11 = 0 OR start_ % 13 = 0""",
)
def s9_damaged(spark, folder):
    """A file with bad positions and missing fields; what the tolerant reader passes over."""
    calls = Inputs(spark, folder).joint_calls()
    end = F.col("POS").cast("bigint")
    broken = calls.withColumn("POS", F.when((end - 1) % 11 == 0, F.concat(F.lit("x"), "POS")).otherwise(F.col("POS")))
    whole = F.concat_ws("\t", *[F.col(f"`{c}`") for c in broken.columns])
    short = F.concat_ws("\t", *[F.col(f"`{c}`") for c in broken.columns[:-1]])
    lines = broken.select(F.when((F.regexp_replace("POS", "x", "").cast("bigint") - 1) % 13 == 0, short).otherwise(whole).alias("line"))
    path = scratch(spark, "damaged.vcf")
    text.write_lines(lines, path, [text.VCF_FORMAT_LINE, "\t".join(calls.columns)], {"at": F.col("line")})
    return vcf.read_damaged_variants(spark, path).drop("file")


@register("s10_joint_variants_trio", o.renamed("o_variants_trio"))
def s10(spark, folder):
    return vcf.joint_variants(through_lines(Inputs(spark, folder).trio_calls()), {m: m for m in MEMBERS})


@register(
    "s11_read_phase_blocks",
    f"SELECT {o.OUT_SITE}, phase_block_id AS source_block_index, 'kid' AS sample_name, "
    "CAST(phase_block_id AS STRING) AS phase_block_id, num_variants FROM fx_phase_block",
)
def s11(spark, folder):
    names = "source_block_index sample_name phase_block_id chrom start end num_variants".split()
    rows = Inputs(spark, folder).view("fx_phase_block").withColumns(
        {"source_block_index": F.col("phase_block_id"), "sample_name": F.lit("kid")}
    )
    return blocks.read_blocks_from_lines(rows.select(F.concat_ws("\t", *names).alias("value")), "\t".join(names))


@register(
    "s12_trio_phase_blocks",
    f"SELECT {o.OUT_SITE}, CAST(phase_set AS STRING) AS phase_block_id, num_variants FROM fx_dad_block",
)
def s12(spark, folder):
    i = Inputs(spark, folder)
    lines = None
    for member in MEMBERS:
        fields = [F.lit(member), "chrom", "phase_set", F.col("start") + 1, "end", "num_variants"]
        part = i.view(f"fx_{member}_block").select(F.concat_ws("\t", *fields).alias("value"))
        lines = part if lines is None else lines.union(part)
    return blocks.sample_blocks_from_lines(lines, "#sample\tchromosome\tphase_set\tfrom\tto\tvariants", "dad")


@register(
    "s13_inheritance_blocks",
    f"""SELECT {o.OUT_SITE}, CASE WHEN founder_label_mat = 'F' THEN '?' ELSE founder_label_pat END AS founder_label_pat,
        CASE WHEN founder_label_pat IN ('A', 'B') THEN '?' ELSE founder_label_mat END AS founder_label_mat
        FROM fx_iht_block WHERE NOT (founder_label_mat = 'F' AND founder_label_pat IN ('A', 'B'))""",
)
def s13(spark, folder):
    pat, mat = F.col("founder_label_pat"), F.col("founder_label_mat")
    label = F.concat_ws(
        "|", F.when(mat == "F", "?").otherwise(pat), F.when(pat.isin("A", "B"), "?").otherwise(mat)
    )
    fields = ["chrom", "start", "end", F.lit("X/Y"), label, F.lit("10"), F.lit("5"), F.lit("a,b")]
    lines = Inputs(spark, folder).view("fx_iht_block").select(F.concat_ws(" ", *fields).alias("value"))
    header = "#chrom start end founder kid marker_count len markers"
    return blocks.inheritance_blocks_from_lines(lines, blocks.inheritance_samples(header), "kid")


#: Sites of every sequence, whose first base is at ``BASE``.
_CG_SITES = """SELECT chrom, BASE + at_ AS start, BASE + at_ + 1 AS "end" FROM (
        SELECT chrom, offset_, part_no, parts,
               CAST(sum(length(part) + 2) OVER (PARTITION BY chrom ORDER BY part_no) - 2 AS BIGINT) AS at_
        FROM (SELECT chrom, offset_, len(pieces) AS parts, unnest(pieces) AS part,
                     generate_subscripts(pieces, 1) AS part_no
              FROM (SELECT chrom, offset_, string_split(upper(seq), 'CG') AS pieces FROM fx_sequence) s) p) q
       WHERE part_no < parts"""


@register("s14_e5_cpg_scan", _CG_SITES.replace("BASE", "offset_"))
def s14(spark, folder):
    return genome.cpg_sites(Inputs(spark, folder).view("fx_sequence"))


@register("e5_fasta_job", _CG_SITES.replace("BASE", "0"))
def e5_job(spark, folder):
    """The reference job on FASTA files with one line a chromosome, read back from its output."""
    sequence = F.regexp_replace("seq", "[^A-Za-z]", "N")
    records = Inputs(spark, folder).view("fx_sequence").select(F.concat(F.lit(">"), "chrom", F.lit(" x\n"), sequence).alias("value"))
    root = scratch(spark, "reference")
    records.write.text(f"{root}/fasta")
    return bed.read_all_cpgs_in_reference(spark, expansion.write_all_cpgs_in_reference(spark, f"{root}/fasta", f"{root}/cpgs.bed"))


QC_LABEL = "share of sites (count, one haplotype or both)"


@register(
    "s15_qc_logs",
    """SELECT CAST(c_custkey AS STRING) AS sample_id,
       CAST(c_nationkey AS DOUBLE) + 0.25 AS percentage_of_cpg_sites
       FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def s15(spark, folder):
    uid = F.col("c_custkey").cast("string")
    path = F.concat(F.lit("INFO args {'bed': '/data/"), uid, F.lit(".dna-methylation.founder-phased.all_cpgs.bed'}"))
    first = F.concat(F.lit(f"INFO {QC_LABEL}: "), F.lit("1.00%"))
    last = F.concat(F.lit(f"INFO {QC_LABEL}: "), F.col("c_nationkey").cast("string"), F.lit(".25%"))
    done = F.when(F.col("c_mktsegment") != "BUILDING", F.concat_ws("\n", path, first, last)).otherwise(path)
    logs = Inputs(spark, folder).table("customer").select(done.alias("value"))
    return reports.percentages_from_texts(logs, QC_LABEL)


_SAMPLES = """
SELECT c_custkey AS link_id, CASE WHEN c_nationkey < 12 THEN c_custkey + 12000 END AS coriell,
       c_mktsegment AS gender, CASE WHEN c_acctbal > 0 THEN 'betas/' || c_name || '.csv' END AS array_path
FROM customer"""
_AGES = """
SELECT s_suppkey AS link_id, s_acctbal AS age,
       CASE WHEN s_nationkey < 8 THEN '1st gen' WHEN s_nationkey < 22 THEN '2nd' END AS generation
FROM supplier"""
o.CTES["o_samples"], o.CTES["o_ages"] = _SAMPLES, _AGES
o.CTES["o_manifest"] = """
SELECT CAST(link_id AS STRING) AS uid,
       coalesce('NA' || CAST(coriell AS STRING), CAST(link_id AS STRING)) AS prefix, gender, age, generation,
       replace(array_path, '.csv', '.unique.sorted.bed') AS array_path
FROM o_samples FULL JOIN o_ages USING (link_id) WHERE generation NOT LIKE '1st%'"""


def _manifest(spark, folder):
    i = Inputs(spark, folder)
    people = i.table("customer").select(
        F.col("c_custkey").alias("LINK ID"),
        F.when(F.col("c_nationkey") < 12, F.col("c_custkey") + 12000).alias("Coriell ID"),
        F.col("c_mktsegment").alias("Gender"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("betas/"), "c_name", F.lit(".csv"))).alias(samples.ARRAY_COLUMN),
    )
    generation = F.when(F.col("s_nationkey") < 8, "1st gen").when(F.col("s_nationkey") < 22, "2nd")
    ages = i.table("supplier").select(
        F.col("s_suppkey").alias("LINK ID"),
        F.col("s_acctbal").alias("Age at blood draw"),
        generation.alias("Generation?"),
    )
    return samples.manifest(people, ages)


@register("s16_j16_manifest", "SELECT * FROM o_manifest")
def s16(spark, folder):
    return _manifest(spark, folder)


@register(
    "s16_methylation_paths",
    """SELECT m.*, mode, haplotype, 'data/' || mode || '/' || prefix || CASE WHEN mode = 'model'
       THEN '.GRCh38.' || haplotype || '.sorted.bed.gz' ELSE '.GRCh38.haplotagged.' || haplotype || '.bed.gz' END AS path
       FROM o_manifest m, (SELECT unnest(['count', 'model']) AS mode) a,
            (SELECT unnest(['hap1', 'hap2', 'combined']) AS haplotype) b""",
)
def s16_paths(spark, folder):
    return samples.methylation_paths(_manifest(spark, folder), {m: f"data/{m}" for m in methylation.MODES})


REGION = "chr1:100,001-400,000"


@register(
    "s17_region",
    o.renamed("fx_cpg") + " WHERE chrom = 'chr1' AND end_ > 100000 AND start_ < 400000",
)
def s17(spark, folder):
    return intervals.region_filter(Inputs(spark, folder).view("fx_cpg"), REGION)


# ---------------------------------------------------------------- sinks


@register("s17_k8_clustered_region", o.renamed("o_founder") + " WHERE chrom = 'chr7' AND end_ > 19999 AND start_ < 60000")
def s17_clustered(spark, folder):
    """The region out of a clustered table: its zones choose the files."""
    path = scratch(spark, "clustered.parquet")
    clustered_sink.write_clustered(Inputs(spark, folder, staged=True, pileups=HAPLOTYPES).founder(), path, files=16)
    return clustered.read_region(spark, path, "chr7:20,000-60,000")


@register(
    "k5_mismatch_vcf_rows",
    """SELECT concat_ws(chr(9), chrom, CAST(start_ + 1 AS STRING), '.', ref, alt, '.', '.', '.', '.', '.') AS line
       FROM o_mismatch""",
)
def k5(spark, folder):
    path = scratch(spark, "mismatches.vcf")
    text.write_vcf(Inputs(spark, folder).mismatches(), path, "kid")
    return spark.read.text(path).filter(~F.col("value").startswith("#")).withColumnRenamed("value", "line")


@register(
    "k6_hap_map_blocks",
    " UNION ALL ".join(f"SELECT {o.OUT_SITE}, {p}_haplotype AS haplotype, '{p}' AS parent FROM o_hap_map" for p in ("paternal", "maternal")),
)
def k6(spark, folder):
    """Both parents' block files, read back."""
    blocks_of, root = Inputs(spark, folder, staged=True).hap_map(), scratch(spark, "blocks")
    sides = []
    for parental in ("paternal", "maternal"):
        path = text.write_hap_map_blocks(blocks_of, root, "kid", parental)
        back = bed.read_bed_and_header(spark, path).withColumnRenamed(f"{parental}_haplotype", "haplotype")
        sides.append(back.withColumn("parent", F.lit(parental)))
    return sides[0].unionByName(sides[1])


@register(
    "k4_mismatch_files",
    " UNION ALL ".join(
        f"SELECT {o.OUT_SNV}, '{parental}' AS parental FROM o_mismatch_{side}" for side, parental in (("pat", "paternal"), ("mat", "maternal"))
    ),
)
def k4(spark, folder):
    """Each parent's mismatch sites through the files the trio job writes."""
    i, root = Inputs(spark, folder, staged=True), scratch(spark, "mismatches")
    sides = []
    for parent, parental in (("dad", "paternal"), ("mom", "maternal")):
        path = text.write_mismatches(i.parent_mismatches(parent), root, "kid", parental)
        sides.append(bed.read_bed_and_header(spark, path).withColumn("parental", F.lit(parental)))
    return sides[0].unionByName(sides[1])


def _union_tracks(source: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {o.OUT_SITE}, {c} AS value, '{t}' AS track FROM {source} WHERE {c} IS NOT NULL"
        for t, c in columns.items()
    )


_IDS = {m: f"id_{m}" for m in MEMBERS}


@register("k7_founder_tracks", _union_tracks("o_founder", text.founder_track_columns()))
def k7(spark, folder):
    return text.tracks(Inputs(spark, folder, staged=True, pileups=HAPLOTYPES).founder(), text.founder_track_columns())


@register("k7_trio_tracks", _union_tracks("o_parents", text.trio_track_columns(_IDS)))
def k7_trio(spark, folder):
    return text.tracks(Inputs(spark, folder, staged=True, members=MEMBERS, pileups=HAPLOTYPES).parents(), text.trio_track_columns(_IDS))


@register("k2_k7_combined_tracks", _union_tracks("o_unphased_trio", text.combined_track_columns(_IDS)))
def k7_combined(spark, folder):
    i = Inputs(spark, folder, staged=True, members=MEMBERS, pileups=("combined",))
    unphased = expand.unphased_trio({(p, m): i.combined(p, m) for p in MEMBERS for m in methylation.MODES})
    path = scratch(spark, "combined.tracks")
    text.write_tracks_of(unphased, text.combined_track_columns(_IDS), path, compression="gzip")
    schema = "chrom string, start bigint, end bigint, value double, track string"
    return spark.read.csv(path, sep="\t", schema=schema)


o.CTES["o_contigs"] = """
SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'chr' || CAST(o_custkey % 22 AS STRING) || '_KI27_random'
            WHEN o_orderpriority = '2-HIGH' THEN 'chrUn_GL' || CAST(o_custkey AS STRING)
            WHEN o_orderstatus = 'P' THEN 'chrEBV' WHEN o_orderstatus = 'F' AND o_custkey % 9 = 0 THEN 'chrX'
            WHEN o_custkey % 8 = 0 THEN 'chrM' ELSE 'chr' || CAST(1 + o_custkey % 22 AS STRING) END AS chrom,
       o_orderkey AS start_, o_orderkey + 1 AS end_
FROM orders"""


def _contigs(spark, folder):
    key, status = F.col("o_custkey"), F.col("o_orderstatus")
    chrom = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.format_string("chr%d_KI27_random", key % 22))
        .when(F.col("o_orderpriority") == "2-HIGH", F.format_string("chrUn_GL%d", key))
        .when(status == "P", "chrEBV")
        .when((status == "F") & (key % 9 == 0), "chrX")
        .when(key % 8 == 0, "chrM")
        .otherwise(F.format_string("chr%d", 1 + key % 22))
    )
    at = F.col("o_orderkey")
    return Inputs(spark, folder).table("orders").select(chrom.alias("chrom"), at.alias("start"), (at + 1).alias("end"))


_PRIMARY = "chrom NOT LIKE '%\\_random%' ESCAPE '\\' AND chrom NOT LIKE '%chrEBV%' AND chrom NOT LIKE '%chrUn\\_%' ESCAPE '\\'"


@register("k9_p1_clean_contigs", f"SELECT {o.OUT_SITE} FROM o_contigs WHERE {_PRIMARY}")
def k9(spark, folder):
    path = scratch(spark, "clean.bed")
    text.clean_bed(_contigs(spark, folder), path)
    return bed.read_all_cpgs_in_reference(spark, path)


# ---------------------------------------------------------------- predicates


@register("p1_primary_contigs", f"SELECT {o.OUT_SITE} FROM o_contigs WHERE {_PRIMARY}")
def p1(spark, folder):
    return chroms.drop_alt_contigs(_contigs(spark, folder))


@register("p2_phasable_sites", f"SELECT {o.OUT_SITE} FROM o_contigs WHERE chrom NOT IN ('chrM', 'chrX', 'chrY')")
def p2(spark, folder):
    return _contigs(spark, folder).filter(chroms.is_phasable())


def _alleles(df: DataFrame) -> DataFrame:
    gt = genotypes.genotype_text(F.col("gt_raw"))
    return df.withColumns({"allele_1": genotypes.allele(gt, 0), "allele_2": genotypes.allele(gt, 1)})


_GT1, _GT2 = "substr(gt_raw, 1, 1)", "substr(gt_raw, 3, 1)"


@register(
    "p3_het_snv",
    f"""SELECT {o.OUT_SNV} FROM fx_snv WHERE length(ref) = 1 AND alt IN ('A', 'C', 'G', 'T')
        AND {_GT1} <> {_GT2} AND {_GT1} <> '.' AND {_GT2} <> '.'""",
)
def p3(spark, folder):
    het = genotypes.is_het(F.col("allele_1"), F.col("allele_2"))
    snv = genotypes.is_biallelic_snv(F.col("REF"), F.col("ALT"))
    return hapmap.het_sites(_alleles(Inputs(spark, folder).view("fx_snv")).filter(snv & het))


@register("p4_strict_snv", f"SELECT {o.OUT_SNV} FROM fx_snv WHERE length(ref) = 1 AND (length(alt) = 1 OR alt = 'C,G')")
def p4(spark, folder):
    kept = Inputs(spark, folder).view("fx_snv").filter(genotypes.is_snv_any_alts(F.col("REF"), F.col("ALT")))
    return hapmap.het_sites(kept)


@register(
    "p5_p6_genotype_class",
    f"""SELECT {o.OUT_SITE}, gt_raw, {_GT1} AS allele_1, {_GT2} AS allele_2, {o.genotype_class(_GT1, _GT2)} AS genotype
        FROM fx_variant""",
)
def p6(spark, folder):
    df = _alleles(Inputs(spark, folder).view("fx_variant"))
    genotype = genotypes.genotype_class(F.col("allele_1"), F.col("allele_2")).alias("genotype")
    return df.select("chrom", "start", "end", "gt_raw", "allele_1", "allele_2", genotype)


@register(
    "p14_levels_reported",
    f"""SELECT {o.OUT_SITE}, methylation_level_hap1 IS NOT NULL OR methylation_level_hap2 IS NOT NULL AS any_level,
        methylation_level_hap1 IS NOT NULL AND methylation_level_hap2 IS NOT NULL AS all_levels FROM fx_cpg""",
)
def p14(spark, folder):
    a, b = F.col("methylation_level_hap1"), F.col("methylation_level_hap2")
    flags = [mfn.level_is_reported(a, b, k).alias(n) for k, n in (("any", "any_level"), ("all", "all_levels"))]
    return Inputs(spark, folder).view("fx_cpg").select("chrom", "start", "end", *flags)


@register("p15_locus", "SELECT chrom || ':' || start_ || '-' || end_ AS locus_cpg FROM fx_cpg")
def p15(spark, folder):
    return Inputs(spark, folder).view("fx_cpg").select(mfn.locus("chrom", "start", "end").alias("locus_cpg"))


_LABELLED_FX = """
SELECT chrom, start_ AS start_cpg, end_ + 1 AS end_cpg, methylation_level_hap1, methylation_level_hap2,
       total_read_count_hap1, total_read_count_hap2, start_variant, end_variant, allele_1, allele_2,
       count(start_variant) OVER (PARTITION BY cpg_row) AS num_SNVs_overlapping_CG
FROM o_labelled_fx"""
o.CTES["o_counted_fx"] = _LABELLED_FX


def _labelled(spark, folder):
    i = Inputs(spark, folder)
    return expand.label_with_variants(i.view("fx_cpg"), i.variants())


@register(
    "p16_cpgs_at_variants",
    """SELECT *, chrom || ':' || start_cpg || '-' || end_cpg AS locus_cpg FROM o_counted_fx
       WHERE allele_1 = '0' AND allele_2 = '1' AND num_SNVs_overlapping_CG = 1""",
)
def p16(spark, folder):
    return expand.cpgs_at_variants(_labelled(spark, folder), 0, 1, 1)


@register("p17_discordant_blocks", o.renamed("o_hap_map") + " WHERE haplotype_concordance < 1.0")
def p17(spark, folder):
    return inspection.discordant_blocks(Inputs(spark, folder).hap_map())


@register("p17_outside_blocks", o.renamed("o_founder") + " WHERE start_hap_map_block IS NULL")
def p17_outside(spark, folder):
    return inspection.outside_blocks(Inputs(spark, folder, staged=True, pileups=HAPLOTYPES).founder())


@register(
    "p17_partly_phased",
    o.renamed("o_founder")
    + """ WHERE start_hap_map_block IS NOT NULL
        AND ((methylation_level_pat_count IS NULL) <> (methylation_level_mat_count IS NULL)
          OR (methylation_level_pat_model IS NULL) <> (methylation_level_mat_model IS NULL))""",
)
def p17_partly(spark, folder):
    return inspection.partly_phased(Inputs(spark, folder, staged=True, pileups=HAPLOTYPES).founder())


@register(
    "p17_unknown_flag",
    f"SELECT {o.OUT_SITE} FROM fx_cpg WHERE chrom NOT IN (SELECT chrom FROM fx_mismatch)",
)
def p17_unknown(spark, folder):
    """CpGs of chromosomes that hold no mismatch site."""
    i = Inputs(spark, folder)
    near = expand.flag_proximity(i.view("fx_cpg"), i.view("fx_mismatch"))
    return inspection.of_unknown_flag(near, expand.proximity_flag()).select("chrom", "start", "end")


o.CTES["o_flagged_fx"] = o.flagged(
    "o_labelled_fx",
    ["methylation_level_hap1", "methylation_level_hap2", "total_read_count_hap1", "total_read_count_hap2"],
    ("",),
)


@register("p17_genotype_pattern", "SELECT * FROM o_flagged_fx WHERE snv_genotypes LIKE '%het,%' OR snv_genotypes LIKE '%,het%'")
def p17_pattern(spark, folder):
    i = Inputs(spark, folder)
    flagged = expand.flag_allele_specific(i.view("fx_cpg"), i.variants())
    return inspection.het_beside_others(flagged)


@register(
    "p19_allele_letters",
    f"""SELECT {o.OUT_SNV}, gt_raw, coalesce(list_extract(string_split(ref || ',' || alt, ','),
        TRY_CAST({_GT1} AS INT) + 1), '.') AS letter_1,
        coalesce(list_extract(string_split(ref || ',' || alt, ','), TRY_CAST({_GT2} AS INT) + 1), '.') AS letter_2
        FROM fx_snv""",
)
def p19(spark, folder):
    df = _alleles(Inputs(spark, folder).view("fx_snv"))
    letters = [
        genotypes.allele_letter(F.col("REF"), F.col("ALT"), F.col(f"allele_{i}")).alias(f"letter_{i}") for i in (1, 2)
    ]
    return df.select("chrom", "start", "end", "REF", "ALT", "gt_raw", *letters)


@register("p21_het_sites", f"SELECT {o.OUT_SNV} FROM o_snvs")
def p21(spark, folder):
    return hapmap.het_sites(Inputs(spark, folder).founder_snvs())


# ---------------------------------------------------------------- joins and hap maps


@register("j1_full_outer_haps", o.renamed("o_kid_count"))
def j1(spark, folder):
    return Inputs(spark, folder).haplotypes("kid", "count")


@register(
    "j1_full_outer_haps_hot_keys",
    o.renamed("o_kid_count"),
)
def j1_hot(spark, folder):
    i = Inputs(spark, folder)
    values = ["total_read_count", "methylation_level"]
    sides = [methylation.suffixed(i.pileup("kid", "count", h), f"_{h}", values) for h in ("hap1", "hap2")]
    return joins.full_outer(*sides, hot_keys=True)


@register("j2_read_blocks", o.renamed("o_read_blocks", "ref, alt").replace("* EXCLUDE", 'ref AS "REF", alt AS "ALT", * EXCLUDE'))
def j2(spark, folder):
    i = Inputs(spark, folder)
    return phasing.attach_read_blocks(i.view("fx_read"), i.read_blocks())


@register(
    "j3_snv_five_key",
    f"""SELECT r.{o.OUT_SNV.replace(", ", ", r.")}, phase_block_id, allele_hap1, allele_hap2, allele_pat, allele_mat
        FROM fx_read r JOIN fx_iht i ON r.chrom = i.chrom AND r.start_ = i.start_ AND r.end_ = i.end_
        AND r.ref = i.ref AND r.alt = i.alt""",
)
def j3(spark, folder):
    i = Inputs(spark, folder)
    return phasing.join_phasings(i.view("fx_read"), i.view("fx_iht"))


@register(
    "j4_founder_snvs",
    o.renamed("o_snvs", "ref, alt").replace("* EXCLUDE", 'ref AS "REF", alt AS "ALT", * EXCLUDE'),
)
def j4(spark, folder):
    return Inputs(spark, folder).founder_snvs()


_MIXED_WIDTHS = """(SELECT chrom, start_ AS s, end_ AS e FROM fx_iht_block
       UNION ALL SELECT chrom, min(start_) AS s, max(end_) AS e FROM fx_iht_block GROUP BY chrom)"""


@register(
    "j4_mixed_widths",
    f"""SELECT r.chrom, r.start_ AS start, r.end_ AS "end", b.s AS start_block, b.e AS end_block
        FROM fx_read r LEFT JOIN {_MIXED_WIDTHS} b ON r.chrom = b.chrom AND r.start_ < b.e AND b.s < r.end_""",
)
def j4_mixed(spark, folder):
    """Blocks inside one that spans their chromosome, in bins that follow their bounds."""
    i = Inputs(spark, folder)
    small = i.view("fx_iht_block").select("chrom", "start", "end")
    right = small.unionByName(small.groupBy("chrom").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    sites = i.view("fx_read").select("chrom", "start", "end")
    return intervals.overlap_join(sites, right, "left", bin_size=intervals.adaptive_bins(right))


for _parent in ("dad", "mom"):

    @register(
        f"j5_parent_snvs_{_parent}",
        o.renamed(f"o_snvs_{_parent}", "ref, alt").replace("* EXCLUDE", 'ref AS "REF", alt AS "ALT", * EXCLUDE'),
    )
    def j5(spark, folder, parent=_parent):
        return Inputs(spark, folder).parent_snvs(parent)


@register("a2_hap_map", o.renamed("o_hap_map"))
def a2(spark, folder):
    return Inputs(spark, folder).hap_map()


@register("a5_mismatch_sites", f"SELECT {o.OUT_SNV} FROM o_mismatch")
def a5(spark, folder):
    return Inputs(spark, folder).mismatches()


for _parent, _side in (("dad", "pat"), ("mom", "mat")):

    @register(f"a3_hap_map_trio_{_side}", o.renamed(f"o_hap_map_{_side}"))
    def a3(spark, folder, parent=_parent):
        return Inputs(spark, folder).parent_map(parent)

    @register(f"a5_mismatch_sites_trio_{_side}", f"SELECT {o.OUT_SNV} FROM o_mismatch_{_side}")
    def a5_trio(spark, folder, parent=_parent):
        return Inputs(spark, folder).parent_mismatches(parent)


@register("j6_cpg_hapmap_left", o.renamed("o_phased_count"))
def j6(spark, folder):
    i = Inputs(spark, folder)
    return methylation.phase_to_founders(i.haplotypes("kid", "count"), i.hap_map(), bin_size=BIN)


@register("j7_trio_hapmaps_left", o.renamed("o_parents"))
def j7(spark, folder):
    return Inputs(spark, folder, staged=True, members=MEMBERS, pileups=HAPLOTYPES).parents()


@register("j8_null_safe_full", o.renamed("o_founder"))
def j8(spark, folder):
    i = Inputs(spark, folder, staged=True, pileups=HAPLOTYPES)
    hap_map = i.hap_map()
    sides = [methylation.phase_to_founders(i.haplotypes("kid", m), hap_map, bin_size=BIN) for m in methylation.MODES]
    return methylation.combine_modes(*sides)


@register("j9_count_model", o.renamed("o_dad_modes"))
def j9(spark, folder):
    i = Inputs(spark, folder)
    joined = methylation.combine_modes_of_member(i.haplotypes("dad", "count"), i.haplotypes("dad", "model"))
    return methylation.name_member_haplotypes(joined, "dad")


@register("j10_unphased_full", o.renamed("o_unphased"))
def j10(spark, folder):
    i = Inputs(spark, folder)
    return expand.join_unphased(i.combined("kid", "count"), i.combined("kid", "model"))


@register("j11_trio_full_outer", o.renamed("o_trio"))
def j11(spark, folder):
    return Inputs(spark, folder, staged=True, members=MEMBERS, pileups=HAPLOTYPES).trio_sites()


@register("j11_unphased_trio", o.renamed("o_unphased_trio"))
def j11_unphased(spark, folder):
    i = Inputs(spark, folder, staged=True, members=MEMBERS, pileups=("combined",))
    return expand.unphased_trio({(p, m): i.combined(p, m) for p in MEMBERS for m in methylation.MODES})


@register("j12_j13_expand", o.renamed("o_expanded"))
def j12(spark, folder):
    i = Inputs(spark, folder, staged=True)
    unphased = expand.join_unphased(i.combined("kid", "count"), i.combined("kid", "model"))
    return expand.expand_founder(i.view("fx_reference"), unphased, i.founder())


@register("j12_j13_expand_trio", o.renamed("o_expanded_trio"))
def j12_trio(spark, folder):
    i = Inputs(spark, folder, staged=True, members=MEMBERS)
    return i.expanded_trio().drop(intervals.WORD)


@register(
    "j14_nearest_within_50",
    f"""SELECT {o.OUT_SITE}, distance < 50 AS is_within_50bp_of_mismatch_site
        FROM fx_cpg LEFT JOIN o_distance_fx USING ({o.SITE})""",
)
def j14(spark, folder):
    i = Inputs(spark, folder)
    sites = i.view("fx_cpg").select("chrom", "start", "end")
    return expand.flag_proximity(sites, i.view("fx_mismatch"))


@register(
    "j14_nearest_distance",
    f"SELECT {o.OUT_SITE}, distance FROM fx_cpg LEFT JOIN o_distance_fx USING ({o.SITE})",
)
def j14_distance(spark, folder):
    i = Inputs(spark, folder)
    return intervals.nearest(i.view("fx_cpg").select("chrom", "start", "end"), i.view("fx_mismatch"))


@register(
    "p13_no_mismatch_file",
    f"SELECT {o.OUT_SITE}, false AS is_within_50bp_of_mismatch_site FROM fx_cpg",
)
def p13(spark, folder):
    return expand.flag_proximity(Inputs(spark, folder).view("fx_cpg").select("chrom", "start", "end"), None)


@register("j15_w1_snv_overlap", "SELECT * FROM o_counted_fx")
def j15(spark, folder):
    return _labelled(spark, folder)


_TRIO_FX_COUNT = "count(start_variant) OVER (PARTITION BY cpg_row) AS num_SNVs_overlapping_CG"


@register(
    "j15_w1_snv_overlap_trio",
    f"""SELECT start_ AS start_cpg, end_ + 1 AS end_cpg, * EXCLUDE (start_, end_, cpg_row), {_TRIO_FX_COUNT}
        FROM o_labelled_fx_trio""",
)
def j15_trio(spark, folder):
    i = Inputs(spark, folder)
    return expand.label_with_variants(i.view("fx_cpg"), i.trio_variants())


@register("j17_created", f"SELECT {o.OUT_SITE}, total_read_count, methylation_level FROM fx_kid_count_combined ANTI JOIN fx_reference USING ({o.SITE})")
def j17(spark, folder):
    i = Inputs(spark, folder)
    return joins.created_sites(i.combined("kid", "count"), i.view("fx_reference"))


@register("j17_undetected", f"SELECT {o.OUT_SITE} FROM fx_reference ANTI JOIN fx_kid_count_combined USING ({o.SITE})")
def j17_undetected(spark, folder):
    i = Inputs(spark, folder)
    return joins.undetected_sites(i.view("fx_reference"), i.combined("kid", "count"))


@register(
    "j18_u2_rows_at_double_variants",
    """SELECT * FROM o_counted_fx SEMI JOIN (SELECT DISTINCT chrom, start_cpg, end_cpg FROM o_counted_fx
       WHERE num_SNVs_overlapping_CG = 2 AND methylation_level_hap1 IS NOT NULL AND methylation_level_hap2 IS NOT NULL) d
       USING (chrom, start_cpg, end_cpg)""",
)
def j18(spark, folder):
    labelled = _labelled(spark, folder)
    where = ["chrom", "start_cpg", "end_cpg"]
    reported = mfn.level_is_reported(F.col("methylation_level_hap1"), F.col("methylation_level_hap2"), "all")
    doubles = labelled.filter((F.col("num_SNVs_overlapping_CG") == 2) & reported)
    return joins.rows_at(labelled, doubles.select(*where).distinct(), where)


@register("u3_concatenated_files", f"SELECT {o.OUT_SITE}, allele_1, allele_2 FROM o_variants")
def u3(spark, folder):
    i = Inputs(spark, folder)
    root = scratch(spark, "by-chrom")
    calls = i.joint_calls()
    names = "\t".join(calls.columns)
    spark.createDataFrame([(names,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/0-header")
    line = F.concat_ws("\t", *[F.col(f"`{c}`") for c in calls.columns]).alias("value")
    body = calls.select(F.col("`#CHROM`").alias("by_chrom"), line)
    body.write.mode("overwrite").partitionBy("by_chrom").text(f"{root}/body")
    return vcf.read_joint_variants(spark, [f"{root}/0-header", f"{root}/body/*"], "kid")


# ---------------------------------------------------------------- aggregates


@register("a6_allele_specific", "SELECT * FROM o_flagged_fx")
def a6(spark, folder):
    return expand.label_allele_specific(_labelled(spark, folder))


@register("a6_allele_specific_one_join", "SELECT * FROM o_flagged_fx")
def a6_fused(spark, folder):
    i = Inputs(spark, folder)
    return expand.flag_allele_specific(i.view("fx_cpg"), i.variants())


_FX_VALUES = ["methylation_level_hap1", "methylation_level_hap2", "total_read_count_hap1", "total_read_count_hap2"]


@register("a7_allele_specific_trio", o.flagged("o_labelled_fx_trio", _FX_VALUES, MEMBERS))
def a7(spark, folder):
    i = Inputs(spark, folder)
    return expand.label_allele_specific(expand.label_with_variants(i.view("fx_cpg"), i.trio_variants()), MEMBERS)


@register("a8_qc_pedigree", o.fractions("o_near_het", {"within_50bp_of_mismatch": "is_within_50bp_of_mismatch_site"} | o.mode_conditions("pat", "mat", "")))
def a8(spark, folder):
    # All het sites stand in for the mismatches: unlike those, every chromosome has some at any scale.
    i = Inputs(spark, folder, staged=True)
    return qc.qc_founder(expand.flag_proximity(i.expanded(), hapmap.het_sites(i.founder_snvs())))


@register(
    "a9_qc_trio",
    o.fractions(
        "o_near_het_trio",
        {f"within_50bp_of_mismatch_{s}": f"is_within_50bp_of_mismatch_site_{s}" for s in ("pat", "mat")}
        | o.mode_conditions("kid_pat", "kid_mat", "_kid"),
    ),
)
def a9(spark, folder):
    i = Inputs(spark, folder, staged=True, members=MEMBERS)
    df = expand.flag_proximity(i.expanded_trio(), hapmap.het_sites(i.parent_snvs("dad")), "_pat")
    return qc.qc_trio(expand.flag_proximity(df, hapmap.het_sites(i.parent_snvs("mom")), "_mat"))


@register("a10_read_count_invariant", o.renamed("o_unphased_dad"))
def a10(spark, folder):
    i = Inputs(spark, folder)
    return expand.unphased_member(i.combined("dad", "count"), i.combined("dad", "model"), "dad")


@register(
    "a11_stage_counts",
    """SELECT 'sites' AS stage, count(*) AS n FROM o_snvs UNION ALL SELECT 'hap_map', count(*) FROM o_hap_map
       UNION ALL SELECT 'mismatches', count(*) FROM o_mismatch""",
)
def a11(spark, folder):
    i = Inputs(spark, folder, staged=True)
    stages = {"sites": i.founder_snvs(), "hap_map": i.hap_map(), "mismatches": i.mismatches()}
    counts = []
    for stage, df in stages.items():
        seen, observation = qc.counted(df, stage)
        seen.write.format("noop").mode("overwrite").save()
        counts.append((stage, observation.get["rows"]))
    return spark.createDataFrame(counts, "stage string, n bigint")


@register(
    "a12_overlap_histogram",
    """SELECT num_SNVs_overlapping_CG, count(*) AS n_rows,
       CAST(count(*) / greatest(num_SNVs_overlapping_CG, 1) AS BIGINT) AS n_cpgs FROM o_counted_fx GROUP BY 1""",
)
def a12(spark, folder):
    return expand.overlap_histogram(_labelled(spark, folder))


# ---------------------------------------------------------------- order and samples


_VERSION = "TRY_CAST(regexp_extract(chrom, '(\\d+)', 1) AS BIGINT)"
_VERSION_PLACE = f"row_number() OVER (ORDER BY {_VERSION} NULLS LAST, chrom, start_) - 1"


@register("o1_version_sort", f"SELECT {o.OUT_SITE}, {_VERSION} AS chrom_rank, {_VERSION_PLACE} AS position FROM o_contigs")
def o1(spark, folder):
    ordered = ordering.version_sort(_contigs(spark, folder).withColumn("chrom_rank", chroms.chrom_rank()))
    return ordering.positions(ordered)


@register("o2_position_sort", f"SELECT {o.OUT_SITE}, row_number() OVER (ORDER BY chrom, start_, end_) - 1 AS position FROM o_contigs")
def o2(spark, folder):
    return ordering.positions(ordering.position_sort(_contigs(spark, folder)))


def _lines_in_order(spark, path: str) -> DataFrame:
    """Lines of a folder of text parts with their place in the parts by name."""
    at = {"file": F.col("_metadata.file_name"), "block": F.col("_metadata.file_block_start"), "line": F.monotonically_increasing_id()}
    lines = spark.read.text(path).select("value", *[c.alias(n) for n, c in at.items()])
    return ordering.numbered(lines, list(at)).select("value", "position")


@register("o3_k8_sorted_text", f"SELECT chrom || chr(9) || start_ || chr(9) || end_ AS value, {_VERSION_PLACE} + 2 AS position FROM o_contigs")
def k8_order(spark, folder):
    """Lines of the compressed table after its two header lines, which must come first."""
    root = text.write_methylation(_contigs(spark, folder), scratch(spark, "sorted.bed"), "checks")
    lines = _lines_in_order(spark, f"{root}.sorted.bed.gz")
    heads = F.col("value").startswith("#") & (F.col("position") < 2)
    return lines.filter(~heads)


@register(
    "o4_seeded_sample",
    """SELECT chrom, start_ AS start, end_ AS "end", * EXCLUDE (chrom, start_, end_) FROM fx_cpg
       ORDER BY md5(concat_ws('|', chrom, start_, end_, '42')), chrom, start_, end_ LIMIT 10""",
)
def o4(spark, folder):
    return ordering.seeded_sample(Inputs(spark, folder).view("fx_cpg"), 10, 42, ["chrom", "start", "end"])


@register(
    "o5_preview",
    """SELECT chrom, start_ AS start, end_ AS "end", * EXCLUDE (chrom, start_, end_) FROM fx_cpg ORDER BY chrom, start_, end_ LIMIT 25""",
)
def o5(spark, folder):
    return ordering.preview(Inputs(spark, folder).view("fx_cpg"), 25, ["chrom", "start", "end"])


@register(
    "o4_sample_at_double_variants",
    """SELECT t.* EXCLUDE (methylation_level_hap1, methylation_level_hap2), methylation_level_hap1 AS methylation_level_pat_count,
         methylation_level_hap2 AS methylation_level_mat_count, t.chrom || ':' || t.start_cpg || '-' || t.end_cpg AS locus_cpg
       FROM o_counted_fx t SEMI JOIN (
         SELECT DISTINCT chrom, start_cpg, end_cpg, md5(concat_ws('|', chrom, start_cpg, end_cpg, '39')) AS digest FROM o_counted_fx
         WHERE num_SNVs_overlapping_CG = 2 AND methylation_level_hap1 IS NOT NULL AND methylation_level_hap2 IS NOT NULL
         ORDER BY digest, chrom, start_cpg, end_cpg LIMIT 10) s USING (chrom, start_cpg, end_cpg)""",
)
def o4_double(spark, folder):
    levels = {f"methylation_level_hap{i}": f"methylation_level_{s}_count" for i, s in ((1, "pat"), (2, "mat"))}
    return ordering.sample_at_double_variants(_labelled(spark, folder).withColumnsRenamed(levels), 10, 39)


@register("u2_distinct_coordinates", f"SELECT DISTINCT {o.OUT_SITE} FROM fx_variant")
def u2(spark, folder):
    return Inputs(spark, folder).view("fx_variant").select("chrom", "start", "end").distinct()


# ---------------------------------------------------------------- whole jobs


@register("e1_founder_phasing", o.renamed("o_founder"))
def e1(spark, folder):
    return Inputs(spark, folder, staged=True, pileups=HAPLOTYPES).founder()


@register("e2_parent_phasing", o.renamed("o_parents"))
def e2(spark, folder):
    return Inputs(spark, folder, staged=True, members=MEMBERS, pileups=HAPLOTYPES).parents()


@register("e3_expand_pedigree", _FINAL_OUT)
def e3(spark, folder):
    i = Inputs(spark, folder, staged=True)
    return expand.flag_allele_specific(i.near(), i.variants())


@register("e4_expand_trio", _FINAL_TRIO_OUT)
def e4(spark, folder):
    i = Inputs(spark, folder, staged=True, members=MEMBERS)
    return expand.flag_allele_specific(i.near_trio(), i.trio_variants(), MEMBERS)


# ---------------------------------------------------------------- cohorts


class Cohort:
    """The trio's members as three samples, with the files that the cohort jobs read."""

    SAMPLES = o.COHORT

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.inputs = spark, Inputs(spark, folder, staged=True, members=MEMBERS)
        self.root = scratch(spark, "cohort")

    def put_lines(self, name: str, header: list[str], rows: DataFrame) -> str:
        """A folder of compressed text parts, the first of which has the header lines."""
        path = f"{self.root}/{name}"
        heads = self.spark.createDataFrame([(line,) for line in header], "value string").coalesce(1)
        lines = rows.select(text.as_line(rows.columns).alias("value"))
        heads.union(lines).write.text(path, compression="gzip")
        return path

    def pileup_file(self, member: str, mode: str, haplotype: str) -> str:
        rows = self.inputs.pileup(member, mode, haplotype).select(
            "chrom", "start", "end", F.col("methylation_level").alias("score"), F.lit("Total").alias("type"), "total_read_count", F.lit(0).alias("more")
        )
        return self.put_lines(f"{member}.{mode}.{haplotype}", [f"##pileup-mode={mode}", "\t".join(PILEUP_NAMES)], rows)

    def variant_file(self, name: str, calls: DataFrame) -> str:
        header = ["##fileformat=VCFv4.2", "\t".join(calls.columns)]
        return self.put_lines(name, header, calls)

    def manifest(self, haplotypes: tuple[str, ...], reads: bool) -> DataFrame:
        """Sample, kind and path of every file, which are written first."""
        rows = [
            (m, f"{mode}.{hap}", self.pileup_file(m, mode, hap))
            for m in self.SAMPLES
            for mode in methylation.MODES
            for hap in haplotypes
        ]
        if reads:
            names = list(blocks.READ_BLOCK_COLUMNS)
            for m in self.SAMPLES:
                snvs = self.inputs.view("fx_read")
                # every seventh SNV is phased the other way, so every chromosome has mismatches at any scale
                first, second = F.col("allele_hap1"), F.col("allele_hap2")
                phased = F.when(F.col("start") % 7 == 0, F.concat_ws("|", second, first)).otherwise(F.concat_ws("|", first, second))
                call = F.concat_ws(":", phased, "phase_block_id")
                rows.append((m, "reads.vcf", self.variant_file(f"{m}.reads.vcf", as_variants(snvs, F.lit("GT:PS"), [call.alias(m)]))))
                bounds = self.inputs.read_blocks().withColumns({"source_block_index": F.lit(0), "sample_name": F.lit(m)})
                rows.append((m, "reads.blocks", self.put_lines(f"{m}.blocks.tsv", ["\t".join(names)], bounds.select(*names))))
        return self.spark.createDataFrame(rows, "sample string, kind string, path string")

    def phased(self) -> cohort_jobs.CohortPhasing:
        snvs = self.inputs.view("fx_iht")
        call = F.concat_ws("|", "allele_pat", "allele_mat")
        calls = as_variants(snvs, F.lit("GT"), [F.lit("0/1").alias("other"), *[call.alias(m) for m in self.SAMPLES]])
        labels = F.concat_ws("|", "founder_label_pat", "founder_label_mat")
        bounds = self.inputs.view("fx_iht_block").select(
            "chrom", "start", "end", *[labels.alias(m) for m in self.SAMPLES], F.lit(10).alias("n"), F.lit(5).alias("l"), F.lit("m").alias("k")
        )
        header = " ".join(["#chrom start end", *self.SAMPLES, "marker_count len markers"])
        return cohort_jobs.phase_cohort_to_founder_haps(
            self.spark,
            manifest=self.manifest(("hap1", "hap2"), reads=True),
            vcf_iht_phased=self.variant_file("iht.vcf", calls),
            txt_iht_blocks=self.put_lines("iht.txt", [header], bounds),
            output_dir=f"{self.root}/out",
        )

    def expanded(self) -> cohort_jobs.CohortExpansion:
        self.phased()
        reference = f"{self.root}/reference.bed"
        text.write_table(self.inputs.view("fx_reference"), reference, "gzip")
        calls = as_variants(self.inputs.view("fx_variant"), F.lit("GT:AD:DP"), [F.col("gt_raw").alias(m) for m in self.SAMPLES])
        return cohort_jobs.expand_cohort_to_all_cpgs(
            self.spark,
            manifest=self.manifest(("combined",), reads=False),
            phased_dir=f"{self.root}/out",
            bed_all_cpgs_in_reference=reference,
            vcf_joint_called=self.variant_file("joint.vcf", calls),
            output_dir=f"{self.root}/out",
        )


@register("e1_cohort", o.renamed("o_cohort"))
def e1_cohort(spark, folder):
    return Cohort(spark, folder).phased().methylation


_COHORT_TRACKS = " UNION ALL ".join(
    f'SELECT sample, {o.OUT_SITE}, {level} AS value, \'{track}\' AS track FROM o_cohort WHERE {level} IS NOT NULL'
    for track, level in text.founder_track_columns().items()
)


@register("k7_cohort", _COHORT_TRACKS)
def k7_cohort(spark, folder):
    """The tracks as written, each sample and track in a folder of its own."""
    schema = 'chrom string, start bigint, end bigint, value double, sample string, track string'
    return spark.read.schema(schema).csv(Cohort(spark, folder).phased().tracks, sep="\t")


@register("e3_cohort", o.flagged("o_labelled_cohort", ["sample", *o.EXPANDED_VALUES, "is_within_50bp_of_mismatch_site"], ("",)))
def e3_cohort(spark, folder):
    return Cohort(spark, folder).expanded().table


@register(
    "a8_cohort",
    o.fractions("o_near_cohort", {"within_50bp_of_mismatch": "is_within_50bp_of_mismatch_site"} | o.mode_conditions("pat", "mat", ""), "sample"),
)
def a8_cohort(spark, folder):
    return Cohort(spark, folder).expanded().qc
