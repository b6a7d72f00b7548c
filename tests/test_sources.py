import gzip
import os

import pytest
from pyspark.sql import functions as F

from checks.registry import QUERIES
from haplometh.sinks import text
from haplometh.sources import bed, blocks, genome, lines, reports, samples, vcf

PILEUP = [
    "##pileup-mode=count",
    "##version",
    "#chrom\tbegin\tend\tmod_score\ttype\tcov\test_mod_count",
    "chr1\t10\t11\t25.0\tTotal\t8\t2",
    "chr1\t12\t13\t100\tTotal\t4\t4",
    "chr1_X_random\t1\t2\t50.0\tTotal\t9\t1",
]


@pytest.fixture
def put(tmp_path):
    def write(name, content):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        body = "\n".join(content) + "\n"
        if name.endswith(".gz"):
            path.write_bytes(gzip.compress(body.encode()))
        else:
            path.write_text(body)
        return str(path)

    return write


@pytest.mark.parametrize("name", ["meth.bed", "meth.bed.gz"])
def test_pileup(spark, rows, put, name):
    out = bed.read_meth_level(spark, put(name, PILEUP), "count", partitions=2)
    assert rows(out) == [("chr1", 10, 11, 8, 0.25), ("chr1", 12, 13, 4, 1.0)]


@pytest.mark.parametrize(
    "content, mode, message",
    [
        (PILEUP, "model", "expected 'model'"),
        (PILEUP[2:], "count", "no comment lines"),
        (PILEUP[:2] + PILEUP[3:], "count", "no header line"),
        (PILEUP[1:], "count", "no ##pileup-mode"),
    ],
)
def test_pileup_header_is_checked(spark, put, content, mode, message):
    with pytest.raises(bed.HeaderError, match=message):
        bed.read_meth_level(spark, put("bad.bed", content), mode)

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


def test_long_headers_are_read_whole(spark, put):
    content = ["##x"] * 700 + PILEUP
    assert len(lines.leading_comments(lines.read_lines(spark, put("long.bed", content)))) == 703


SITES = "chrom string, start bigint, end bigint, REF string, ALT string"


def mismatches(spark):
    return spark.createDataFrame([("chr2", 5, 6, "A", "C"), ("chr10", 7, 8, "G", "T"), ("chr2", 1, 2, "T", "A")], SITES)


def test_bed_with_sidecar_header(spark, rows, tmp_path):
    df = mismatches(spark)
    path = text.write_mismatches(df, str(tmp_path), "u1", "paternal")
    assert path.endswith("/u1.bit-vector-sites-mismatches.paternal.bed")
    back = bed.read_bed_and_header(spark, path)
    assert back.schema == df.schema and rows(back) == rows(df)
    body = [r.value for r in spark.read.text(path[:-3] + "vcf").collect()]
    assert body == [
        "##fileformat=VCFv4.2",
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tu1",
        "chr10\t8\t.\tG\tT\t.\t.\t.\t.\t.",
        "chr2\t2\t.\tT\tA\t.\t.\t.\t.\t.",
        "chr2\t6\t.\tA\tC\t.\t.\t.\t.\t.",
    ]
    with pytest.raises(ValueError):
        bed.read_bed_and_header(spark, str(tmp_path / "x.txt"))
    with pytest.raises(ValueError):
        text.write_bed_and_header(df, str(tmp_path / "x.txt"))


def test_described_bed_is_sorted_and_keeps_nulls(spark, rows, tmp_path):
    schema = "chrom string, start_cpg bigint, end_cpg bigint, methylation_level_pat_count double, cpg_is_allele_specific boolean, founder_haplotype_pat string"
    df = spark.createDataFrame(
        [("chrX", 1, 3, None, True, None), ("chr10", 4, 6, 0.5, False, "A"), ("chr2", 9, 11, 1.0, None, "B"), ("chr2", 5, 7, 0.25, True, "B")],
        schema,
    )
    root = text.write_methylation(df, str(tmp_path / "final.bed"), "me with args {}")
    path = f"{root}.sorted.bed.gz"
    out = [r.value for r in spark.read.text(path).collect()]
    assert out[:2] == ["##source='me with args {}'", "#" + "\t".join(df.columns)]
    assert [line.split("\t")[:2] for line in out[2:]] == [["chr2", "5"], ["chr2", "9"], ["chr10", "4"], ["chrX", "1"]]
    assert out[-1] == "chrX\t1\t3\t\ttrue\t"
    assert rows(bed.read_expanded(spark, path)) == rows(df)


def test_tracks_are_sorted_and_split(spark, tmp_path):
    schema = "chrom string, start bigint, end bigint, methylation_level_pat_count double, methylation_level_mat_count double, methylation_level_pat_model double, methylation_level_mat_model double"
    df = spark.createDataFrame([("chr10", 1, 2, 0.5, None, None, 0.1), ("chr2", 1, 2, 0.75, 0.2, None, None)], schema)
    text.write_tracks(text.tracks(df, text.founder_track_columns()), str(tmp_path / "t"))
    tracks = sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir())
    assert tracks == ["track=mat.count", "track=mat.model", "track=pat.count"]
    body = [r.value for r in spark.read.text(str(tmp_path / "t" / "track=pat.count")).collect()]
    assert body == ["chr2\t1\t2\t0.75", "chr10\t1\t2\t0.5"]


def test_compressed_tracks_hold_the_same_lines(spark, tmp_path, rows):
    df = spark.range(500).selectExpr("'chr1' AS chrom", "id AS start", "id + 1 AS end", "id / 500 AS x", "if(id % 3 = 0, id / 7, null) AS y")
    for kind in ("none", "gzip"):
        text.write_tracks_of(df, {"x": "x", "y": "y"}, str(tmp_path / kind), compression=kind)
    for track in "xy":
        assert all(p.name.endswith(".gz") for p in (tmp_path / "gzip" / f"track={track}").glob("part-*"))
        assert rows(spark.read.text(str(tmp_path / "gzip" / f"track={track}"))) == rows(spark.read.text(str(tmp_path / "none" / f"track={track}")))


def test_tracks_dealt_in_wide_rows_are_the_same_files(spark, tmp_path):
    columns = text.founder_track_columns()
    levels = [F.when(F.col("id") % (n + 2) > 0, F.col("id") / (n + 1)).alias(c) for n, c in enumerate(columns.values())]
    chrom = F.concat(F.lit("chr"), F.element_at(F.array(*map(F.lit, ("2", "10", "X"))), (F.floor(F.col("id") / 64) % 3 + 1).cast("int")))
    df = spark.range(999, -1, -1).select(chrom.alias("chrom"), F.col("id").alias("start"), (F.col("id") + 1).alias("end"), *levels)
    text.write_tracks(text.tracks(df, columns), str(tmp_path / "long"))
    text.write_tracks_of(df, columns, str(tmp_path / "wide"))
    for track in columns:
        parts = [sorted((tmp_path / kind / f"track={track}").glob("part-*")) for kind in ("long", "wide")]
        long, wide = ["".join(p.read_text() for p in kind) for kind in parts]
        assert long == wide
        chroms = [line.split("\t")[0] for line in wide.splitlines()]
        assert list(dict.fromkeys(chroms)) == ["chr2", "chr10", "chrX"]


def test_lines_are_split_once_whatever_filter_follows(spark, put):
    lines = spark.read.text(put("p.bed", ["#chrom\tbegin\tend\tmod_score\ttype\tcov", "chr1\t1\t2\t50\tTotal\t7", "chrEBV\t1\t2\t50\tTotal\t7"]))
    levels = bed.meth_levels(bed.pileup_from_lines(lines, bed.PILEUP_COLUMNS))
    assert levels.collect() == [("chr1", 1, 2, 7, 0.5)]
    assert levels._jdf.queryExecution().optimizedPlan().toString().count("split(value") == 1


def test_clean_bed_counts_what_it_drops(spark, rows, put, tmp_path):
    raw = bed.read_all_cpgs_in_reference(spark, put("r.bed", ["chr1\t1\t2", "chrUn_7\t1\t2", "chrEBV\t3\t4"]))
    out = str(tmp_path / "clean.bed")
    assert text.clean_bed(raw, out) == 2
    assert rows(bed.read_all_cpgs_in_reference(spark, out)) == [("chr1", 1, 2)]


def record(pos, ref, alt, fmt, *calls, chrom="chr1"):
    return "\t".join([chrom, str(pos), ".", ref, alt, "9", ".", 'X="1"', fmt, *calls])


def header(*names):
    return ["##fileformat=VCFv4.2", "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *names])]


def test_read_phased_variants(spark, rows, put):
    content = header("s") + [
        record(11, "A", "C", "GT:DP:PS", "0|1:3:77"),
        record(12, "A", "C", "GT:DP:PS", "1|0:3:."),
        record(13, "A", "C", "GT", "1|0"),
        record(14, "A", "C", "GT:DP:PS", "0/1:3:77"),
        record(15, "A", "C,G", "GT:PS", "0|1:77"),
        record(16, "AC", "C", "GT:PS", "0|1:77"),
        record(17, "A", "C", "GT:PS", "1|1:77"),
        record(18, "A", "C", "GT:PS", "0|.:77"),
    ]
    for name in ("v.vcf", "v.vcf.gz"):
        out = vcf.read_read_phasing(spark, put(name, content))
        assert rows(out) == [
            ("chr1", 10, 11, "A", "C", "77", "0", "1"),
            ("chr1", 11, 12, "A", "C", ".", "1", "0"),
            ("chr1", 12, 13, "A", "C", ".", "1", "0"),
        ]
    with pytest.raises(vcf.SampleError):
        vcf.read_read_phasing(spark, put("two.vcf", header("s", "t")))


def test_inheritance_phasing(spark, rows, put):
    content = header("x", "kid") + [record(11, "A", "C", "GT", "0/1", "1|0"), record(12, "A", "C", "GT", "0/1", "0/0")]
    path = put("i.vcf", content)
    assert rows(vcf.read_inheritance_phasing(spark, path, "kid")) == [("chr1", 10, 11, "A", "C", "1", "0")]
    with pytest.raises(Exception, match="phased genotype"):
        vcf.read_inheritance_phasing(spark, path, "x").collect()
    with pytest.raises(vcf.SampleError):
        vcf.read_inheritance_phasing(spark, path, "nobody")


def test_trio_pairs(spark, rows, put):
    content = header("mom", "kid", "dad") + [
        record(11, "A", "C", "GT", "0/0", "1/1", "0|1"),
        record(12, "A", "C", "GT", "0/0", "0/1", "0|1"),
        record(13, "A", "C", "GT", "0/0", "./.", "0|1"),
        record(14, "A", "C", "GT", "1|0", "0|1", "0/1"),
        record(15, "A", "C", "GT", "0|1", ".|1", "0|1"),
    ]
    dad, mom = vcf.read_trio_pairs(spark, put("t.vcf", content), "kid", "dad", "mom")
    assert rows(dad) == [("chr1", 10, 11, "A", "C", "1", "0", "1")]
    assert rows(mom) == [("chr1", 13, 14, "A", "C", "1", "1", "0"), ("chr1", 14, 15, "A", "C", "1", "0", "1")]


def test_joint_variants(spark, rows, put):
    content = header("a", "b") + [
        record(11, "A", "C,G", "GT:DP", "0/2:5", "."),
        record(12, "A", ".", "GT", "0/0", "0/0"),
        record(13, "A", "GA", "GT", "0/1", "0/1"),
        record(14, "A", "T", "GT", "1", "./."),
        record("x", "A", "T", "GT", "0|1", "0|1"),
    ]
    path = put("j.vcf", content)
    assert rows(vcf.read_joint_variants(spark, path, "a")) == [
        ("chr1", 10, 11, "0", "2"),
        ("chr1", 13, 14, "1", "."),
    ]
    both = vcf.read_joint_variants(spark, path, {"kid": "b", "dad": "a"})
    assert both.columns[3:] == ["allele_1_kid", "allele_2_kid", "allele_1_dad", "allele_2_dad"]
    assert ("chr1", 10, 11, None, None, "0", "2") in rows(both)
    # Files that continue each other are one table.
    more = put("k.vcf", header("a", "b") + [record(11, "A", "C", "GT", "0/1", "0/0", chrom="chr2")])
    assert vcf.read_joint_variants(spark, [path, more], "a").count() == 3


def test_block_tables(spark, rows, put):
    read = put("b.tsv", ["source_block_index\tsample_name\tphase_block_id\tchrom\tstart\tend\tnum_variants", "0\ts\t77\tchr1\t100\t500\t4"])
    assert rows(blocks.read_read_phase_blocks(spark, read)) == [(0, "s", "77", "chr1", 100, 500, 4)]
    trio = put("t.tsv", ["#sample\tchromosome\tphase_set\tfrom\tto\tvariants", "kid\tchr1\t9\t101\t500\t4", "dad\tchr1\t9\t1\t2\t1"])
    assert rows(blocks.read_phase_blocks(spark, trio, "kid")) == [("chr1", 100, 500, "9", 4)]


def test_inheritance_blocks(spark, rows, put):
    top = "#chrom start end kid founder marker_count len markers"
    body = ["chr1 1 5 A|C X/Y 1 4 a", "chr1\t5\t9\t?|C\tX/Y\t1\t4\ta", "chr1 9 12 ?|? X/Y 1 3 a"]
    path = put("iht.txt", [top, *body])
    assert rows(blocks.read_inheritance_blocks(spark, path, "kid")) == [("chr1", 1, 5, "A", "C"), ("chr1", 5, 9, "?", "C")]
    with pytest.raises(Exception, match="is a founder"):
        blocks.read_inheritance_blocks(spark, path, "founder").collect()
    with pytest.raises(blocks.BlockError):
        blocks.read_inheritance_blocks(spark, path, "nobody")
    with pytest.raises(blocks.BlockError):
        blocks.read_inheritance_blocks(spark, put("bad.txt", ["#chrom begin end kid marker_count len markers"]), "kid")


def test_cpg_scan_of_chunks(spark, rows):
    chunks = spark.createDataFrame([("chr1", 100, "acGTCGCG"), ("chrUn_1", 0, "CGCG")], "chrom string, offset bigint, seq string")
    for piece in (2, 3, 200):
        assert rows(genome.cpg_sites(chunks, piece=piece), "start") == [(101,), (104,), (106,)]
    assert rows(genome.cpg_sites(chunks)) == [("chr1", 101, 102), ("chr1", 104, 105), ("chr1", 106, 107)]


def brute(sequences):
    return sorted(
        (c, i, i + 1) for c, s in sequences.items() for i in range(len(s) - 1) if s[i : i + 2].upper() == "CG"
    )


def fasta(sequences, width):
    out = []
    for name, seq in sequences.items():
        out.append(f">{name} some description")
        out += [seq[i : i + width] for i in range(0, len(seq), width)]
    return out


def test_fasta_scan(spark, rows, put):
    import random

    rng = random.Random(3)
    sequences = {f"chr{i}": "".join(rng.choices("ACGTcgN", k=rng.randint(50, 900))) for i in (1, 2, 10)}
    path = put("ref.fa", fasta({**sequences, "chrUn_x": "CGCG"}, 37))
    assert rows(genome.scan_fasta(spark, path)) == brute(sequences)


@pytest.mark.parametrize("cuts", [(4,), (1, 2, 3, 9), (6, 7, 8, 11, 15)])
def test_fasta_lines_across_splits(spark, rows, cuts):
    """Splits that begin and end anywhere, also without a name line of their own."""
    sequences = {"chr1": "ACGCGTTCGACG" * 3, "chr2": "GCGCCGGC" * 4 + "C", "chr3": "G"}
    content = fasta(sequences, 5)
    split = [sum(i >= c for c in cuts) for i in range(len(content))]
    numbered = [("f", s * 1000, i, line) for i, (s, line) in enumerate(zip(split, content))]
    table = spark.createDataFrame(numbered, "file string, split bigint, line bigint, value string").repartition(5)
    assert rows(genome.cpg_sites(genome.chunks_of_fasta_lines(table))) == brute(sequences)


@pytest.mark.parametrize("width", [1, 3, 16, 61, 1 << 20])
@pytest.mark.parametrize("wrap", [4, 1 << 20])
def test_fasta_in_byte_ranges(spark, rows, put, width, wrap):
    """One line a chromosome, or many; ranges that start in names, at line ends, between C and G."""
    sequences = {"chr1": "ACGCGTTCGACG" * (1 if width == 1 else 5), "chr2": "CG", "chr3": "GCcg"}
    path = put("ref.fa", fasta({**sequences, "chrUn_x": "CGCG"}, wrap))
    chunks = genome.fasta_chunks(spark, path, width)
    assert rows(genome.cpg_sites(chunks)) == brute(sequences)


def test_fasta_ranges_are_tasks_of_their_own(spark, rows, put, tmp_path):
    import gzip

    sequence = "ACGCGTTCGACGNNCg" * 500
    path = put("ref.fa", [">chr1", sequence, "", ">chr2 x", "CG"])
    read = genome.read_fasta_ranges(spark, path, 1000)
    assert read.rdd.getNumPartitions() == 9 and read.filter("value not like '>%'").select("split").distinct().count() == 9
    (tmp_path / "other.fa.gz").write_bytes(gzip.compress(b">chr3\nAC\nGT\n"))
    put("empty.fa", [])
    sites = rows(genome.scan_fasta(spark, [path, str(tmp_path / "other.fa.gz"), str(tmp_path / "empty.fa")], 1000))
    assert sites == brute({"chr1": sequence, "chr2": "CG", "chr3": "ACGT"})


def test_fasta_name_lines_are_bounded(spark, put, monkeypatch):
    from io import BytesIO

    from haplometh.sources import ranges

    data = b">a " + b"x" * 20 + b"\nACG\r\nT" + b"A" * 50 + b"\n>b\nCG"
    for width in range(1, 30):
        monkeypatch.setattr(ranges, "NAME_BYTES", 24)
        parts = [p for at in range(0, len(data), width) for p in ranges.pieces(BytesIO(data), at, min(at + width, len(data)), len(data))]
        names = [p for p in parts if p.startswith(b">")]
        assert names == [b">a " + b"x" * 20, b">b"]
        assert b"".join(p for p in parts if p not in names) == b"ACGT" + b"A" * 50 + b"CG"
    monkeypatch.setattr(ranges, "NAME_BYTES", 12)
    with pytest.raises(ValueError, match="a name line of more than 12"):
        list(ranges.pieces(BytesIO(data), 0, 9, len(data)))


def test_log_percentages(spark, rows, put, tmp_path):
    label = "CpG sites (x, y) at which count-based methylation is phased"
    put("a.log", ["args /d/200081.dna-methylation.founder-phased.all_cpgs.bed'", f"{label}: 10.00%", f"INFO {label}: 93.25%"])
    put("b.log", [f"{label}: 10.00%"])
    out = reports.read_percentages(spark, str(tmp_path / "*.log"), label)
    assert rows(out) == [("200081", 93.25)]


def test_manifest(spark, rows, put):
    array = samples.ARRAY_COLUMN
    people = put("m.csv", [f"LINK ID,Coriell ID,Gender,Age,PaID,MaID,{array}", "1,12878,F,40,2,3,b/1.csv", "2,,M,60,,,", "9,7,M,1,,,"])
    ages = put("a.csv", ["LINK ID,Age at blood draw,Generation?", "1,41,2nd", "2,61,1st (cell line)", "5,3,3rd"])
    table = samples.manifest(
        samples.read_typed_csv(spark, people, samples.MANIFEST_SCHEMA), samples.read_typed_csv(spark, ages, samples.AGES_SCHEMA)
    )
    assert rows(table) == [
        ("1", "NA12878", "F", 41.0, "2nd", "b/1.unique.sorted.bed"),
        ("5", "5", None, 3.0, "3rd", None),
    ]
    paths = samples.methylation_paths(table, {"model": "m", "count": "c"})
    assert ("1", "model", "hap1", "m/NA12878.GRCh38.hap1.sorted.bed.gz") in rows(paths, "uid", "mode", "haplotype", "path")
    assert ("5", "count", "combined", "c/5.GRCh38.haplotagged.combined.bed.gz") in rows(paths, "uid", "mode", "haplotype", "path")
    assert rows(samples.prefixes(table)) == [("5",), ("NA12878",)]
    everyone = samples.array_sample_paths(samples.read_typed_csv(spark, people, samples.MANIFEST_SCHEMA), "m")
    assert everyone.count() == 9
    ped = put("t.ped", ["# comment", "1463\tNA12878\tNA12891\tNA12892\t2\tnote"])
    assert rows(samples.read_pedigree(spark, ped), "child", "father", "mother") == [("NA12878", "NA12891", "NA12892")]


PILEUP_HEAD = ["##pileup-mode=count", "#chrom\tbegin\tend\tmod_score\ttype\tcov"]


@pytest.mark.parametrize("row", ["chr1\t2x\t3\t50.0\tTotal\t4", "chr1\t2\t3\t50.0", "chr1\t2\t3\tabc\tTotal\t4", "chr1\t2", "\t2\t3\t50.0\tTotal\t4"])
def test_damaged_pileup_rows_fail(spark, put, row):
    good = put("good.bed", [*PILEUP_HEAD, "chr1\t2\t3\t50.0\tTotal\t4"])
    assert bed.read_meth_level(spark, good, "count").collect()[0]["methylation_level"] == 0.5
    with pytest.raises(Exception, match="damaged row|MALFORMED|FAILFAST|CAST_INVALID"):
        bed.read_meth_level(spark, put("bad.bed", [*PILEUP_HEAD, "chr1\t2\t3\t50.0\tTotal\t4", row]), "count").collect()


def test_every_part_has_its_mode_checked(spark, put, tmp_path):
    put("parts/a.bed", [*PILEUP_HEAD, "chr1\t2\t3\t50.0\tTotal\t4"])
    put("parts/b.bed", ["##pileup-mode=model", PILEUP_HEAD[1], "chr1\t5\t6\t50.0\tTotal\t4"])
    with pytest.raises(bed.HeaderError, match="model"):
        bed.read_meth_level(spark, str(tmp_path / "parts"), "count")


@pytest.mark.parametrize("row", ["chr1\tx\t3", "chr1\t2", "\t2\t3"])
def test_damaged_bed_rows_fail(spark, put, row):
    with pytest.raises(Exception, match="damaged row|MALFORMED|FAILFAST"):
        bed.read_all_cpgs_in_reference(spark, put("cpgs.bed", ["chr1\t1\t2", row])).collect()
    put("table.bed.header", ["chrom", "start", "end"])
    with pytest.raises(Exception, match="damaged row|MALFORMED|FAILFAST"):
        bed.read_bed_and_header(spark, put("table.bed", ["chr1\t1\t2", row])).collect()


def variant_file(samples_, *rows_):
    head = "\t".join([*vcf.FIXED_COLUMNS, *samples_])
    return ["##fileformat=VCFv4.2", head, *["\t".join(r) for r in rows_]]


def test_damaged_variants(spark, put, rows):
    good = ("chr1", "5", ".", "A", "C", ".", ".", ".", "GT:PS", "0|1:7")
    for bad in (("chr1", "x5", *good[2:]), good[:-1]):
        path = put("bad.vcf", variant_file(["kid"], good, bad))
        with pytest.raises(Exception, match="damaged row|MALFORMED|FAILFAST"):
            vcf.read_read_phasing(spark, path).collect()
        with pytest.raises(Exception, match="damaged row|MALFORMED|FAILFAST"):
            vcf.read_inheritance_phasing(spark, path, "kid").collect()
    path = put("lenient.vcf", variant_file(["kid"], good, ("chr1", "x5", *good[2:])))
    assert rows(vcf.read_joint_variants(spark, path, "kid"), "start", "allele_2") == [(4, "1")]


def test_files_with_other_samples_are_not_read_by_position(spark, put):
    row = ("chr1", "5", ".", "A", "C", ".", ".", ".", "GT", "0|1", "1|1")
    one, two = put("one.vcf", variant_file(["kid", "dad"], row)), put("two.vcf", variant_file(["dad", "kid"], row))
    with pytest.raises(vcf.SampleError, match="different"):
        vcf.read_joint_variants(spark, [one, two], "kid")
    same = put("three.vcf", variant_file(["kid", "dad"], row))
    assert vcf.read_joint_variants(spark, [one, same], "kid").count() == 2


def test_first_match_of_the_last_line_counts(spark, rows, put, tmp_path):
    name = "/{}.dna-methylation.founder-phased.all_cpgs.bed"
    put("c.log", ["old " + name.format("Z9"), "in " + name.format("A1") + " and " + name.format("B2"), "share: 5.00%", "share: 10.00% or share: 20.00%", "end"])
    assert rows(reports.read_percentages(spark, str(tmp_path / "c.log"), "share")) == [("A1", 10.0)]


def test_trio_pairs_scan_their_file_once(spark, rows, tmp_path):
    """The tagged rows are those of both tables; the file is read in one scan, each table reads one partition."""
    calls = [("0|1", "1|0", "0/1"), ("1|0", "./.", "1|0"), ("1/1", "0|1", "0|1"), ("0/1", "0|1", "1|0"), (".|1", "0|1", "0|1"), ("0|0", "1|1", "0/0")]
    body = ["\t".join(["chr1", str(10 + i), ".", "A", "C", ".", ".", ".", "GT", *c]) for i, c in enumerate(calls)]
    path = tmp_path / "trio.vcf"
    path.write_text("\n".join(["##fileformat=VCFv4.2", "\t".join([*vcf.FIXED_COLUMNS, "K", "D", "M"]), *body]) + "\n")
    variants = vcf.read_variants(spark, str(path))
    plan = vcf.tagged_trio_pairs(variants, "K", "D", "M")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    apart = vcf.trio_pairs(variants, "K", "D", "M")
    staged = vcf.read_trio_pairs(spark, str(path), "K", "D", "M", partitions=2)
    for one, other in zip(staged, apart):
        assert one.columns == other.columns and rows(one) == rows(other) and one.count() > 0
        assert "PartitionFilters: [isnotnull(parent" in one._jdf.queryExecution().executedPlan().toString()


def test_the_combined_tracks_query_reads_compressed_files(spark):
    files = QUERIES["k2_k7_combined_tracks"](spark, FOLDER).inputFiles()
    assert files and all(name.endswith(".csv.gz") for name in files)
