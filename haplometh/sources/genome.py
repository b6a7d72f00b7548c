"""CpG sites of a reference genome.

The genome is a table of ``(chrom, offset, seq)`` pieces, each one base longer
than its step so that a CG across two pieces is seen once. FASTA files become
such pieces without any task holding a chromosome.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from haplometh.functions.chroms import drop_alt_contigs
from haplometh.sources.ranges import RANGE_BYTES, read_fasta_ranges

PIECE = 200
# Fixed value: the dinucleotide; matching either case keeps every offset as it is.
CG = "[Cc][Gg]"
# Endings of compressed text files.
COMPRESSED = (".gz", ".bz2", ".zst")


def _cg_offsets(seq: Column) -> Column:
    """0-based offsets of every CG, in either case, in a short sequence."""
    parts = F.split(seq, CG)
    between = F.slice(parts, 1, F.size(parts) - 1)
    start = F.struct(F.array().cast("array<int>").alias("found"), F.lit(0).alias("at"))

    def step(seen: Column, part: Column) -> Column:
        here = seen["at"] + F.length(part)
        return F.struct(F.concat(seen["found"], F.array(here)).alias("found"), (here + 2).alias("at"))

    return F.aggregate(between, start, step)["found"]


def cpg_sites(chunks: DataFrame, *, piece: int = PIECE) -> DataFrame:
    """Every CpG site of the chunks, alternative contigs skipped before their sequence is looked at.

    Neighbouring chunks of a chromosome overlap by one base. Long chunks are
    cut into short pieces in one linear pass.
    """
    kept = drop_alt_contigs(chunks).select("chrom", "offset", "seq")
    cuts = F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{piece}}}"), F.lit(0))
    following = F.slice("cuts", F.lit(2), F.size("cuts"))
    joint = F.zip_with(
        "cuts", following, lambda text, after: F.concat(text, F.coalesce(F.substring(after, 1, 1), F.lit("")))
    )
    # The outer forms keep Spark from computing the arrays a second time in a size filter.
    pieces = (
        kept.select("chrom", "offset", cuts.alias("cuts"))
        .select("chrom", "offset", F.posexplode_outer(joint).alias("i", "text"))
        .filter(F.col("text").rlike(CG))
    )
    found = pieces.select(
        "chrom",
        (F.col("offset") + F.col("i") * piece).alias("base"),
        F.explode_outer(_cg_offsets(F.col("text"))).alias("at"),
    )
    start = (F.col("base") + F.col("at")).cast("bigint")
    return found.select("chrom", start.alias("start"), (start + 1).alias("end"))


def fasta_chunks(spark: SparkSession, path: str | list[str], width: int = RANGE_BYTES) -> DataFrame:
    """Sequences of FASTA files as overlapping chunks.

    Plain files are read in byte ranges of ``width``, so a chromosome in one
    line is as many tasks as one in many lines; compressed files go through the
    text scan, a task a file. Pieces are numbered inside their split, and a
    split's offset within a contig comes from a running sum over per-split
    totals, so no task needs more than one split. The first base of the next
    piece is appended, also across splits.
    """
    files = spark.read.text(path).inputFiles()
    packed = [unquote(f) for f in files if f.endswith(COMPRESSED)]
    plain = [unquote(f) for f in files if not f.endswith(COMPRESSED)]
    rows = []
    if plain or not packed:
        rows.append(read_fasta_ranges(spark, plain or path, width))
    if packed:
        lines = spark.read.text(packed).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("line"),
            F.rtrim("value").alias("value"),
        )
        rows.append(lines.filter(F.col("value") != ""))
    return chunks_of_fasta_lines(rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1]))


def chunks_of_fasta_lines(rows: DataFrame) -> DataFrame:
    """Chunks from ``(file, split, line, value)`` rows, ``line`` ordered within each split."""
    is_name = F.col("value").startswith(">")
    name = F.when(is_name, F.regexp_extract("value", r"^>(\S+)", 1))
    bases = F.when(is_name, 0).otherwise(F.length("value")).cast("bigint")
    in_split = W.partitionBy("file", "split").orderBy("line")
    before = in_split.rowsBetween(W.unboundedPreceding, -1)
    upto = in_split.rowsBetween(W.unboundedPreceding, 0)
    numbered = (
        rows.select("*", name.alias("name"), bases.alias("bases"))
        .withColumn("contig", F.last("name", ignorenulls=True).over(upto))
        .withColumn("seen", F.coalesce(F.sum("bases").over(before), F.lit(0)))
        .withColumn("name_at", F.last(F.when(is_name, F.col("seen")), ignorenulls=True).over(upto))
        .withColumn("next", F.lead("value").over(in_split))
    )
    # One row per file split: its last contig, the bases since that name (or in all), its first line.
    since_name = F.col("seen") + F.col("bases") - F.coalesce("name_at", F.lit(0))
    totals = numbered.groupBy("file", "split").agg(
        F.max_by("contig", "line").alias("last_name"),
        F.max_by(since_name, F.col("line")).alias("tail"),
        F.min_by("value", "line").alias("first_line"),
    )
    by_file = W.partitionBy("file").orderBy("split")
    earlier = by_file.rowsBetween(W.unboundedPreceding, -1)
    summary = (
        totals.withColumn("group", F.count("last_name").over(by_file.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("carried_contig", F.last("last_name", ignorenulls=True).over(earlier))
        .withColumn("next_first", F.lead("first_line").over(by_file))
    )
    running = W.partitionBy("file", "group").orderBy("split").rowsBetween(W.unboundedPreceding, 0)
    carried = summary.withColumn("after", F.sum("tail").over(running)).withColumn(
        "carried_bases", F.coalesce(F.lag("after").over(by_file), F.lit(0))
    )
    placed = numbered.join(
        carried.select("file", "split", "carried_contig", "carried_bases", "next_first"), ["file", "split"]
    )
    follower = F.coalesce("next", "next_first", F.lit(">"))
    joint = F.when(follower.startswith(">"), F.lit("")).otherwise(F.substring(follower, 1, 1))
    offset = F.when(F.col("contig").isNull(), F.col("carried_bases") + F.col("seen")).otherwise(
        F.col("seen") - F.col("name_at")
    )
    return placed.filter(F.col("name").isNull()).select(
        F.coalesce("contig", "carried_contig").alias("chrom"),
        offset.alias("offset"),
        F.concat("value", joint).alias("seq"),
    )


def scan_fasta(spark: SparkSession, path: str | list[str], width: int = RANGE_BYTES) -> DataFrame:
    """Every CpG site of a FASTA reference."""
    return cpg_sites(fasta_chunks(spark, path, width))
