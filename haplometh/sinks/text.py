"""BED, bedGraph and VCF text output.

Sorted outputs are range-partitioned on the sort key, so every part is written
by its own task and the parts in name order are in genome order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from haplometh.functions.chroms import chrom_rank, drop_alt_contigs, is_alt_contig, with_version_order
from haplometh.operators.methylation import MODES, TRIO_HAPLOTYPES

# The two header lines of a variant file without calls.
VCF_FORMAT_LINE = "##fileformat=VCFv4.2"
VCF_COLUMNS = ("#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT")


def write_header(df: DataFrame, path: str) -> None:
    """Column names, one per line, at ``<path>.header``."""
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "value string")
    names.coalesce(1).write.mode("overwrite").text(f"{path}.header")


def write_table(df: DataFrame, path: str, compression: str = "none") -> None:
    """Headerless tab-separated text; nulls are empty."""
    df.write.mode("overwrite").csv(path, sep="\t", quote="", emptyValue="", compression=compression)


def write_bed(df: DataFrame, folder: str, stem: str, suffix: str = "bed") -> str:
    """``<stem>.<suffix>`` plus its ``.header`` in ``folder``."""
    path = f"{folder.rstrip('/')}/{stem}.{suffix}"
    write_table(df, path)
    write_header(df, path)
    return path


def write_bedgraph(df: DataFrame, folder: str, stem: str) -> str:
    return write_bed(df, folder, stem, "bedgraph")


def write_bed_and_header(df: DataFrame, path: str) -> str:
    if not path.endswith(".bed"):
        raise ValueError(f"{path} does not end in .bed")
    write_table(df, path)
    write_header(df, path)
    return path


def as_line(columns: Sequence[str]) -> Column:
    """One tab-separated line; ``concat_ws`` alone would drop nulls."""
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def write_lines(
    df: DataFrame, path: str, header: Sequence[str], keys: dict[str, Column], compression: str = "none"
) -> None:
    """Header lines, then the rows of ``df`` ordered by ``keys``, as text parts."""
    rows = df.select(F.lit(len(header)).alias("head"), *[k.alias(n) for n, k in keys.items()], as_line(df.columns).alias("value"))
    heads = df.sparkSession.createDataFrame(
        list(enumerate(header)), "head int, value string"
    )
    ordered = rows.unionByName(heads, allowMissingColumns=True).orderBy(
        "head", *[F.col(n).asc_nulls_last() for n in keys]
    )
    ordered.select("value").write.mode("overwrite").text(path, compression=compression)


def _genome_keys(start: str) -> dict[str, Column]:
    return {"rank": chrom_rank("chrom"), "name": F.col("chrom"), "at": F.col(start)}


def _start_column(df: DataFrame) -> str:
    return "start_cpg" if "start_cpg" in df.columns else "start"


def write_dataframe_to_bed(df: DataFrame, path: str, source: str, compression: str = "none") -> None:
    """Self-describing BED in genome order: a ``##source`` line, a ``#`` line of names, the rows."""
    header = [f"##source='{source}'", "#" + "\t".join(df.columns)]
    write_lines(df, path, header, _genome_keys(_start_column(df)), compression)


def write_methylation(df: DataFrame, path: str, source: str) -> str:
    """Compressed, genome-sorted BED at ``<path without suffix>.sorted.bed.gz``."""
    root = path.removesuffix(".bed")
    write_dataframe_to_bed(df, f"{root}.sorted.bed.gz", source, "gzip")
    return root


def write_vcf(df: DataFrame, path: str, uid: str | None = None) -> None:
    """Sites as a variant file without calls, 1-based, in chromosome-name order."""
    unset = F.lit(".")
    columns = {
        "chrom": F.col("chrom"),
        "pos": F.col("start") + 1,
        "id": unset,
        "REF": F.col("REF"),
        "ALT": F.col("ALT"),
        "qual": unset,
        "filter": unset,
        "info": unset,
        "format": unset,
        "call": unset,
    }
    rows = df.select(*[c.alias(n) for n, c in columns.items()])
    header = [VCF_FORMAT_LINE, "\t".join((*VCF_COLUMNS, uid or "SAMPLE"))]
    write_lines(rows, path, header, {"name": F.col("chrom"), "at": F.col("pos")})


def mismatch_stem(uid: str | None, parental: str | None) -> str:
    return f"{uid}." * bool(uid) + "bit-vector-sites-mismatches" + f".{parental}" * bool(parental)


def write_mismatches(df: DataFrame, folder: str, uid: str | None = None, parental: str | None = None) -> str:
    """Mismatch sites as BED (for proximity) and as VCF (for viewing); returns the BED path."""
    stem = f"{folder.rstrip('/')}/{mismatch_stem(uid, parental)}"
    write_vcf(df, f"{stem}.vcf", uid)
    return write_bed_and_header(df, f"{stem}.bed")


def write_hap_map_blocks(df: DataFrame, folder: str, uid: str, parental: str) -> str:
    """One parent's block labels as sorted BED."""
    blocks = df.select("chrom", "start", "end", f"{parental}_haplotype")
    ranked, order = with_version_order(blocks)
    return write_bed(ranked.orderBy(*order).select(*blocks.columns), folder, f"{uid}.hap-map-blocks.{parental}")


def tracks(df: DataFrame, columns: dict[str, str], *, by: Sequence[str] = ()) -> DataFrame:
    """Non-null levels as ``by``, ``chrom, start, end, value, track``: all tracks from one scan."""
    site = [*by, "chrom", "start", "end"]
    picked = df.select(*site, *[F.col(c).alias(t) for t, c in columns.items()])
    long = picked.unpivot(site, [F.col(f"`{t}`") for t in columns], "track", "value")
    return long.filter(F.col("value").isNotNull()).select(*site, "value", "track")


def founder_track_columns() -> dict[str, str]:
    return {f"{side}.{mode}": f"methylation_level_{side}_{mode}" for side in ("pat", "mat") for mode in MODES}


def trio_track_columns(ids: dict[str, str]) -> dict[str, str]:
    """Twelve tracks named ``<sample>.<haplotype>.<mode>``; ``ids`` gives each member's sample."""
    return {
        f"{ids[member]}.{name.split('_')[1]}.{mode}": f"methylation_level_{name}_{mode}"
        for name, (member, _, _) in TRIO_HAPLOTYPES.items()
        for mode in MODES
    }


def combined_track_columns(ids: dict[str, str]) -> dict[str, str]:
    """Six tracks of unphased levels."""
    return {f"{uid}.combined.{mode}": f"methylation_level_{m}_{mode}" for m, uid in ids.items() for mode in MODES}


def write_tracks(long: DataFrame, folder: str, *, by: Sequence[str] = (), compression: str = "none") -> None:
    """One bedGraph folder per track (of each group ``by``), each in genome order.

    With ``by``, folders of groups that the table does not hold stay as they are.
    """
    keys = [*by, "track", *[F.col(n).asc_nulls_last() for n in _genome_keys("start")]]
    placed = long.withColumns({n: k for n, k in _genome_keys("start").items()})
    _write_track_parts(placed.repartitionByRange(*keys).sortWithinPartitions(*keys), folder, by, compression)


def write_tracks_of(
    df: DataFrame, columns: dict[str, str], folder: str, *, by: Sequence[str] = (), compression: str = "none"
) -> None:
    """``write_tracks`` of the ``tracks`` of a table with a level a column.

    A site's levels are dealt in one row and become rows of their tracks in the
    range that they end in, so each range writes a part of every track it holds.
    """
    some = F.greatest(F.lit(False), *[F.col(c).isNotNull() for c in columns.values()])
    site, place = [*by, "chrom", "start", "end"], [F.col("__rank").asc_nulls_last(), "chrom", "start"]
    sites = df.filter(some).select(*site, *[F.col(c).alias(t) for t, c in columns.items()])
    ranges = sites.withColumn("__rank", chrom_rank("chrom")).repartitionByRange(*by, *place)
    long = ranges.unpivot([*site, "__rank"], [F.col(f"`{t}`") for t in columns], "track", "value").filter(F.col("value").isNotNull())
    _write_track_parts(long.sortWithinPartitions(*by, "track", *place), folder, by, compression)


def _write_track_parts(ordered: DataFrame, folder: str, by: Sequence[str], compression: str) -> None:
    mode = "dynamic" if by else "static"
    rows = ordered.select(*by, "chrom", "start", "end", "value", "track").write.mode("overwrite")
    rows.option("partitionOverwriteMode", mode).partitionBy(*by, "track").csv(folder, sep="\t", quote="", compression=compression)


def clean_bed(df: DataFrame, path: str) -> int:
    """Write the rows on primary contigs; returns how many rows were left out."""
    seen = Observation()
    counted = df.observe(
        seen, F.coalesce(F.sum(is_alt_contig("chrom").cast("bigint")), F.lit(0)).alias("removed")
    )
    write_table(drop_alt_contigs(counted), path)
    return seen.get["removed"]
