"""BED-like tables: methylation pileups, headered and headerless BED."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haplometh.functions.chroms import drop_alt_contigs
from haplometh.functions.methylation import fraction
from haplometh.sources.lines import distinct_lines, leading_comments, read_lines, required, split_records, spread

# Header keys and column names of methylation pileup files.
PILEUP_MODE = "##pileup-mode="
PILEUP_COLUMNS = ("#chrom", "begin", "end", "mod_score", "type", "cov")


class HeaderError(ValueError):
    """A file's header is missing or does not say what the caller expects."""


def column_type(name: str) -> T.DataType:
    """Type of a column of this library's tables, by its name."""
    if name.startswith(("start", "end", "num_", "total_read_count")):
        return T.LongType()
    if name.startswith("methylation_level") or "concordance" in name:
        return T.DoubleType()
    if name.startswith(("is_within_", "cpg_is_", "cpg_overlaps_")):
        return T.BooleanType()
    return T.StringType()


def schema_for(names: Sequence[str], types: Mapping[str, T.DataType] | None = None) -> T.StructType:
    types = types or {}
    return T.StructType([T.StructField(n, types.get(n, column_type(n))) for n in names])


def self_describing_header(comments: Sequence[str], what: str) -> list[str]:
    """Column names from the ``#`` line that must follow one or more ``##`` lines."""
    if not any(c.startswith("##") for c in comments):
        raise HeaderError(f"{what} has no comment lines starting with '##'")
    names = next((c for c in comments if not c.startswith("##")), None)
    if names is None:
        raise HeaderError(f"{what} has no header line starting with '#'")
    return names.split("\t")


def check_pileup_header(comments: Sequence[str], mode: str, what: str = "input") -> list[str]:
    """Column names of a pileup file whose header declares ``mode``."""
    names = self_describing_header(comments, what)
    declared = [c[len(PILEUP_MODE) :].strip() for c in comments if c.startswith(PILEUP_MODE)]
    if not declared:
        raise HeaderError(f"{what} has no {PILEUP_MODE} line")
    if any(d != mode for d in declared):
        raise HeaderError(f"{what} is in pileup mode {declared}, expected {mode!r}")
    missing = [c for c in PILEUP_COLUMNS if c not in names]
    if missing:
        raise HeaderError(f"{what} lacks the columns {missing}")
    return names


def meth_levels(pileup: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """``by`` and ``chrom, start, end, total_read_count, methylation_level`` of a pileup, alternative contigs dropped.

    A row that lacks one of them, or has text for a number, fails the job.
    """
    return drop_alt_contigs(
        pileup.select(
            *by,
            required(F.col("`#chrom`"), "#chrom").alias("chrom"),
            required(F.col("begin").cast("bigint"), "begin").alias("start"),
            required(F.col("end").cast("bigint"), "end").alias("end"),
            required(F.col("cov").cast("bigint"), "cov").alias("total_read_count"),
            fraction(required(F.col("mod_score").cast("double"), "mod_score")).alias("methylation_level"),
        )
    )


def strict(df: DataFrame) -> DataFrame:
    """A BED-like table whose first three columns, the site, are never null."""
    return df.withColumns({c: required(F.col(f"`{c}`"), c) for c in df.columns[:3]})


def pileup_from_lines(lines: DataFrame, names: Sequence[str], *, by: Sequence[str] = ()) -> DataFrame:
    """The shared pileup columns from lines in a ``value`` column."""
    at = {c: list(names).index(c) for c in PILEUP_COLUMNS}
    # Mode-specific columns after the shared ones stay one unsplit tail.
    fields = split_records(lines, *by, most=max(at.values()) + 2)
    return fields.select(*by, *[F.col("f")[i].alias(c) for c, i in at.items()])


def read_meth_level(
    spark: SparkSession, path: str, mode: str, *, partitions: int | None = None
) -> DataFrame:
    """One methylation pileup file of the given mode, alternative contigs dropped."""
    lines = read_lines(spark, path)
    names = check_pileup_header(leading_comments(lines), mode, str(path))
    others = {line[len(PILEUP_MODE) :].strip() for line in distinct_lines(lines, PILEUP_MODE)} - {mode}
    if others:
        raise HeaderError(f"{path} holds files in pileup mode {sorted(others)}, expected {mode!r}")
    types = {"begin": T.LongType(), "end": T.LongType(), "cov": T.LongType(), "mod_score": T.DoubleType()}
    schema = T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])
    pileup = spark.read.csv(str(path), sep="\t", comment="#", quote="", schema=schema, mode="FAILFAST")
    return spread(meth_levels(pileup), partitions)


def read_bed_and_header(
    spark: SparkSession, path: str, types: Mapping[str, T.DataType] | None = None
) -> DataFrame:
    """A headerless BED whose column names stand, one per line, in ``<path>.header``."""
    if not str(path).endswith(".bed"):
        raise HeaderError(f"{path} does not end in .bed")
    names = [row[0].strip() for row in read_lines(spark, f"{path}.header").collect()]
    return strict(spark.read.csv(str(path), sep="\t", schema=schema_for(names, types), quote="", mode="FAILFAST"))


def read_dataframe_from_bed(
    spark: SparkSession, path: str, types: Mapping[str, T.DataType] | None = None
) -> DataFrame:
    """A BED that names its columns in a ``#`` line after ``##`` lines."""
    names = self_describing_header(leading_comments(read_lines(spark, path)), str(path))
    names[0] = names[0].lstrip("#")
    table = spark.read.csv(str(path), sep="\t", comment="#", schema=schema_for(names, types), quote="", mode="FAILFAST")
    return strict(table)


def read_expanded(spark: SparkSession, path: str) -> DataFrame:
    """The final table of an expansion, typed, with ``start`` and ``end`` again."""
    return read_dataframe_from_bed(spark, path).withColumnsRenamed({"start_cpg": "start", "end_cpg": "end"})


def read_all_cpgs_in_reference(spark: SparkSession, path: str) -> DataFrame:
    return strict(spark.read.csv(str(path), sep="\t", schema="chrom string, start bigint, end bigint", mode="FAILFAST"))
