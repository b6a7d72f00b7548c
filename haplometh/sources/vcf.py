"""Variant files as text: header on the driver, records as native expressions.

Several files with the same header (one per chromosome) are read as one table
by passing a list of paths.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haplometh.functions.genotypes import (
    UNKNOWN,
    allele,
    genotype_text,
    is_biallelic_snv,
    is_phased,
    is_snv_any_alts,
    phase_block_id,
)
from haplometh.sources.lines import distinct_lines, read_lines, required, split_records, spread
from haplometh.storage import materialize

# The columns of a variant file before its samples.
FIXED_COLUMNS = ("#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT")


class SampleError(ValueError):
    """The file's samples are not the ones asked for."""


def column_names(header: str) -> list[str]:
    names = header.rstrip("\n").split("\t")
    if tuple(names[: len(FIXED_COLUMNS)]) != FIXED_COLUMNS:
        raise SampleError(f"unexpected header of a variant file: {header[:120]!r}")
    return names


def sample_names(variants: DataFrame, by: Sequence[str] = ()) -> list[str]:
    return variants.columns[len(by) + len(FIXED_COLUMNS) :]


def _columns_of(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The columns that all of the files share."""
    headers = distinct_lines(read_lines(spark, path), FIXED_COLUMNS[0])
    if not headers:
        raise SampleError(f"{path} has no {FIXED_COLUMNS[0]} line")
    if len(headers) > 1:
        raise SampleError(f"the files of {path} have different samples or orders of samples; read them apart")
    return column_names(headers[0])


def read_variants(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Variant files as one string column per field; only the columns used later are parsed."""
    names = _columns_of(spark, path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.csv(path, sep="\t", comment="#", quote="", schema=schema, maxColumns=len(names) + 1)


def read_damaged_variants(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows that a tolerant reader passes over: ``file``, ``reason``, ``left_out`` and the ``line`` itself.

    Such a reader (``read_joint_variants``) leaves out rows without a
    whole-number position, and keeps rows with missing or surplus fields, whose
    missing values are null.
    """
    names = _columns_of(spark, path)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    fields = split_records(lines, "file", "value")
    position = F.get("f", F.lit(names.index("POS"))).try_cast("bigint")
    reason = F.when(position.isNull(), "no whole-number position").when(
        F.size("f") != len(names), F.format_string(f"%d fields, not {len(names)}", F.size("f"))
    )
    damaged = fields.withColumn("reason", reason).filter(F.col("reason").isNotNull())
    return damaged.select("file", "reason", position.isNull().alias("left_out"), F.col("value").alias("line"))


def variants_from_lines(lines: DataFrame, header: str) -> DataFrame:
    """The same columns from lines in a ``value`` column."""
    fields = split_records(lines)
    return fields.select(*[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(column_names(header))])


def _sites(
    variants: DataFrame, wanted: Mapping[str, str], lenient: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    """``by``, site columns, ``format`` and, per ``wanted`` name, the raw field of its sample.

    A row without a whole-number position or without a sample's field fails the
    job; ``lenient`` leaves such a row out.
    """
    samples = sample_names(variants, by)
    missing = [s for s in wanted.values() if s not in samples]
    if missing:
        raise SampleError(f"samples {missing} are not among the file's {len(samples)} samples")
    pos = F.col("POS").try_cast("bigint")
    raw = {name: F.col(f"`{s}`") for name, s in wanted.items()}
    if lenient:
        variants = variants.filter(pos.isNotNull())
    else:
        pos = required(pos, "POS")
        raw = {name: required(c, f"the field of {wanted[name]}") for name, c in raw.items()}
    return variants.select(
        *by,
        F.col("`#CHROM`").alias("chrom"),
        (pos - 1).alias("start"),
        pos.alias("end"),
        "REF",
        "ALT",
        F.col("FORMAT").alias("format"),
        *[c.alias(f"raw_{name}") for name, c in raw.items()],
    )


def format_field(raw: Column, key: str) -> Column:
    """A sample's value of a FORMAT key; null when the key or the value is absent."""
    place = F.array_position(F.split("format", ":"), key)
    value = F.get(F.split(raw, ":"), (place - 1).cast("int"))
    return F.when(place > 0, value)


def _genotype(name: str) -> Column:
    """A sample's genotype text; it is always the first field when there is one."""
    called = (F.col("format") == "GT") | F.col("format").startswith("GT:")
    return F.when(called, genotype_text(F.col(f"raw_{name}")))


def _with_genotypes(variants: DataFrame, wanted: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Biallelic SNVs with the genotype text of each wanted sample.

    With one alternative allele, genotypes are one-digit pairs: tests on them
    are single comparisons with the text, which stay cheap when Spark pushes
    them below other steps, and alleles are its first and third character.
    """
    snvs = _sites(variants, wanted, by=by).filter(is_biallelic_snv(F.col("REF"), F.col("ALT")))
    return snvs.withColumns({f"gt_{name}": _genotype(name) for name in wanted})


def _first(name: str) -> Column:
    return F.substring(f"gt_{name}", 1, 1)


def _second(name: str) -> Column:
    return F.substring(f"gt_{name}", 3, 1)


# Heterozygous genotypes at a site with one alternative allele, and
# the child's genotypes that tell its first or its second allele.
PHASED_HET = ("0|1", "1|0")
UNPHASED_HET = ("0/1", "1/0")
FIRST_KNOWN = r"^(?:[01]\|.|0/0|1/1)$"
SECOND_KNOWN = r"^(?:.\|[01]|0/0|1/1)$"
SITE_AND_ALLELES = ("chrom", "start", "end", "REF", "ALT")


def read_phasing(variants: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Phased heterozygous SNVs of a single-sample file, with their phase-block id.

    The columns ``by`` stand before those of the file.
    """
    samples = sample_names(variants, by)
    if len(samples) != 1:
        raise SampleError(f"expected one sample, found {len(samples)}")
    hets = _with_genotypes(variants, {"s": samples[0]}, by).filter(F.col("gt_s").isin(*PHASED_HET))
    return hets.select(
        *by,
        *SITE_AND_ALLELES,
        phase_block_id(format_field(F.col("raw_s"), "PS")).alias("phase_block_id"),
        _first("s").alias("allele_hap1"),
        _second("s").alias("allele_hap2"),
    )


def inheritance_phasing(variants: DataFrame, uid: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Heterozygous SNVs of one sample with paternal and maternal alleles; an unphased one fails the job."""
    gt = F.col("gt_s")
    hets = _with_genotypes(variants, {"s": uid}, by).filter(gt.isin(*PHASED_HET, *UNPHASED_HET))
    message = F.format_string("expected a phased genotype at %s:%d, found %s", F.col("chrom"), F.col("end"), gt)
    checked = F.when(is_phased(gt), gt).otherwise(F.raise_error(message).cast("string"))
    return hets.withColumn("gt_s", checked).select(
        *by, *SITE_AND_ALLELES, _first("s").alias("allele_pat"), _second("s").alias("allele_mat")
    )


def trio_pairs(variants: DataFrame, kid: str, dad: str, mom: str) -> tuple[DataFrame, DataFrame]:
    """Kid and parent alleles at the phased het SNVs of dad, and of mom.

    The kid must be phased or homozygous; SNVs at which the kid's transmitted
    allele is unknown say nothing and are left out.
    """
    parsed = _with_genotypes(variants, {"kid": kid, "dad": dad, "mom": mom})
    dad_side = parsed.filter(F.col("gt_dad").isin(*PHASED_HET) & F.col("gt_kid").rlike(FIRST_KNOWN))
    mom_side = parsed.filter(F.col("gt_mom").isin(*PHASED_HET) & F.col("gt_kid").rlike(SECOND_KNOWN))
    return (
        dad_side.select(
            *SITE_AND_ALLELES,
            _first("kid").alias("kid_allele_pat"),
            _first("dad").alias("dad_allele_A"),
            _second("dad").alias("dad_allele_B"),
        ),
        mom_side.select(
            *SITE_AND_ALLELES,
            _second("kid").alias("kid_allele_mat"),
            _first("mom").alias("mom_allele_C"),
            _second("mom").alias("mom_allele_D"),
        ),
    )


# The names of a pair's kid, first and second parent allele.
PAIR_COLUMNS = {
    "dad": ("kid_allele_pat", "dad_allele_A", "dad_allele_B"),
    "mom": ("kid_allele_mat", "mom_allele_C", "mom_allele_D"),
}


def tagged_trio_pairs(variants: DataFrame, kid: str, dad: str, mom: str) -> DataFrame:
    """The rows of both tables of :func:`trio_pairs` from one pass, told apart by ``parent``."""
    parsed = _with_genotypes(variants, {"kid": kid, "dad": dad, "mom": mom})

    def side(parent: str, known: str, allele_of_kid: Column) -> Column:
        alleles = zip(("kid_allele", "first", "second"), (allele_of_kid, _first(parent), _second(parent)))
        pair = F.struct(F.lit(parent).alias("parent"), *[c.alias(n) for n, c in alleles])
        return F.when(F.col(f"gt_{parent}").isin(*PHASED_HET) & F.col("gt_kid").rlike(known), pair)

    sides = F.array(side("dad", FIRST_KNOWN, _first("kid")), side("mom", SECOND_KNOWN, _second("kid")))
    return parsed.select(*SITE_AND_ALLELES, F.inline(F.filter(sides, lambda s: s.isNotNull())))


def joint_variants(variants: DataFrame, uids: Mapping[str, str], *, by: Sequence[str] = ()) -> DataFrame:
    """SNVs, also multi-allelic ones, with allele indices per role.

    ``uids`` maps a role to its sample; the role ``""`` gives ``allele_1`` and
    ``allele_2``, any other ``allele_1_<role>``. A field that is just ``.`` is null.
    """
    parsed = _sites(variants, {f"r{i}": uid for i, uid in enumerate(uids.values())}, lenient=True, by=by)

    def known(column: str) -> Column:
        return F.when(F.col(column) != UNKNOWN, F.col(column))

    alleles = []
    for i, role in enumerate(uids):
        gt = genotype_text(known(f"raw_r{i}"))
        infix = f"_{role}" if role else ""
        alleles += [allele(gt, 0).alias(f"allele_1{infix}"), allele(gt, 1).alias(f"allele_2{infix}")]
    return parsed.filter(is_snv_any_alts(known("REF"), known("ALT"))).select(*by, "chrom", "start", "end", *alleles)


def read_read_phasing(spark: SparkSession, path: str | list[str], *, partitions: int | None = None) -> DataFrame:
    return spread(read_phasing(read_variants(spark, path)), partitions)


def read_inheritance_phasing(
    spark: SparkSession, path: str | list[str], uid: str, *, partitions: int | None = None
) -> DataFrame:
    return spread(inheritance_phasing(read_variants(spark, path), uid), partitions)


def read_trio_pairs(
    spark: SparkSession, path: str | list[str], kid: str, dad: str, mom: str, *, partitions: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both tables of :func:`trio_pairs`, the file scanned and parsed once.

    The tagged rows are written once, a partition a parent, and each table
    reads its own partition.
    """
    rows = spread(tagged_trio_pairs(read_variants(spark, path), kid, dad, mom), partitions)
    staged = materialize(rows, "trio-pairs", by=("parent",))
    dad_pairs, mom_pairs = (
        staged.filter(F.col("parent") == parent).select(
            *SITE_AND_ALLELES, *[F.col(c).alias(n) for c, n in zip(("kid_allele", "first", "second"), names)]
        )
        for parent, names in PAIR_COLUMNS.items()
    )
    return dad_pairs, mom_pairs


def read_joint_variants(
    spark: SparkSession, path: str | list[str], uids: str | Mapping[str, str], *, partitions: int | None = None
) -> DataFrame:
    roles = {"": uids} if isinstance(uids, str) else uids
    return spread(joint_variants(read_variants(spark, path), roles), partitions)
