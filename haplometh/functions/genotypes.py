"""VCF genotype fields as native array and string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marker of an unknown allele or block, the integer some VCF
# writers store for a missing phase set, and the genotype class labels.
UNKNOWN = "."
MISSING_PHASE_SET = "-2147483648"
HOM, HET = "hom", "het"


def genotype_text(sample_field: Column) -> Column:
    """The genotype part of a sample field such as ``0|1:12:34``."""
    return F.substring_index(sample_field, ":", 1)


def allele(genotype: Column, index: int) -> Column:
    """Allele ``index`` of a genotype text; ``.`` when the call has fewer alleles.

    A null genotype stays null: the record says nothing about this sample.
    """
    part = F.split_part(F.translate(genotype, "/", "|"), F.lit("|"), F.lit(index + 1))
    return F.when(part == "", UNKNOWN).otherwise(part)


def is_phased(genotype: Column) -> Column:
    return genotype.contains("|")


def is_het(first: Column, second: Column) -> Column:
    """Two known, different alleles; a half-missing call is not heterozygous."""
    return (first != second) & (first != UNKNOWN) & (second != UNKNOWN)


def is_biallelic_snv(ref: Column, alt: Column) -> Column:
    """One reference base and exactly one alternative base."""
    return (F.length(ref) == 1) & alt.rlike("^[ACGT]$")


def is_snv_any_alts(ref: Column, alt: Column) -> Column:
    """One reference base and one or more one-base alternatives."""
    return (
        (F.length(ref) == 1)
        & alt.isNotNull()
        & F.forall(F.split(alt, ","), lambda base: F.length(base) == 1)
    )


def genotype_class(first: Column, second: Column) -> Column:
    """``hom``, ``het`` or ``.`` (unknown, or no variant at all)."""
    return (
        F.when(first.isNull() & second.isNull(), UNKNOWN)
        .when((first == UNKNOWN) | (second == UNKNOWN), UNKNOWN)
        .when(first == second, HOM)
        .otherwise(HET)
    )


def allele_letters(ref: Column, alt: Column) -> Column:
    """Bases by allele index: the reference first, then each alternative."""
    return F.split(F.concat_ws(",", ref, alt), ",")


def allele_letter(ref: Column, alt: Column, index: Column) -> Column:
    """The base an allele index stands for, ``.`` when it is unknown."""
    return F.coalesce(F.get(allele_letters(ref, alt), index.try_cast("int")), F.lit(UNKNOWN))


def phase_block_id(phase_set: Column) -> Column:
    """Phase-set id as text, ``.`` when the record has none."""
    missing = phase_set.isNull() | (phase_set == MISSING_PHASE_SET)
    return F.when(missing, UNKNOWN).otherwise(phase_set)
