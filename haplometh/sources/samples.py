"""The sample manifest and the file locations that follow from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = {
    "LINK ID": "bigint",
    "Coriell ID": "bigint",
    "Gender": "string",
    "Age": "double",
    "PaID": "bigint",
    "MaID": "bigint",
    "Illumina-methylation-array betas at CpG sites": "string",
}
AGES_SCHEMA = {"LINK ID": "bigint", "Age at blood draw": "double", "Generation?": "string"}

# Read haplotypes, and the file-name pattern of each pileup mode.
HAPLOTYPES = ("hap1", "hap2", "combined")
PATH_PATTERNS = {
    "model": "%s/%s.GRCh38.%s.sorted.bed.gz",
    "count": "%s/%s.GRCh38.haplotagged.%s.bed.gz",
}
EXCLUDED_GENERATION = "1st"
ARRAY_COLUMN = "Illumina-methylation-array betas at CpG sites"
ARRAY_SUFFIX = ".unique.sorted.bed"


def read_typed_csv(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """Columns of a headed CSV by name; columns not asked for are not kept."""
    table = spark.read.csv(str(path), header=True)
    return table.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in types.items()])


def manifest(samples: DataFrame, ages: DataFrame) -> DataFrame:
    """Samples with age and generation, first-generation cell lines left out.

    A sample in only one of the tables is kept; one of unknown generation is not.
    """
    known = samples.select("LINK ID", "Coriell ID", "Gender", ARRAY_COLUMN)
    joined = known.join(ages, "LINK ID", "full").filter(~F.col("Generation?").startswith(EXCLUDED_GENERATION))
    coriell = F.concat(F.lit("NA"), F.col("Coriell ID").cast("string"))
    uid = F.col("LINK ID").cast("string")
    return joined.select(
        uid.alias("uid"),
        F.coalesce(coriell, uid).alias("prefix"),
        F.col("Gender").alias("gender"),
        F.col("Age at blood draw").alias("age"),
        F.col("Generation?").alias("generation"),
        F.replace(F.col(ARRAY_COLUMN), F.lit(".csv"), F.lit(ARRAY_SUFFIX)).alias("array_path"),
    )


def methylation_paths(samples: DataFrame, folders: dict[str, str]) -> DataFrame:
    """One row per sample, pileup mode and haplotype with the location of its file."""
    branches = [
        samples.select(
            "*", F.lit(mode).alias("mode"), F.explode(F.array(*map(F.lit, HAPLOTYPES))).alias("haplotype")
        ).withColumn("path", F.format_string(PATH_PATTERNS[mode], F.lit(folder), F.col("prefix"), F.col("haplotype")))
        for mode, folder in folders.items()
    ]
    out = branches[0]
    for branch in branches[1:]:
        out = out.unionByName(branch)
    return out


def array_sample_paths(samples: DataFrame, folder: str) -> DataFrame:
    """Every sample of the array manifest with its array file and one methylation file per haplotype."""
    coriell = F.concat(F.lit("NA"), F.col("Coriell ID").cast("string"))
    uid = F.col("LINK ID").cast("string")
    named = samples.select(
        uid.alias("uid"),
        F.coalesce(coriell, uid).alias("prefix"),
        F.replace(F.col(ARRAY_COLUMN), F.lit(".csv"), F.lit(".sorted.bed")).alias("array_path"),
    )
    return methylation_paths(named, {"model": folder}).drop("mode")


def prefixes(samples: DataFrame) -> DataFrame:
    return samples.select("prefix")


def read_pedigree(spark: SparkSession, path: str) -> DataFrame:
    """Family, child, parents and sex from a pedigree file with ``#`` comments."""
    schema = "family string, child string, father string, mother string, sex string, note string"
    return spark.read.csv(str(path), sep="\t", comment="#", schema=schema)
