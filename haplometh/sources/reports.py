"""Percentages out of the text logs of earlier runs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# How a log names its sample and writes a percentage.
SAMPLE_PATTERN = r"/(\w+)\.dna-methylation.founder-phased.all_cpgs.bed"
PERCENT_PATTERN = r": (\d+\.\d+)%"


def percentages_from_lines(lines: DataFrame, label: str) -> DataFrame:
    """``sample_id, percentage_of_cpg_sites`` from lines (``file``, ``place``, ``value``).

    Of each, the first match in the last line that has one counts. Logs that
    lack either are left out.
    """
    literal = re.sub(r"([^\w\s])", r"\\\1", label)

    def last_line(pattern: str) -> Column:
        found = F.when(F.col("value").rlike(pattern), F.col("place"))
        return F.max_by(F.regexp_extract("value", pattern, 1), found)

    matched = lines.filter(F.col("value").rlike(SAMPLE_PATTERN) | F.col("value").rlike(literal + PERCENT_PATTERN))
    found = matched.groupBy("file").agg(last_line(SAMPLE_PATTERN).alias("sample_id"), last_line(literal + PERCENT_PATTERN).alias("percentage"))
    return found.dropna().select("sample_id", F.col("percentage").cast("double").alias("percentage_of_cpg_sites")).orderBy("sample_id")


def percentages_from_texts(texts: DataFrame, label: str) -> DataFrame:
    """The same from whole logs in ``value``."""
    numbered = texts.select(F.monotonically_increasing_id().alias("file"), F.split("value", "\n").alias("lines"))
    return percentages_from_lines(numbered.select("file", F.posexplode("lines").alias("place", "value")), label)


def read_percentages(spark: SparkSession, pattern: str, label: str) -> DataFrame:
    """The percentage after ``label`` in every log matching the glob ``pattern``, read by lines."""
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = spark.read.text(pattern).select(F.col("_metadata.file_path").alias("file"), place.alias("place"), "value")
    return percentages_from_lines(lines, label)
