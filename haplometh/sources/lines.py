"""Text lines and their headers."""

from __future__ import annotations

from itertools import takewhile
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files; ``.gz`` is decompressed, one task per file."""
    return spark.read.text(path)


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Redistribute rows that one task produced from an unsplittable file."""
    return df.repartition(partitions) if partitions else df


def first_file(lines: DataFrame) -> DataFrame:
    """The first file by name: of a folder of parts, the one that starts with the header."""
    files = lines.inputFiles()
    return lines.sparkSession.read.text(unquote(min(files))) if len(files) > 1 else lines


def leading_comments(lines: DataFrame, batch: int = 256) -> list[str]:
    """The ``#`` lines before the first record; reads no further than that."""
    first = first_file(lines)
    while True:
        head = [row[0] for row in first.take(batch)]
        comments = list(takewhile(lambda line: line.startswith("#"), head))
        if len(comments) < len(head) or len(head) < batch:
            return comments
        batch *= 8


def distinct_lines(lines: DataFrame, prefix: str, most: int = 64) -> list[str]:
    """The different lines that start with ``prefix``, over all files; of one file, the first.

    A single file is read no further than its head. Several are scanned once,
    since each of them has a header of its own.
    """
    if len(lines.inputFiles()) <= 1:
        line = first_line_starting(lines, prefix)
        return [] if line is None else [line]
    return sorted(row[0] for row in lines.filter(F.col("value").startswith(prefix)).distinct().limit(most).collect())


def first_line_starting(lines: DataFrame, prefix: str) -> str | None:
    row = first_file(lines).filter(F.col("value").startswith(prefix)).take(1)
    return row[0][0] if row else None


def required(column: Column, what: str) -> Column:
    """``column``, failing the job where it is null: such a row is damaged and would vanish from joins."""
    return F.coalesce(column, F.raise_error(F.lit(f"damaged row: {what} is missing or not a number")))


def records(lines: DataFrame) -> DataFrame:
    """Lines that are neither comments nor blank."""
    return lines.filter(~F.col("value").startswith("#") & (F.col("value") != ""))


def split_records(lines: DataFrame, *by: str, most: int = -1) -> DataFrame:
    """``by`` and the tab-separated fields ``f`` of each record, split once.

    Spark would push a later filter on a field below a plain split, and split
    the line again for every time the filter names it; not so below a generator.
    """
    return records(lines).select(*by, F.explode(F.array(F.split("value", "\t", most))).alias("f"))
