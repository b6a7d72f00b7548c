"""Genomic interval operators.

Spark plans ``chrom = chrom AND start < end2 AND start2 < end`` as a hash join
on ``chrom`` with the range test on every pair of one chromosome. Here each
operator turns position into an equality key first, so the join work follows
the data density and not the chromosome size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from haplometh.storage import materialize

# Phase blocks reach from kilobases to megabases; one bin holds few of them.
BLOCK_BIN = 1 << 17
NEAREST_BIN = 1 << 14
MASK_BITS = 64
# Bits of a position inside a cell, the widest bin that adaptive_bins makes.
CELL_BITS = 20
# Block bounds of a cell for each of its bins.
BOUNDS_A_BIN = 4


#: Columns of dealt tables: the bin of a row's start, and the word of ``MASK_BITS`` bases that holds it.
BIN, WORD = "__bin", "__word"


def dealt_by_bin(df: DataFrame, bins: int | Bins, *, by: Sequence[str] = ()) -> DataFrame:
    """Rows with their bin as the column ``BIN``, and those of one bin in one partition.

    Groupings by ``by``, ``chrom``, ``BIN`` and more, and joins on just these
    three (``overlap_join``), need no further exchange.
    """
    if isinstance(bins, int):
        place = _bin(F.col("start"), bins)
        return df.repartition(*by, "chrom", place).withColumn(BIN, place)
    # The bits are nearly the same in all rows, the bin is not: it is spelled out after the exchange.
    place = F.expr("shiftleft(shiftright(start, __bits), __bits)")
    known = bins.of(df.withColumn("__cell", F.shiftright("start", CELL_BITS)), "__cell").select(*df.columns, "__bits")
    return known.repartition(*by, "chrom", place).withColumn(BIN, place).drop("__bits")


def with_bin(df: DataFrame, bins: int | Bins) -> DataFrame:
    """Rows with the column ``BIN``, wherever they lie: the first join by bin moves them, the next ones do not."""
    return _binned_sites(df, F.col("start"), bins)


def with_word(df: DataFrame) -> DataFrame:
    """``df`` with the column ``WORD``.

    A word holds few sites, so tables of sites joined by it, their starts and
    ends compared on the way, and marks of words (``within_distance``) all need
    the rows in the same places: one exchange serves a chain of such steps.
    """
    return df if WORD in df.columns else df.withColumn(WORD, _bin(F.col("start"), MASK_BITS))


def _bin(position: Column, size: int) -> Column:
    return F.floor(position / size) if size & (size - 1) else F.shiftright(position, size.bit_length() - 1)


def _checked_start(width: int) -> Column:
    """The left start, failing on an interval wider than the caller promised."""
    too_wide = F.col("end") - F.col("start") > width
    message = F.format_string("interval %s:%d-%d is wider than %d", "chrom", "start", "end", F.lit(width))
    return F.when(too_wide, F.raise_error(message).cast("bigint")).otherwise(F.col("start"))


@dataclass(frozen=True)
class Bins:
    """Bins as narrow as blocks are dense: ``chrom``, ``__cell`` and the ``__bits`` of a position inside a bin.

    Cells without a row are one bin each.
    """

    cells: DataFrame

    def of(self, df: DataFrame, cell: str) -> DataFrame:
        """``df`` with the ``__bits`` of the cells in a column."""
        known = self.cells.withColumnRenamed("__cell", cell)
        return df.join(known, ["chrom", cell], "left").withColumn("__bits", F.coalesce("__bits", F.lit(CELL_BITS)))


def adaptive_bins(right: DataFrame, *, by: Sequence[str] = ()) -> Bins:
    """Bins for blocks of mixed widths, also where one spans a chromosome and thousands lie inside it.

    A cell of 2^20 bases is cut into a power of two of equal bins, at most one
    for every ``BOUNDS_A_BIN`` block bounds in it, on average over the ``by``
    groups. A block gets a copy more for every bin border inside it, so where
    blocks lie ``d`` deep on average there are at most ``1 + d / 2`` copies of
    a block, and one for each cell that it spans: long blocks are not copied
    to bins that only short ones elsewhere need. Cells hold no ``by``: their
    number is bounded by the genome's length. They are written, so Spark knows
    their size when it joins them (a job on the block table).
    """
    bounds = right.filter(F.col("start") < F.col("end")).select(
        "chrom", F.explode(F.array(F.col("start"), F.col("end") - 1)).alias("bound")
    )
    groups = max(right.select(*by).distinct().count(), 1) if by else 1
    counted = bounds.groupBy("chrom", F.shiftright("bound", CELL_BITS).alias("__cell")).agg(F.count(F.lit(1)).alias("n"))
    most = F.floor(F.col("n") / (BOUNDS_A_BIN * groups))
    bits = CELL_BITS - F.least(F.length(F.bin(most)) - 1, F.lit(CELL_BITS))
    cells = counted.select("chrom", "__cell", bits.cast("int").alias("__bits")).filter(F.col("__bits") < CELL_BITS)
    return Bins(materialize(cells, "interval-cells"))


def _binned_sites(left: DataFrame, start: Column, bins: int | Bins) -> DataFrame:
    """Rows with the bin of their ``start``: a number for equal bins, else the bin's first base."""
    if isinstance(bins, int):
        return left.withColumn("__bin", _bin(start, bins))
    placed = left.withColumn("__start", start).withColumn("__cell", F.shiftright("__start", CELL_BITS))
    first = F.expr("shiftleft(shiftright(__start, __bits), __bits)")
    return bins.of(placed, "__cell").withColumn("__bin", first).select(*left.columns, "__bin")


def _binned_blocks(right: DataFrame, low: Column, high: Column, bins: int | Bins) -> DataFrame:
    """A copy of each row for every bin between the positions ``low`` and ``high``."""
    if isinstance(bins, int):
        return right.withColumn("__bin", F.explode(F.sequence(_bin(low, bins), _bin(high, bins))))
    spanned = F.sequence(F.shiftright("__low", CELL_BITS), F.shiftright("__high", CELL_BITS))
    cells = right.withColumns({"__low": low, "__high": high}).withColumn("__cell", F.explode(spanned))
    inside = {
        "__low": F.greatest("__low", F.shiftleft("__cell", CELL_BITS)),
        "__high": F.least("__high", F.shiftleft(F.col("__cell") + 1, CELL_BITS) - 1),
    }
    copies = F.explode(F.expr("sequence(shiftright(__low, __bits), shiftright(__high, __bits))"))
    placed = bins.of(cells.withColumns(inside), "__cell").withColumn("__bin", copies)
    return placed.withColumn("__bin", F.expr("shiftleft(__bin, __bits)")).select(*right.columns, "__bin")


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    how: str = "inner",
    *,
    suffix: str = "_block",
    by: Sequence[str] = (),
    bin_size: int | Bins = BLOCK_BIN,
    left_width: int = 1,
    dealt: bool = False,
) -> DataFrame:
    """Join narrow left intervals (sites, SNVs) to the right intervals they overlap.

    The right ``start`` and ``end`` come out as ``start<suffix>`` and
    ``end<suffix>``. One row per overlapping pair; ``how`` may be ``inner``,
    ``left``, ``left_semi`` or ``left_anti``.

    A left row gets one bin, that of its start. A right row is copied to every
    bin in which an overlapping left interval can start. A pair therefore meets
    in one bin only: nothing has to be deduplicated, a left join keeps its
    meaning, and the big left side is never copied. When the right side is
    below Spark's broadcast threshold the left side is not shuffled either;
    otherwise a hot bin is a skewed partition of an inner or left join, which
    adaptive execution splits on the left side. Bins are equal, of ``bin_size``
    bases, or follow the blocks (``adaptive_bins``).

    With ``dealt`` the left rows have their ``BIN`` (of the same bins) and keep
    it. If they lie dealt by it (``dealt_by_bin``), only the blocks are moved,
    and no bin is split, which suits tables that hold a site once: a bin bounds
    their number.
    """
    s, e = f"start{suffix}", f"end{suffix}"
    blocks = right.withColumnsRenamed({"start": s, "end": e}).filter(F.col(s) < F.col(e))
    binned = _binned_blocks(blocks, F.col(s) - (left_width - 1), F.col(e) - 1, bin_size)
    on = [*by, "chrom", "__bin"]
    checked = _checked_start(left_width)
    keyed = left.withColumn("start", checked) if dealt else _binned_sites(left, checked, bin_size)
    l, r = keyed.alias("l"), binned.alias("r")
    condition = (F.col("l.start") < F.col(f"r.{e}")) & (F.col(f"r.{s}") < F.col("l.end"))
    for key in on:
        condition = condition & (F.col(f"l.{key}") == F.col(f"r.{key}"))
    joined = l.join(r, condition, how)
    out = [F.col(f"l.{c}") for c in left.columns]
    if how not in ("left_semi", "left_anti"):
        out += [F.col(f"r.{c}") for c in binned.columns if c not in on]
    return joined.select(*out)


def within_distance(
    df: DataFrame,
    sites: DataFrame,
    distance: int,
    flag: str,
    *,
    by: Sequence[str] = (),
) -> DataFrame:
    """Add ``flag``: is there a site less than ``distance`` bases away from this one-base row?

    The distance is the gap between half-open intervals, 0 on overlap. The flag
    is null where the chromosome holds no site at all.

    Every site marks the positions near it as bits of 64-base words. ``bit_or``
    merges them before the shuffle, so copies of a site, however many, cost one
    word, and each word occurs once: the join adds exactly one row per row.
    Rows that have their ``WORD`` (``with_word``) keep it, and their places.
    """
    keys = [*by, "chrom"]
    low = F.col("start") - distance
    high = F.col("end") + (distance - 1)
    words = (
        sites.select(*keys, low.alias("low"), high.alias("high"))
        .withColumn("__word", F.explode(F.sequence(_bin(F.col("low"), MASK_BITS), _bin(F.col("high"), MASK_BITS))))
        .withColumn("from", F.greatest(F.col("low") - F.col("__word") * MASK_BITS, F.lit(0)).cast("int"))
        .withColumn("to", F.least(F.col("high") - F.col("__word") * MASK_BITS, F.lit(MASK_BITS - 1)).cast("int"))
        .withColumn("bits", F.expr("shiftleft(-1L, from) & shiftrightunsigned(-1L, 63 - to)"))
        .groupBy(*keys, "__word")
        .agg(F.bit_or("bits").alias("__bits"))
    )
    # One row per contig that has a site: bounded by the number of contigs (of each group).
    contigs = sites.select(*keys).distinct().withColumn("__has_site", F.lit(True))
    offset = F.pmod(F.col("start"), F.lit(MASK_BITS)).cast("int")
    near = F.when(
        F.col("__has_site"),
        F.coalesce(F.getbit(F.col("__bits"), offset) == 1, F.lit(False)),
    )
    if WORD in df.columns:
        placed = df.withColumn("start", _checked_start(1))
    else:
        placed = df.withColumn(WORD, _bin(_checked_start(1), MASK_BITS))
    return (
        placed.join(words, [*keys, WORD], "left")
        .join(F.broadcast(contigs), keys, "left")
        .select(*df.columns, near.alias(flag))
    )


def nearest(
    df: DataFrame,
    sites: DataFrame,
    *,
    by: Sequence[str] = (),
    distance: str = "distance",
    bin_size: int = NEAREST_BIN,
) -> DataFrame:
    """Add the gap to the nearest site (0 on overlap, null where the chromosome has none).

    Works on distinct coordinates, so a window partition holds at most one
    bin's positions, whatever the number of copies. Sites beyond the bin are
    carried in from a per-bin summary, whose window holds one row per occupied
    bin of a chromosome: its length divided by ``bin_size``.
    """
    keys = [*by, "chrom"]
    bins = [*keys, "__bin"]
    spots = df.select(*keys, "start", "end").distinct().withColumn("__site", F.lit(0))
    marks = (
        sites.groupBy(*keys, "start").agg(F.max("end").alias("end")).withColumn("__site", F.lit(1))
    )
    both = spots.unionByName(marks).withColumn("__bin", _bin(F.col("start"), bin_size))
    is_site = F.col("__site") == 1
    site_end, site_start = F.when(is_site, F.col("end")), F.when(is_site, F.col("start"))

    forward = W.partitionBy(*keys).orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)
    backward = W.partitionBy(*keys).orderBy(F.desc("__bin")).rowsBetween(W.unboundedPreceding, -1)
    carried = (
        both.groupBy(*bins)
        .agg(F.max(site_end).alias("e"), F.min(site_start).alias("s"))
        .select(*bins, F.max("e").over(forward).alias("__e"), F.min("s").over(backward).alias("__s"))
    )
    # A site at the same start sorts first: it is a left neighbour of the row.
    up = W.partitionBy(*bins).orderBy("start", F.desc("__site")).rowsBetween(W.unboundedPreceding, 0)
    down = W.partitionBy(*bins).orderBy(F.desc("start"), "__site").rowsBetween(W.unboundedPreceding, 0)
    gaps = (
        both.withColumn("__left", F.max(site_end).over(up))
        .withColumn("__right", F.min(site_start).over(down))
        .filter(~is_site)
        .join(carried, bins, "left")
        .select(
            *keys,
            "start",
            "end",
            F.greatest(
                F.least(
                    F.col("start") - F.greatest("__left", "__e"),
                    F.least("__right", "__s") - F.col("end"),
                ),
                F.when(F.coalesce("__left", "__e", "__right", "__s").isNotNull(), F.lit(0)),
            ).alias(distance),
        )
    )
    return df.join(gaps, [*keys, "start", "end"], "left").select(*df.columns, distance)


def parse_region(region: str) -> tuple[str, int | None, int | None]:
    """``chr1``, or ``chr1:1000000-2000000`` (commas allowed), as a 0-based half-open window."""
    chrom, _, span = region.partition(":")
    if not span:
        return chrom, None, None
    first, _, last = span.replace(",", "").partition("-")
    return chrom, int(first) - 1, int(last) if last else None


def region_filter(df: DataFrame, region: str, start: str = "start", end: str = "end") -> DataFrame:
    """Rows overlapping a 1-based inclusive region; plain comparisons, so they reach the scan."""
    chrom, low, high = parse_region(region)
    kept = df.filter(F.col("chrom") == chrom)
    if low is not None:
        kept = kept.filter(F.col(end) > low)
    if high is not None:
        kept = kept.filter(F.col(start) < high)
    return kept
