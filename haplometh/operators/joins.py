"""Equality joins on genomic keys.

``full_outer`` is the two-table operator with full join semantics.
``align_sites`` lines up any number of one-row-per-site tables in one shuffle,
which is what the workflows use for their 4 to 12 methylation files;
``align_unique_sites`` does so for tables that may repeat sites, and tells which.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from haplometh.keys import SITE, with_by
from haplometh.operators.intervals import BIN, BLOCK_BIN, WORD, Bins, dealt_by_bin, with_word
from haplometh.storage import SITE_CODEC, materialize

#: Rows of one key on one side that a task of a join takes; keys with more are split.
CELL_ROWS = 1 << 17
#: Keys of a side that are counted while it is read, the most that are split, and into how many parts at most.
COUNTED_KEYS, MOST_HEAVY, MOST_PARTS = 20_000, 1000, 256
#: Column of folded tables: no table repeats the site.
ONCE = "__once"


def full_outer(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] = SITE,
    *,
    null_safe: bool = False,
    hot_keys: bool = False,
) -> DataFrame:
    """Full outer join with one merged set of key columns.

    ``null_safe`` lets null keys match each other. The join stays an equality
    join either way.

    Spark holds all rows of one key in memory for a full outer join and cannot
    split it. Where one key may hold a large share of a side (repeated copies
    of a site), ``hot_keys`` measures both sides first (``heavy_keys``, a job
    on the key columns) and joins the rows of heavy keys apart: cut into cells
    of at most ``CELL_ROWS`` rows a side, each a key of its own. Without heavy
    keys the plan is the plain join.
    """
    rest = [c for c in right.columns if c not in on]
    if hot_keys:
        heavy = heavy_keys(left, right, on)
        if heavy is not None:
            return _split_full_outer(left, right, on, null_safe, heavy)
    if not null_safe:
        joined = left.join(right, list(on), "full")
    else:
        joined = _keyed_join(left, right, on, "full", True)
    return joined.select(*left.columns, *rest)


def key_digest(on: Sequence[str]) -> Column:
    """What ``heavy_keys`` knows a key by."""
    return F.xxhash64(*[F.col(c) for c in on])


def heavy_keys(left: DataFrame, right: DataFrame, on: Sequence[str], cell_rows: int | None = None) -> DataFrame | None:
    """Digests of the keys with more than ``cell_rows`` rows on a side, and the number of parts of each side; None without any.

    Counts come from a sketch of frequent items, a partial aggregate of bounded
    size: no key is shuffled. Its error decides only which keys are split, and
    how finely, never a row of the join. At most ``MOST_HEAVY`` rows a side.
    """
    most = cell_rows or CELL_ROWS

    def counted(df: DataFrame) -> dict[int, int]:
        # a sketch must track more keys than it reports
        top = df.select(key_digest(on).alias("key")).agg(F.expr(f"approx_top_k(key, {MOST_HEAVY}, {COUNTED_KEYS})").alias("top"))
        return {r["item"]: r["count"] for r in top.collect()[0]["top"] if r["item"] is not None and r["count"] > most}

    found = counted(left), counted(right)
    if not any(found):
        return None
    parts = [(key, *[min(MOST_PARTS, -(-side.get(key, 1) // most)) for side in found]) for key in sorted({*found[0], *found[1]})]
    return left.sparkSession.createDataFrame(parts, "__key bigint, __left int, __right int")


def _split_full_outer(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: bool, heavy: DataFrame) -> DataFrame:
    """The full outer join with the rows of ``heavy`` keys joined in cells.

    A left row of a heavy key draws one of its side's parts and is copied to
    every part of the other side, and the other way round, so each pair meets
    in exactly one cell. Rows without partner need only the few distinct heavy
    keys of the other side. A part is drawn by the row's place in its input
    partition, which files and written tables repeat when a task is repeated.
    """
    rest = [c for c in right.columns if c not in on]
    plain, apart = [], []
    for df, own, other in ((left, "__left", "__right"), (right, "__right", "__left")):
        keyed = df.withColumn("__key", key_digest(on))
        plain.append(keyed.join(F.broadcast(heavy.select("__key")), "__key", "left_anti").drop("__key"))
        rows = keyed.join(F.broadcast(heavy), "__key")  # at most twice MOST_HEAVY rows
        drawn = F.pmod(F.monotonically_increasing_id(), F.col(own)).cast("int")
        apart.append((rows.select(*df.columns), rows.withColumn(f"{own}_part", drawn).withColumn(f"{other}_part", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).select(*df.columns, "__left_part", "__right_part")))
    cells = [*on, "__left_part", "__right_part"]
    (l_rows, l_cells), (r_rows, r_cells) = apart
    parts = [
        full_outer(*plain, on, null_safe=null_safe),
        _keyed_join(l_cells, r_cells, cells, "inner", null_safe),
        _keyed_join(l_rows, r_rows.select(*on).distinct(), on, "left_anti", null_safe),
        _keyed_join(r_rows, l_rows.select(*on).distinct(), on, "left_anti", null_safe),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part.drop("__left_part", "__right_part"), allowMissingColumns=True)
    return out.select(*left.columns, *rest)


def _keyed_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, list(on), how)
    l, r = left.alias("l"), right.alias("r")
    condition = F.lit(True)
    for key in on:
        condition = condition & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    joined = l.join(r, condition, how)
    if how == "left_anti":
        return joined
    merged = {key: F.coalesce(F.col(f"l.{key}"), F.col(f"r.{key}")).alias(key) for key in on}
    columns = [merged.get(c, F.col(f"l.{c}")) for c in left.columns]
    columns += [F.col(f"r.{c}") for c in right.columns if c not in on]
    return joined.select(*columns)


def align_sites(
    tables: Mapping[str, DataFrame],
    values: Mapping[str, Mapping[str, str]],
    *,
    by: Sequence[str] = (),
    presence: Sequence[str] = (),
) -> DataFrame:
    """Full outer join of many tables that hold each site at most once.

    ``values[name]`` maps a table's own columns to their output names, and a
    name in ``presence`` yields a boolean ``has_<name>``. All tables are stacked
    as narrow rows, shuffled once by site and folded by a hash aggregate,
    instead of one two-sided shuffle and sort per pairwise join. A site repeated
    within one table raises an error, since a fold would merge what a join
    would multiply; ``align_unique_sites`` takes such tables.
    """
    folded, outputs = _folded(tables, values, by, presence)
    # As many tags as rows: every table holds the site once at most.
    message = F.format_string("site %s:%d occurs more than once in one table", "chrom", "start")
    checked = F.when(F.col(ONCE), F.col("chrom")).otherwise(F.raise_error(message).cast("string")).alias("chrom")
    return folded.select(*[checked if c == "chrom" else F.col(c) for c in outputs])


def align_unique_sites(
    tables: Mapping[str, DataFrame],
    values: Mapping[str, Mapping[str, str]],
    *,
    by: Sequence[str] = (),
    presence: Sequence[str] = (),
    bins: int | Bins = BLOCK_BIN,
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """As ``align_sites``, of the sites that no table repeats; and the keys of the others, or None.

    The aligned rows are written, and whether a site repeats is observed while
    they are. Rows of repeated sites are left to joins that multiply copies.

    What ``then`` makes of the aligned rows is written in their place. They come
    to it dealt by ``bins`` (``dealt_by_bin``), so what it does by bin needs no
    exchange; it must keep the site and ``ONCE``, may drop or add any other
    column, and may make several rows of a site, but not leave one out.
    """
    folded, outputs = _folded(tables, values, by, presence, bins if then else None)
    if then is None:
        built = folded
    else:
        built = then(folded)
        outputs = [c for c in built.columns if c != ONCE]
    seen = Observation()
    aligned = materialize(built.observe(seen, F.count_if(~F.col(ONCE)).alias("repeated")), "aligned", compression=SITE_CODEC)
    if not seen.get["repeated"]:
        return aligned.select(*outputs), None
    repeated = materialize(aligned.filter(~F.col(ONCE)).select(*with_by(by)).distinct(), "repeated-sites")
    return aligned.filter(ONCE).select(*outputs), repeated


def at_sites(tables: Mapping, sites: DataFrame, *, by: Sequence[str] = ()) -> dict:
    """The rows of each table at the given sites."""
    return {name: table.join(sites, with_by(by), "left_semi") for name, table in tables.items()}


def _folded(
    tables: Mapping[str, DataFrame], values: Mapping[str, Mapping[str, str]], by: Sequence[str], presence: Sequence[str],
    bins: int | Bins | None = None,
) -> tuple[DataFrame, list[str]]:
    """All tables folded by site, with ``ONCE`` (no table repeats the site), and the names of the output columns.

    With ``bins`` the rows lie dealt by them and have their ``BIN``.
    """
    keys = with_by(by)
    # A width says what the end says, and is the same number in nearly all rows: they shrink when compressed.
    width = (F.col("end") - F.col("start")).alias("__width")
    slots = {name: _typed_slots(table, values.get(name, {})) for name, table in tables.items()}
    kinds = {slot: kind for used in slots.values() for slot, kind in used.values()}

    stacked = None
    outputs: list[Column] = []
    flags: list[Column] = []
    for tag, (name, table) in enumerate(tables.items()):
        here = F.col("__tag") == tag
        source_of = {slot: source for source, (slot, _) in slots[name].items()}
        for source, output in values.get(name, {}).items():
            outputs.append(F.max(F.when(here, F.col(slots[name][source][0]))).alias(output))
        if name in presence:
            flags.append(F.getbit("__tags", F.lit(tag)).cast("boolean").alias(f"has_{name}"))
        cells = [
            (F.col(source_of[slot]) if slot in source_of else F.lit(None).cast(kind)).alias(slot)
            for slot, kind in kinds.items()
        ]
        rows = table.select(*[width if k == "end" else F.col(k) for k in keys], F.lit(tag).cast("tinyint").alias("__tag"), *cells)
        stacked = rows if stacked is None else stacked.union(rows)

    # Shuffling before the aggregate keeps the exchanged rows narrow; the fold
    # then needs no second exchange.
    place = [BIN] if bins else []
    dealt = dealt_by_bin(stacked, bins, by=by) if bins else stacked.repartition(*by, "chrom", "start")
    folded = (
        dealt.groupBy(*by, "chrom", *place, "start", "__width")
        .agg(
            *outputs,
            F.count(F.lit(1)).alias("__rows"),
            F.bit_or(F.expr("shiftleft(1L, cast(__tag as int))")).alias("__tags"),
        )
        .withColumn("end", F.col("start") + F.col("__width"))
    )
    once = (F.col("__rows") == F.bit_count("__tags")).alias(ONCE)
    kept = [*keys, *[c for c in folded.columns if not c.startswith("__") and c not in keys]]
    return folded.select(*kept, *flags, once, *place), [*kept, *[f"has_{name}" for name in tables if name in presence]]


def _typed_slots(table: DataFrame, columns: Mapping[str, str]) -> dict[str, tuple[str, str]]:
    """Where each value column sits in the stacked rows: slots are shared by type across tables."""
    used: dict[str, int] = {}
    placed = {}
    for source in columns:
        kind = table.schema[source].dataType.simpleString()
        used[kind] = used.get(kind, 0) + 1
        placed[source] = (f"__{kind}{used[kind]}", kind)
    return placed


def left_by_word(left: DataFrame, right: DataFrame, on: Sequence[str], *, by: Sequence[str] = ()) -> DataFrame:
    """The left join on ``on``, keys of sites among them, with the rows dealt by their words (``with_word``).

    The keys of the plan are ``by``, ``chrom`` and ``WORD``, which the result
    keeps; what else is in ``on`` is compared in the word, as a range, since
    Spark would take an equality as a key and deal the rows by it, too.
    """
    places = [*by, "chrom", WORD]
    l, r = with_word(left).alias("l"), with_word(right).alias("r")
    condition = F.lit(True)
    for key in places:
        condition = condition & (F.col(f"l.{key}") == F.col(f"r.{key}"))
    for key in on:
        if key not in places:
            condition = condition & F.col(f"l.{key}").between(F.col(f"r.{key}"), F.col(f"r.{key}"))
    rest = [F.col(f"r.{c}") for c in right.columns if c not in (*on, *places)]
    return l.join(r, condition, "left").select("l.*", *rest)


def created_sites(sample: DataFrame, reference: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Sites of the sample that the reference genome lacks."""
    return sample.join(reference, with_by(by), "left_anti")


def undetected_sites(reference: DataFrame, sample: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Reference sites at which the sample reports no methylation."""
    return reference.join(sample, with_by(by), "left_anti")


def rows_at(df: DataFrame, coordinates: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full rows at the given distinct coordinates."""
    return df.join(coordinates, list(on), "left_semi")
