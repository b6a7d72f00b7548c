"""Mixing sources to target weights, with DataFrame functions alone.

Each source gets a budget of words; complete epochs of a source come first, and
the fraction that is left is filled by weighted sampling without replacement
(Efraimidis and Spirakis): every document has an exponential key divided by its
quality weight, and the documents with the smallest keys fill the budget.

The running sum that finds them is never one sorted task: keys fall into
``KEY_BINS`` bins by a monotone function, bins are summed first, and the bin in
which the budget runs out is split again over the keys it holds, then over the
rows of one key, until it has at most ``FEW`` rows; only these are sorted, for
each source apart.

Null sources form a source of their own, after all others; null or empty texts
have size 0 and are taken as often as the epochs say. The draw is a hash of
``doc_id`` and source; rows equal in both follow each other by a digest of the
text, so reruns agree whatever the order of the rows, and only rows with the
same doc_id, source and text are interchangeable. A repeated row is a document
of its own. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from haplometh.storage import materialize

#: Bins of the keys of a source; even at quality weight 1, fuller at the end of the keys below it.
KEY_BINS = 65536
#: Rows of a source that are sorted; a bin with more is split again.
FEW = 10_000
#: The most often a source may be repeated.
MOST_EPOCHS = 3
WEIGHTS = (1.0, 2.0, 3.0)


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; 0 for null."""
    marked = F.translate(text, "\t\n\u000b\f\r", "     ")
    return F.coalesce(F.size(F.filter(F.split(marked, " "), lambda w: w != "")), F.lit(0)).cast("long")


def quality(text: Column, size: Column) -> Column:
    """A weight from 0.25 to 1: how near the mean word length is to that of prose."""
    mean = F.coalesce(F.length(text), F.lit(0)) / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(0.25), 1.0 / (1.0 + F.abs(mean - 6.0) / 6.0))


def sizes(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One narrow row a document: its size, source, and place among the keys of its source."""
    rows = docs.select(*[docs[c].alias(f"mix_keep{i}") for i, c in enumerate(keep)], docs["source"].alias("mix_source"), docs["doc_id"].alias("mix_id"), docs["text"].alias("mix_text"), word_count(docs["text"]).alias("mix_size"))
    # 46 bits of the text's digest, then 17 that tell rows with the same text apart
    apart = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 17))
    rows = rows.withColumn("mix_row", F.shiftleft(F.shiftrightunsigned(F.xxhash64("mix_text"), 18), 17).bitwiseOR(apart))
    draw = (F.pmod(F.shiftright(F.xxhash64("mix_id", "mix_source"), 11), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    key = -F.log(draw) / quality(F.col("mix_text"), F.col("mix_size"))
    rows = rows.withColumn("mix_key", key).drop("mix_text")
    return rows.withColumn("mix_bin", F.least(F.floor(KEY_BINS * (1 - F.exp(-F.col("mix_key")))), F.lit(KEY_BINS - 1)).cast("int"))


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``mix_source``, ``mix_total`` and ``mix_target`` of each source.

    Sources by code point, null last, weigh ``weights`` in turn and share the
    total; no target passes ``most`` times its source's size. With sources in
    the order of cap to weight, the ones that reach their cap come first, and
    the others share what is left: the level at which resharing ends.
    """
    per_source = sized.groupBy("mix_source").agg(F.sum("mix_size").alias("mix_total"))
    turn = F.row_number().over(Window.orderBy(F.col("mix_source").asc_nulls_last())) - 1
    listed = per_source.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights)).cast("int") + 1))
    cap = F.col("mix_total") * most
    order = Window.orderBy(cap / F.col("w"), F.col("mix_source").asc_nulls_last())
    before, from_here = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("mix_total").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))) / F.sum("w").over(from_here)
    place = F.struct((cap / F.col("w")).alias("ratio"), F.col("mix_source").isNull().alias("mix_last"), F.col("mix_source").alias("name"))
    shared = listed.withColumn("place", place).withColumn("level", level)
    settled = F.min(F.when(F.col("level") <= F.col("place.ratio"), F.struct("place", "level"))).over(everything)
    shared = shared.withColumn("settled", settled)
    target = F.when(F.col("place") >= F.col("settled.place"), F.col("settled.level") * F.col("w")).otherwise(cap.cast("double"))
    return shared.select("mix_source", "mix_total", target.alias("mix_target"))


def mix(docs: DataFrame, keep: Sequence[str] = ("doc_id",), weights: Sequence[float] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``keep``, ``mix_size``, ``mix_total``, ``mix_target`` and ``mix_copies`` (how often the mix takes the document)."""
    return _mixed(docs, keep, weights, most).select(*_kept(keep), "mix_size", "mix_total", "mix_target", "mix_copies")


def _kept(keep: Sequence[str]) -> list[Column]:
    return [F.col(f"mix_keep{i}").alias(c) for i, c in enumerate(keep)]


def _mixed(docs: DataFrame, keep: Sequence[str], weights: Sequence[float], most: int) -> DataFrame:
    """The mix, with the columns ``keep`` by number, so that their names cannot clash.

    After the complete epochs the documents with the smallest keys are taken
    once more while they fit the rest of the budget. Of those that follow, the
    one whose size is nearest to what is still missing is added if that brings
    the sum nearer to the target.
    """
    sized = materialize(sizes(docs, keep), "mix-sizes")
    budget = targets(sized, weights, most)
    whole = F.when(F.col("mix_total") > 0, F.least(F.floor(F.col("mix_target") / F.col("mix_total")), F.lit(most))).otherwise(F.lit(0)).cast("long")
    budget = budget.withColumn("mix_epochs", whole).withColumn("mix_rest", F.col("mix_target") - F.col("mix_epochs") * F.col("mix_total"))
    plan = edges(sized, budget)
    same = lambda a, b: a["mix_source"].eqNullSafe(b["mix_source"])
    turn = Window.partitionBy("mix_source").orderBy("mix_key", "mix_row").rowsBetween(Window.unboundedPreceding, 0)
    inner = planned(sized, plan).filter(at_edge()).withColumn("mix_upto", F.col("mix_before") + F.sum("mix_size").over(turn))
    inner = inner.filter(F.col("mix_upto") <= F.col("mix_rest")).groupBy("mix_source").agg(F.max(F.struct("mix_key", "mix_row")).alias("mix_last"), F.max("mix_upto").alias("mix_upto"))
    gap = (F.col("mix_rest") - F.coalesce(F.col("mix_upto"), F.col("mix_before"))).alias("mix_gap")
    plan = materialize(plan.join(inner, same(plan, inner), "left").select(plan["*"], "mix_last", gap), "mix-plan")
    place = F.struct("mix_key", "mix_row")
    ahead = (place < F.struct(F.col("mix_low").alias("mix_key"), F.col("mix_from").alias("mix_row"))) | F.coalesce(place <= F.col("mix_last"), F.lit(False))
    taken = (F.col("mix_bin") < F.col("mix_edge")) | ((F.col("mix_bin") == F.col("mix_edge")) & ahead)
    miss = F.abs(F.col("mix_gap") - F.col("mix_size"))
    closing = planned(sized, plan).filter(~taken & (miss < F.col("mix_gap"))).groupBy("mix_source").agg(F.min(F.struct(miss.alias("miss"), "mix_key", "mix_row")).alias("mix_closing"))
    closing = closing.select("mix_source", F.struct("mix_closing.mix_key", "mix_closing.mix_row").alias("mix_closing"))
    plan = materialize(plan.join(closing, same(plan, closing), "left").select(plan["*"], "mix_closing"), "mix-plan")
    more = (taken | F.coalesce(place == F.col("mix_closing"), F.lit(False))).cast("long")
    return planned(sized, plan).withColumn("mix_copies", F.col("mix_epochs") + more)


#: What a plan knows of the rows at its edge: bin, size of all rows before, their number, and the range of their keys and row numbers.
_EDGE = {"mix_edge": "mix_bin", "mix_before": "before", "mix_n": "n", "mix_low": "low", "mix_high": "high", "mix_from": "first", "mix_to": "last"}


def at_edge() -> Column:
    """Whether a planned row is one of those among which its budget runs out."""
    inside = F.col("mix_key").between(F.col("mix_low"), F.col("mix_high")) & F.col("mix_row").between(F.col("mix_from"), F.col("mix_to"))
    return (F.col("mix_bin") == F.col("mix_edge")) & inside


def edges(sized: DataFrame, budget: DataFrame) -> DataFrame:
    """``budget`` with the rows of each source among which it runs out, at most ``FEW``, by ``_EDGE``; bin -1 for none."""
    bins = with_sums(sized.withColumn("bin", F.col("mix_bin")))
    plan = materialize(narrowed(budget.withColumns({"mix_before": F.lit(0).cast("long"), "mix_edge": F.lit(-1), "mix_n": F.lit(0).cast("long"), **{c: F.lit(None).cast(k) for c, k in (("mix_low", "double"), ("mix_high", "double"), ("mix_from", "long"), ("mix_to", "long"))}}), bins), "mix-plan")
    while (plan.agg(F.max("mix_n")).collect()[0][0] or 0) > FEW:
        part = lambda x, low, high: F.floor(F.try_divide((F.col(x) - F.col(low)).cast("double"), (F.col(high) - F.col(low)).cast("double")) * KEY_BINS)
        # null where all keys, or row numbers, are one
        place = F.least(F.coalesce(part("mix_key", "mix_low", "mix_high"), part("mix_row", "mix_from", "mix_to"), F.lit(0)), F.lit(KEY_BINS - 1))
        bins = with_sums(planned(sized, plan).filter(at_edge() & (F.col("mix_n") > FEW)).withColumn("bin", place))
        plan = materialize(narrowed(plan, bins), "mix-plan")
    return plan


def with_sums(rows: DataFrame) -> DataFrame:
    """The bins of each source, in each the number of rows, their size and ranges, and the size of the bins ``before``."""
    sums = F.sum("mix_size").alias("bin_size"), F.count("*").alias("n"), F.first("mix_bin").alias("mix_bin")
    bins = rows.groupBy("mix_source", "bin").agg(*sums, F.min("mix_key").alias("low"), F.max("mix_key").alias("high"), F.min("mix_row").alias("first"), F.max("mix_row").alias("last"))
    upto = Window.partitionBy("mix_source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    return bins.withColumn("before", F.coalesce(F.sum("bin_size").over(upto), F.lit(0).cast("long")))


def narrowed(plan: DataFrame, bins: DataFrame) -> DataFrame:
    """``plan`` with the bin in which each budget runs out as its edge: the last one that begins below it."""
    found = bins.withColumnRenamed("mix_source", "of")
    found = plan.join(found, F.col("mix_source").eqNullSafe(F.col("of"))).withColumn("before", F.col("mix_before") + F.col("before"))
    found = found.filter(F.col("before") < F.col("mix_rest")).groupBy(F.col("mix_source").alias("of")).agg(F.max_by(F.struct(*_EDGE.values()), "bin").alias("edge"))
    new = {c: F.coalesce(F.col(f"edge.{x}"), F.col(c)).alias(c) for c, x in _EDGE.items()}
    joined = plan.join(found, F.col("mix_source").eqNullSafe(F.col("of")), "left")
    return joined.select(*[new.get(c, F.col(c)) for c in plan.columns])


def planned(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Every document's row beside the plan of its source."""
    plan = plan.withColumnRenamed("mix_source", "mix_plan")
    return sized.join(plan, F.col("mix_source").eqNullSafe(F.col("mix_plan"))).drop("mix_plan")


def repeated(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """The mixed corpus itself: every document of ``docs`` as often as the mix takes it."""
    mixed = _mixed(docs, docs.columns, weights, most).filter(F.col("mix_copies") > 0)
    return mixed.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select(*_kept(docs.columns))
