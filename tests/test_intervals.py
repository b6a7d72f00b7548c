import random

import pytest
from pyspark.sql import functions as F

from haplometh.operators import intervals

INTERVAL = "chrom string, start bigint, end bigint"


def sites(spark, *starts, chrom="chr1"):
    return spark.createDataFrame([(chrom, s, s + 1) for s in starts], INTERVAL)


def test_half_open_edges(spark, rows):
    blocks = spark.createDataFrame([("chr1", 0, 10), ("chr1", 10, 20), ("chr1", 11, 30)], INTERVAL)
    out = intervals.overlap_join(sites(spark, 10), blocks)
    assert rows(out) == [("chr1", 10, 11, 10, 20)]


def test_nested_blocks_give_two_rows_and_unphased_sites_stay(spark, rows):
    blocks = spark.createDataFrame([("chr1", 0, 100), ("chr1", 40, 60)], INTERVAL)
    out = intervals.overlap_join(sites(spark, 50, 500), blocks, "left", bin_size=16)
    assert rows(out) == [
        ("chr1", 50, 51, 0, 100),
        ("chr1", 50, 51, 40, 60),
        ("chr1", 500, 501, None, None),
    ]


@pytest.mark.parametrize("bin_size", [1, 7, 64, 1 << 17])
@pytest.mark.parametrize("width", [1, 2, 5])
def test_overlap_join_equals_naive_join(spark, rows, bin_size, width):
    rng = random.Random(bin_size * 31 + width)
    left = [(f"chr{rng.randint(1, 3)}", s, s + rng.randint(1, width)) for s in rng.choices(range(400), k=150)]
    right = [(f"chr{rng.randint(1, 3)}", s, s + rng.randint(1, 90)) for s in rng.choices(range(400), k=40)]
    left, right = set(left), set(right)
    expected = [(*a, *(b[1:])) for a in left for b in right if a[0] == b[0] and a[1] < b[2] and b[1] < a[2]]
    hit = {e[:3] for e in expected}
    ldf, rdf = spark.createDataFrame(list(left), INTERVAL), spark.createDataFrame(list(right), INTERVAL)
    kinds = {h: intervals.overlap_join(ldf, rdf, h, bin_size=bin_size, left_width=width) for h in ("inner", "left", "left_anti")}
    assert rows(kinds["inner"]) == sorted(expected)
    assert kinds["left"].count() == len(expected) + len(left - hit)
    assert rows(kinds["left_anti"]) == sorted(left - hit)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("width", [1, 4])
def test_adaptive_bins_equal_naive_join(spark, rows, seed, width):
    """Widths from one base to a chromosome, dense and empty stretches, bounds on cell borders."""
    rng = random.Random(seed * 7 + width)
    cell = 1 << intervals.CELL_BITS
    spots = [*range(300), *range(cell - 40, cell + 40), *range(5 * cell, 5 * cell + 60)]
    left = {(f"chr{rng.randint(1, 3)}", s, s + rng.randint(1, width)) for s in rng.choices(spots, k=250)}
    right = {(f"chr{rng.randint(1, 2)}", s, s + rng.randint(1, 40)) for s in rng.choices(spots, k=200)}
    right |= {("chr1", 0, 6 * cell), ("chr1", 7, cell), ("chr2", cell, 2 * cell), ("chr2", 50, 50)}
    expected = [(*a, *b[1:]) for a in left for b in right if a[0] == b[0] and b[1] < b[2] and a[1] < b[2] and b[1] < a[2]]
    hit = {e[:3] for e in expected}
    ldf, rdf = spark.createDataFrame(list(left), INTERVAL), spark.createDataFrame(list(right), INTERVAL)
    bins = intervals.adaptive_bins(rdf)
    kinds = {h: intervals.overlap_join(ldf, rdf, h, bin_size=bins, left_width=width) for h in ("inner", "left", "left_semi", "left_anti")}
    assert rows(kinds["inner"]) == sorted(expected)
    assert kinds["left"].count() == len(expected) + len(left - hit)
    assert rows(kinds["left_semi"]) == sorted(hit) and rows(kinds["left_anti"]) == sorted(left - hit)


def test_adaptive_bins_copy_long_blocks_little(spark):
    """A block as long as a chromosome around 10,000 small ones: at most three copies a block."""
    small = spark.range(10_000).select(F.lit("chr1").alias("chrom"), (F.col("id") * 20_000 + 500).alias("start"), (F.col("id") * 20_000 + 9_000).alias("end"))
    right = small.union(spark.createDataFrame([("chr1", 0, 200_000_000)], INTERVAL))
    bins = intervals.adaptive_bins(right)
    copies = intervals._binned_blocks(right, F.col("start"), F.col("end") - 1, bins)
    assert right.count() < copies.count() <= 3 * right.count()
    held = copies.groupBy("chrom", "__bin").count().agg(F.max("count")).first()[0]
    assert held <= 16
    sites = small.select("chrom", (F.col("start") + 3).alias("start"), (F.col("start") + 4).alias("end"))
    assert intervals.overlap_join(sites, right, "left", bin_size=bins).count() == 20_000


def test_adaptive_bins_of_cohorts_and_empty_tables(spark, rows):
    schema = "sample string, " + INTERVAL
    blocks = spark.createDataFrame([(s, "chr1", i * 10, i * 10 + 10) for s in "ab" for i in range(40)], schema)
    cpgs = spark.createDataFrame([("a", "chr1", 5, 6), ("c", "chr1", 5, 6)], schema)
    joined = intervals.overlap_join(cpgs, blocks, "left", by=("sample",), bin_size=intervals.adaptive_bins(blocks, by=("sample",)))
    assert rows(joined, "sample", "end_block") == [("a", 10), ("c", None)]
    none = blocks.limit(0)
    out = intervals.overlap_join(cpgs, none, "left", by=("sample",), bin_size=intervals.adaptive_bins(none, by=("sample",)))
    assert rows(out, "sample", "end_block") == [("a", None), ("c", None)]


def test_too_wide_interval_fails(spark):
    wide = spark.createDataFrame([("chr1", 5, 9)], INTERVAL)
    with pytest.raises(Exception, match="wider than 1"):
        intervals.overlap_join(wide, wide, "left").collect()


def test_hot_bin_is_split_by_adaptive_execution(spark):
    """A third of all sites in one bin: the shuffled join splits that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 90_000
        spread = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") * 37)
        left = spark.range(n, numPartitions=8).select(
            F.lit("chr1").alias("chrom"), spread.alias("start"), (spread + 1).alias("end"), F.xxhash64("id").alias("v")
        )
        right = spark.range(200).select(
            F.lit("chr1").alias("chrom"), (F.col("id") * 20_000).alias("start"), (F.col("id") * 20_000 + 15_000).alias("end")
        )
        out = intervals.overlap_join(left, right, "left", bin_size=1 << 14)
        assert len(out.collect()) == n
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_proximity_golden(spark, rows):
    marks = spark.createDataFrame([("chr1", 1000, 1001)], INTERVAL)
    near = sites(spark, 950, 949, 1000, 1050, 1051).union(sites(spark, 1000, chrom="chr2"))
    out = intervals.within_distance(near, marks, 50, "near")
    assert dict(rows(out.select(F.concat_ws(":", "chrom", "start"), "near"))) == {
        "chr1:950": True,
        "chr1:949": False,
        "chr1:1000": True,
        "chr1:1050": True,
        "chr1:1051": False,
        "chr2:1000": None,
    }


@pytest.mark.parametrize("seed", range(4))
def test_proximity_and_distance_equal_brute_force(spark, rows, seed):
    rng = random.Random(seed)
    cpgs = {(f"chr{rng.randint(1, 3)}", s) for s in rng.choices(range(3000), k=120)}
    marks = {(f"chr{rng.randint(1, 2)}", s, s + rng.choice([1, 1, 30])) for s in rng.choices(range(3000), k=12)}
    marks |= {("chr1", 0, 1)}

    def gap(c):
        gaps = [max(0, s - (c[1] + 1), c[1] - e) for k, s, e in marks if k == c[0]]
        return min(gaps) if gaps else None

    cdf = spark.createDataFrame([(c, s, s + 1) for c, s in cpgs], INTERVAL)
    # Copies of a site change nothing.
    mdf = spark.createDataFrame(list(marks) * 3, INTERVAL)
    flags = rows(intervals.within_distance(cdf, mdf, 50, "near"), "chrom", "start", "near")
    gaps = rows(intervals.nearest(cdf, mdf, bin_size=64), "chrom", "start", "distance")
    assert gaps == sorted((*c, gap(c)) for c in cpgs)
    assert flags == sorted((*c, None if gap(c) is None else gap(c) < 50) for c in cpgs)


def test_cohort_key_keeps_samples_apart(spark, rows):
    schema = "sample string, " + INTERVAL
    cpgs = spark.createDataFrame([("a", "chr1", 5, 6), ("b", "chr1", 5, 6)], schema)
    marks = spark.createDataFrame([("a", "chr1", 7, 8)], schema)
    out = intervals.within_distance(cpgs, marks, 50, "near", by=("sample",))
    assert rows(out, "sample", "near") == [("a", True), ("b", None)]
    blocks = spark.createDataFrame([("b", "chr1", 0, 9)], schema)
    joined = intervals.overlap_join(cpgs, blocks, "left", by=("sample",))
    assert rows(joined, "sample", "start_block") == [("a", None), ("b", 0)]


def test_region(spark, rows):
    kept = intervals.region_filter(sites(spark, 98, 99, 150, 199, 200), "chr1:100-200")
    assert rows(kept, "start") == [(99,), (150,), (199,)]
    assert intervals.region_filter(sites(spark, 1), "chr1").count() == 1


def exchanges_of(df, column):
    """Exchanges in the plan that move a column."""

    def walk(node):
        names = [node.output().apply(i).name() for i in range(node.output().size())]
        own = node.nodeName() == "Exchange" and column in names
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_rows_dealt_by_bin_are_joined_where_they_lie(spark, rows, tmp_path):
    """Two joins, blocks of mixed widths: the sites move once, and the result is that of plain joins."""
    sites = spark.range(3000).selectExpr("concat('chr', 1 + id % 2) AS chrom", "id * 977 AS start", "id * 977 + 1 AS end", "id AS level")
    small = spark.range(900).selectExpr("concat('chr', 1 + id % 2) AS chrom", "id * 3000 AS start", "id * 3000 + 5000 AS end", "id AS block")
    long = spark.range(1).selectExpr("'chr1' AS chrom", "10L AS start", "2900000L AS end", "-1L AS block")
    for df, name in ((sites, "sites"), (small.union(long), "blocks")):
        df.write.parquet(str(tmp_path / name))
    sites, blocks = (spark.read.parquet(str(tmp_path / name)) for name in ("sites", "blocks"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "100000"}
    for bins in (1 << 14, intervals.adaptive_bins(blocks)):
        dealt = plain = sites
        before = {k: spark.conf.get(k, None) for k in settings}
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            dealt = intervals.dealt_by_bin(dealt, bins)
            for n in range(2):
                other = blocks.withColumnRenamed("block", f"b{n}").hint("merge")
                dealt = intervals.overlap_join(dealt, other, "left", suffix=f"_{n}", bin_size=bins, dealt=True)
                plain = intervals.overlap_join(plain, other, "left", suffix=f"_{n}", bin_size=bins)
            assert exchanges_of(dealt, "level") == 1 < exchanges_of(plain, "level")
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        assert rows(dealt.drop("__bin")) == rows(plain) and dealt.count() > 3000
