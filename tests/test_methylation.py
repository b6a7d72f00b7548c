import pytest
from pyspark.sql import functions as F

from haplometh.operators import joins, methylation

LEVELS = "chrom string, start bigint, end bigint, total_read_count bigint, methylation_level double"
MAP = (
    "chrom string, start bigint, end bigint, paternal_haplotype string, maternal_haplotype string, "
    "haplotype_concordance double, num_het_SNVs bigint"
)


def levels(spark, *cells):
    return spark.createDataFrame([("chr1", s, s + 1, n, v) for s, n, v in cells], LEVELS)


@pytest.fixture
def files(spark):
    """Agreeing, one-sided, missing and clashing sites, inside and outside blocks."""
    return {
        ("count", "hap1"): levels(spark, (10, 5, 0.1), (20, 6, 0.2), (30, 7, 0.3), (500, 8, 0.4), (60, 3, 0.9)),
        ("count", "hap2"): levels(spark, (10, 4, 0.5), (40, 9, 0.6), (500, 8, 0.4)),
        ("model", "hap1"): levels(spark, (10, 5, 0.15), (20, 7, 0.25), (500, 9, 0.45), (50, 2, 0.8)),
        ("model", "hap2"): levels(spark, (10, 4, 0.55), (40, 9, 0.65), (510, 1, 0.7), (60, 3, 0.2)),
    }


@pytest.fixture
def hap_map(spark):
    return spark.createDataFrame(
        [("chr1", 0, 45, "A_hap1", "E_hap2", 1.0, 4), ("chr1", 5, 25, "B_hap2", "F_hap1", 0.9, 3), ("chr1", 48, 99, "C_hap2", "G_hap1", 0.8, 2)],
        MAP,
    )


def test_site_on_one_haplotype_only(spark, rows, files):
    out = methylation.join_haplotypes(files["count", "hap1"], files["count", "hap2"])
    assert ("chr1", 20, 21, 6, 0.2, None, None) in rows(out)
    assert ("chr1", 40, 41, None, None, 9, 0.6) in rows(out)


def test_orientation_swaps_columns(spark, rows, files, hap_map):
    joined = methylation.join_haplotypes(files["count", "hap1"], files["count", "hap2"])
    out = methylation.phase_to_founders(joined, hap_map)
    picked = rows(
        out, "start", "founder_haplotype_pat", "methylation_level_pat", "methylation_level_mat", "total_read_count_pat"
    )
    assert (10, "A", 0.1, 0.5, 5) in picked
    assert (10, "B", 0.5, 0.1, 4) in picked
    assert (500, None, None, None, None) in picked


def test_one_pass_phasing_equals_the_stepwise_one(spark, rows, files, hap_map):
    stepwise = methylation.combine_modes(
        *[
            methylation.phase_to_founders(
                methylation.join_haplotypes(files[mode, "hap1"], files[mode, "hap2"]), hap_map
            )
            for mode in methylation.MODES
        ]
    )
    one_pass = methylation.founder_phased_methylation(files, hap_map)
    assert one_pass.columns == stepwise.columns
    assert rows(one_pass) == rows(stepwise)
    # 20 clashes in both of its blocks; 500 clashes outside any block and stays one all-null row.
    starts = [r[0] for r in rows(one_pass, "start")]
    assert starts.count(20) == 4 and starts.count(500) == 1 and starts.count(10) == 2


def test_null_keys_match(spark, rows):
    schema = "k string, b bigint, %s double"
    left = spark.createDataFrame([("x", None, 1.0), ("y", 2, 2.0)], schema % "l")
    right = spark.createDataFrame([("x", None, 3.0), ("y", None, 4.0)], schema % "r")
    expected = [("x", None, 1.0, 3.0), ("y", None, None, 4.0), ("y", 2, 2.0, None)]
    for hot in (False, True):
        out = joins.full_outer(left, right, ["k", "b"], null_safe=True, hot_keys=hot)
        assert rows(out) == expected


def test_full_outer_hot_keys_is_the_same_join(spark, rows):
    left = levels(spark, (1, 1, 0.1), (1, 2, 0.2), (2, 1, 0.3))
    right = levels(spark, (1, 5, 0.5), (3, 6, 0.6)).withColumnsRenamed(
        {"total_read_count": "n", "methylation_level": "v"}
    )
    assert rows(joins.full_outer(left, right)) == rows(joins.full_outer(left, right, hot_keys=True))


def test_repeated_site_is_refused_by_alignment(spark):
    tables = {"a": levels(spark, (1, 1, 0.1), (1, 2, 0.2)), "b": levels(spark, (1, 1, 0.1))}
    values = {"a": {"methylation_level": "x"}, "b": {"methylation_level": "y"}}
    with pytest.raises(Exception, match="more than once"):
        joins.align_sites(tables, values).collect()


def members_joined(files):
    members = []
    for member in methylation.MEMBERS:
        haps = {m: methylation.join_haplotypes(files[member, m, "hap1"], files[member, m, "hap2"]) for m in methylation.MODES}
        combined = methylation.combine_modes_of_member(haps["count"], haps["model"])
        members.append(methylation.name_member_haplotypes(combined, member))
    return methylation.join_members(members)


def test_trio_alignment_equals_pairwise_joins(spark, rows):
    files = {}
    for n, member in enumerate(methylation.MEMBERS):
        for mode in methylation.MODES:
            for h, hap in enumerate(("hap1", "hap2")):
                cells = [(s, s + n, (s % 7) / 10 + h) for s in range(1, 40) if (s * (n + 2) + h + len(mode)) % 3]
                files[member, mode, hap] = levels(spark, *cells)
    pairwise = members_joined(files)
    aligned = methylation.trio_methylation(files)
    assert rows(aligned, *pairwise.columns) == rows(pairwise)
    # sites that files repeat multiply, as in the joins
    again = dict(files)
    again["kid", "count", "hap1"] = files["kid", "count", "hap1"].union(files["kid", "count", "hap1"].filter("start < 9"))
    again["mom", "model", "hap2"] = files["mom", "model", "hap2"].union(levels(spark, (5, 1, 0.3), (38, 2, 0.4)))
    assert rows(methylation.trio_methylation(again), *pairwise.columns) == rows(members_joined(again), *pairwise.columns)
    assert methylation.trio_methylation(again).count() > aligned.count()


def test_unphased_trio_columns_become_null(spark, rows):
    names = [c for m in methylation.MEMBERS for c in methylation.trio_columns(m)]
    row = ("chr1", 10, 11, *[1 if c.startswith("total") else 0.5 for c in names])
    types = [f"{c} {'bigint' if c.startswith('total') else 'double'}" for c in names]
    trio = spark.createDataFrame([row], "chrom string, start bigint, end bigint, " + ", ".join(types))
    block = "chrom string, start bigint, end bigint, %s string, haplotype_concordance double, num_het_SNVs_in_parent bigint"
    pat = spark.createDataFrame([("chr1", 0, 50, "B", 1.0, 3)], block % "paternal_haplotype")
    mat = spark.createDataFrame([("chr2", 0, 50, "C", 1.0, 3)], block % "maternal_haplotype")
    out = methylation.phase_to_parents(trio, pat, mat).first().asDict()
    assert out["methylation_level_kid_pat_count"] == out["methylation_level_dad_B_model"] == 0.5
    assert out["methylation_level_kid_mat_count"] is None and out["total_read_count_mom_D"] is None
    assert (out["paternal_haplotype"], out["num_het_SNVs_in_dad"], out["maternal_haplotype"]) == ("B", 3, None)


def test_files_that_repeat_sites(spark, rows, files, hap_map):
    """Copies multiply, as in a join, and the sites that no file repeats are as before."""
    unique = methylation.founder_phased_methylation(files, hap_map)
    doubled = files | {("count", "hap1"): files["count", "hap1"].union(files["count", "hap1"].filter("start = 10"))}
    out = methylation.founder_phased_methylation(doubled, hap_map)
    assert rows(out) == rows(stepwise(doubled, hap_map)) and out.count() > unique.count()
    assert rows(out.filter("start != 10")) == rows(unique.filter("start != 10"))


def stepwise(files, hap_map):
    modes = [
        methylation.phase_to_founders(methylation.join_haplotypes(files[m, "hap1"], files[m, "hap2"]), hap_map)
        for m in methylation.MODES
    ]
    return methylation.combine_modes(*modes)


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("hot", ["left", "right", "both", "alone"])
def test_heavy_keys_are_split(spark, rows, monkeypatch, hot, null_safe):
    """The rows of the plain join, whichever side holds the heavy keys; null keys match only where asked."""
    monkeypatch.setattr(joins, "CELL_ROWS", 20)
    many = [("h", i, 1) for i in range(70)] + [(None, i, 2) for i in range(40)]
    few = [("h", 900, 3), ("h", 901, 4), (None, 902, 5)]
    others = [(f"k{i}", i, 6) for i in range(30)]
    sides = {"left": (many + others, few + others[5:]), "right": (few + others, many + others[5:]), "both": (many + others, many[:45] + others[5:]), "alone": (many, others)}[hot]
    left, right = (spark.createDataFrame(side, f"k string, {c} bigint, n bigint").repartition(3) for side, c in zip(sides, "lr"))
    on = ["k", "n"] if hot == "both" else ["k"]
    if on == ["k"]:
        right = right.withColumnRenamed("n", "m")
    assert joins.heavy_keys(left, right, on) is not None
    expected = joins.full_outer(left, right, on, null_safe=null_safe)
    split = joins.full_outer(left, right, on, null_safe=null_safe, hot_keys=True)
    assert split.columns == expected.columns and rows(split) == rows(expected)


def test_a_third_of_the_right_rows_at_one_site(spark, monkeypatch):
    """No task of the join takes much more than the others do."""
    monkeypatch.setattr(joins, "CELL_ROWS", 500)
    right = spark.range(30_000).selectExpr("'chr1' AS chrom", "if(id % 3 = 0, 7L, id) AS start", "start + 1 AS end", "id AS r")
    left = spark.range(30_000).selectExpr("'chr1' AS chrom", "id AS start", "id + 1 AS end", "id AS l")
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # tasks as planned, neither coalesced nor split
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        heavy = joins.heavy_keys(left, right, joins.SITE)
        assert [tuple(r)[1:] for r in heavy.collect()] == [(1, 21)]
        joined = joins.full_outer(left, right, hot_keys=True)
        assert joined.count() == joins.full_outer(left, right).count()
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("task")).count().collect())
        plain = sorted(r["count"] for r in joins.full_outer(left, right).groupBy(F.spark_partition_id().alias("task")).count().collect())
        cells = [s for s in sizes if s >= 500]
        assert max(sizes) < 2 * cells[len(cells) // 2 - 1] and max(plain) > max(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_heavy_keys_is_the_plain_join(spark):
    left = levels(spark, (1, 1, 0.1), (2, 2, 0.2))
    assert joins.heavy_keys(left, left, joins.SITE) is None
    assert joins.heavy_keys(left.limit(0), left.limit(0), joins.SITE) is None
