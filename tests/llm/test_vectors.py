import numpy as np
import pytest
from pyspark.sql import functions as F

from haplometh.llm import blockjoin, grid, vafile

SCHEMA = "vec_id long, embedding array<float>, size int, ids string, score string"


@pytest.fixture
def vectors(spark):
    def build(rows):
        return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA)

    return build


def best(table, is_query, score, k):
    out = []
    for q in sorted({i for i, _ in table if is_query(i)}):
        mine = min(v for i, v in table if i == q)
        scored = sorted((-score(mine, v), i) for i, v in table if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return out


def integer(a, b):
    return sum(int(np.floor(256 * float(x))) * int(np.floor(256 * float(y))) for x, y in zip(a, b, strict=False))


def product(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=False):
        total += float(x) * float(y)
    return total


def random_table(n, width, seed, repeat=0):
    rng = np.random.default_rng(seed)
    table = [(i, [float(x) for x in rng.normal(size=width).astype(np.float32)]) for i in range(n)]
    return table + [(n + i, table[3][1]) for i in range(repeat)]


@pytest.mark.parametrize(("n", "width", "repeat"), [(300, 8, 0), (150, 3, 120), (4, 2, 0), (1, 2, 0)])
def test_exact_search(vectors, rows, n, width, repeat):
    table = random_table(n, width, n, repeat)
    got = rows(vafile.search(vectors(table), F.col("vec_id") % 10 == 0, 5))
    assert got == best(table, lambda i: i % 10 == 0, integer, 5)


@pytest.mark.parametrize(("n", "width", "repeat"), [(300, 8, 0), (150, 3, 120), (4, 2, 0), (1, 2, 0)])
def test_block_join(vectors, rows, n, width, repeat):
    table = random_table(n, width, n + 1, repeat)
    got = rows(blockjoin.search(vectors(table), F.col("vec_id") % 10 == 0, 20))
    assert got == best(table, lambda i: i % 10 == 0, product, 20)


def test_several_blocks(vectors, rows, monkeypatch):
    monkeypatch.setattr(grid, "BLOCK_ROWS", 16)
    table = random_table(200, 4, 5, 30)
    small = vectors(table).repartition(3)
    packed = grid.pack(grid.usable(small), vafile.encode, ["exact"], 16)
    assert max(r["size"] for r in packed.collect()) <= 16 and packed.count() > 10
    got = rows(vafile.search(small, F.col("vec_id") % 3 == 0, 5))
    assert got == best(table, lambda i: i % 3 == 0, integer, 5)
    got = rows(blockjoin.search(small, F.col("vec_id") % 3 == 0, 7))
    assert got == best(table, lambda i: i % 3 == 0, product, 7)


def test_what_takes_no_part(vectors, rows):
    table = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, [0.0, 0.0]), (6, [1.0]), (7, [])]
    assert rows(vafile.search(vectors(table), F.col("vec_id") >= 0, 5)) == [(0, 1, 6, 65536), (0, 2, 5, 0), (0, 3, 7, 0), (5, 1, 0, 0), (5, 2, 6, 0), (5, 3, 7, 0), (6, 1, 0, 65536), (6, 2, 5, 0), (6, 3, 7, 0), (7, 1, 0, 0), (7, 2, 5, 0), (7, 3, 6, 0)]
    assert rows(blockjoin.search(vectors(table), F.col("vec_id") >= 0, 5)) == [(0, 1, 6, 1.0), (6, 1, 0, 1.0)]
    assert vafile.search(vectors([]), F.col("vec_id") >= 0, 5).count() == 0
    assert blockjoin.search(vectors([(1, None)]), F.col("vec_id") >= 0, 5).count() == 0


def test_repeated_ids(vectors, rows):
    table = [(0, [1.0]), (0, [2.0]), (1, [1.0]), (1, [1.0])]
    assert rows(vafile.search(vectors(table), F.col("vec_id") == 0, 5)) == [(0, 1, 1, 65536), (0, 2, 1, 65536)]


def test_large_numbers(vectors, rows):
    table = [(0, [3.0e30, 1.0]), (1, [1.0, 5.0]), (2, [-1.0e30, 2.0]), (3, [1e-40, 1.0])]
    got = rows(vafile.search(vectors(table), F.col("vec_id") == 1, 3))
    assert [r[2] for r in got] == [0, 3, 2] and got[0][3] == 2**63 - 1 and got[2][3] == -(2**63)
    assert [r[2] for r in rows(blockjoin.search(vectors(table), F.col("vec_id") == 1, 3))] == [0, 3, 2]


def test_very_large_components(spark, rows):
    """Products beyond the range of doubles are infinite and lose no pair."""
    table = [(0, [1e200, 1.0]), (1, [1.0, 2.0]), (2, [3.0, 1.0]), (3, [2.0, 2.0]), (4, [-1e200, 3.0]), (5, [1e-200, 1e-300]), (6, [1e308, 1e300])]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    for k in (2, 5):
        got = rows(blockjoin.search(df, F.col("vec_id") >= 0, k))
        assert got == best(table, lambda i: True, product, k)


@pytest.mark.parametrize("search", [vafile.search, blockjoin.search])
def test_clashing_columns_and_empty_table(spark, vectors, rows, search):
    table = random_table(60, 4, 9)
    df = vectors(table)
    extra = df
    for name in "vector q_ids c_ids block slot query_id rank exact small norm cells".split():
        extra = extra.withColumn(name, F.lit("x"))
    assert rows(search(extra, F.col("vec_id") % 7 == 0, 3)) == rows(search(df, F.col("vec_id") % 7 == 0, 3))
    assert search(df.limit(0), F.col("vec_id") % 7 == 0, 3).count() == 0
