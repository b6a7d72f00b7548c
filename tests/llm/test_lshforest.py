"""The LSH forest against all pairs."""

import random

import numpy as np
import pytest

from haplometh.llm import lshforest


def shingle_set(text, size):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size, 0) + 1)} if words else set()


def brute(rows, size=4, percent=80):
    sets = [shingle_set(r[1], size) for r in rows]
    name = list(range(len(rows)))

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                name[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None and (root(i) not in least or r[0] < least[root(i)]):
            least[root(i)] = r[0]
    out = []
    for i, r in enumerate(rows):
        component = least.get(root(i)) if sets[i] else r[0]
        out.append((r[0], len(sets[i]), component, r[0] == component))
    return sorted(out, key=repr)


def found(df, **kind):
    return sorted(map(tuple, lshforest.components(df, **kind).collect()), key=repr)


def corpus(seed=3, originals=40):
    rng = random.Random(seed)
    rows = []
    for _ in range(originals):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(3, 150))]
        for _ in range(rng.choice((1, 1, 2, 6))):
            copy = list(words)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = f"v{rng.randrange(400)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


EDGES = [(900, None), (901, ""), (902, " \t\n"), (903, "A b"), (904, "a B"), (None, "a b"), (None, "alone here"), (905, "same row of five words"), (905, "same row of five words"), (None, None)]


@pytest.mark.parametrize("limits", [(4096, 3, 5), (3, 1, 2), (2, 1, 1)])
def test_components(spark, documents, monkeypatch, limits):
    """Also where regions are divided, or too large at any depth and taken whole."""
    for name, value in zip(("WIDE", "LEAST", "DEEP"), limits, strict=True):
        monkeypatch.setattr(lshforest, name, value)
    monkeypatch.setattr(lshforest, "_FACTORS", lshforest._FACTORS[: lshforest.TREES * limits[2]])
    monkeypatch.setattr(lshforest, "MARGIN", 6 * (0.16 / (lshforest.TREES * limits[2])) ** 0.5)
    rows = corpus() + EDGES
    assert found(documents(*rows).repartition(3)) == brute(rows)


def test_other_sizes_and_thresholds(spark, documents):
    rows = corpus(8, 25)
    assert found(documents(*rows), size=5, percent=80) == brute(rows, 5, 80)
    assert found(documents(*rows), size=2, percent=90) == brute(rows, 2, 90)


def test_estimates_and_common_prefixes():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(1, 1 << 63, 500, np.uint64))
    near, far = np.unique(np.append(base[50:], rng.integers(1, 1 << 63, 50, np.uint64))), np.unique(rng.integers(1, 1 << 63, 500, np.uint64))
    rows = lshforest.signatures([base, near, far, base])
    share = (rows == rows[0]).mean(axis=1)
    assert share[3] == 1 and abs(share[1] - 450 / 550) < lshforest.MARGIN and share[2] < 0.05
    assert lshforest.near_parts((rows & 255).astype(np.uint8), 80) == [(0, 1), (0, 3)]


def test_long_text_clashing_columns_and_empty_table(documents, clashing):
    words = [f"x{i * i % 70_001}" for i in range(60_000)]
    other = words[:1000] + ["changed"] + words[1001:]
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, "x1 x2"), (4, "X1  x2\n")]
    assert found(clashing(documents(*rows))) == brute(rows)
    assert found(documents(*rows).limit(0)) == []


def test_many_copies_of_one_text(documents):
    """A third of all rows copies, another third near copies of one text."""
    base = [f"b{i}" for i in range(80)]
    rows = [(i, " ".join(base)) for i in range(200)]
    rows += [(200 + i, " ".join([*base[: i % 70], f"n{i}", *base[i % 70 + 1 :]])) for i in range(200)]
    rows += [(400 + i, f"other text number {i} with words of its own {i * 7}") for i in range(200)]
    assert found(documents(*rows).repartition(7)) == brute(rows)
