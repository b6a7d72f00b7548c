import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from haplometh.llm import blocks, jaccard
from haplometh.llm.components import connected


def shingle_set(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    words = ["".join(c.lower() if c.isascii() else c for c in w) for w in words]
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain(rows, size=4, percent=85):
    sets = [shingle_set(t, size) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    names = {}
    for i, (d, _) in enumerate(rows):
        names[root(i)] = min(names.get(root(i), d), d)
    return sorted((d, len(s), names[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def corpus(seed, groups=8, copies=12, edits=6):
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([1, 3, 4, 5, 8, 15, 40, 120, 300]))]
        for _ in range(rng.randint(1, copies)):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(words) + 1)
                words[at : at + rng.randint(0, 1)] = [f"w{rng.randint(0, 400)}"] * rng.randint(0, 1)
            texts.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in words))
    rng.shuffle(texts)
    return [*enumerate(texts, 10), (5, texts[0]), (900, ""), (901, None), (902, " \t")]


@pytest.mark.parametrize("seed", range(6))
def test_against_all_pairs(documents, rows, monkeypatch, seed):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(jaccard, "LEAF", 4)
    if seed % 2:
        monkeypatch.setattr(jaccard, "REGION_SHINGLES", 600)
    if seed % 3 == 1:
        monkeypatch.setattr(jaccard, "PARTED", 3)
    table = corpus(seed)
    size, percent = ((4, 85), (5, 80), (2, 60))[seed % 3]
    got = rows(jaccard.components(documents(*table).repartition(3), size, percent), "doc_id", "n_shingles", "component_id")
    assert got == plain(table, size, percent)


def test_similar_sets_agree_on_a_signature():
    rng = np.random.default_rng(2)
    for percent in (85, 80):
        for n in [*range(1, 60), 100, 333, 1000]:
            own = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            for _ in range(15):
                drop = int(rng.integers(0, n * (100 - percent) // 100 + 1))
                other = own[rng.permutation(len(own))[drop:]]
                while True:
                    more = np.union1d(other, rng.integers(0, 2**63, 1).astype(np.uint64))
                    common = len(np.intersect1d(own, more))
                    if 100 * common < percent * len(np.union1d(own, more)) or rng.random() < 0.05:
                        break
                    other = more
                if len(other) and 100 * len(np.intersect1d(own, other)) >= percent * len(np.union1d(own, other)):
                    assert np.intersect1d(jaccard.signatures(own, percent), jaccard.signatures(np.sort(other), percent)).size, (n, drop)


def test_similar_sets_are_in_one_part():
    rng = np.random.default_rng(7)
    for n in (3, 20, 200, 900):
        base = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for _ in range(5)]
        sets = [np.unique(np.concatenate((b[rng.random(len(b)) > 0.04], rng.integers(0, 2**63, n // 30).astype(np.uint64)))) for b in base for _ in range(6)]
        sizes = np.array([len(s) for s in sets])
        for percent in (80, 85):
            part = jaccard.parts_of([jaccard.sketch(s) for s in sets], sizes, percent)
            for i, j in ((i, j) for i in range(30) for j in range(i)):
                if 100 * len(np.intersect1d(sets[i], sets[j])) >= percent * len(np.union1d(sets[i], sets[j])):
                    assert part[i] == part[j]
            if n >= 200:
                assert len(set(part.tolist())) >= 5


@pytest.mark.parametrize("seed", range(8))
def test_region_finds_every_component(seed, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAF", 8)
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(6):
        base = rng.integers(0, 3000, rng.integers(20, 120))
        for _ in range(int(rng.integers(1, 60))):
            kept = base[rng.random(len(base)) > rng.choice([0.02, 0.06, 0.12])]
            sets.append(np.unique(np.concatenate((kept, rng.integers(0, 3000, rng.integers(0, 6))))).astype(np.uint64))
    links = jaccard.link_region(sets, 85)
    label = list(range(len(sets)))

    def root(x, parent):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in links:
        assert 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))
        label[root(i, label)] = root(j, label)
    want = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j])):
                want[root(i, want)] = root(j, want)
    groups = lambda parent: {frozenset(k for k in range(len(sets)) if root(k, parent) == r) for r in {root(k, parent) for k in range(len(sets))}}
    assert groups(label) == groups(want)


def test_components(spark, rows):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(50)] + [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)] + [(7, 7)]
    got = dict(rows(connected(spark.createDataFrame(pairs, "a long, b long"))))
    label = {}
    for a, b in pairs:
        label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(200):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {k: v for k, v in label.items() if any(k in p and p[0] != p[1] for p in pairs)}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_representatives(documents, clashing, rows):
    long = " ".join(f"x{i}" for i in range(60))
    near = long.replace("x59", "y")
    docs = clashing(documents((4, long), (2, near), (2, near), (None, long), (7, "other words here now then"), (8, None), (None, ""), (7, "quite another text of words")))
    kept = jaccard.representatives(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id", "text") == [(None, ""), (2, near), (7, "other words here now then"), (7, "quite another text of words"), (8, None)]
    assert jaccard.representatives(docs.limit(0)).count() == 0 and jaccard.components(docs.limit(0)).count() == 0
    only_null = docs.filter(F.col("doc_id").isNull())
    assert rows(jaccard.components(only_null), "n_shingles", "component_id") == [(0, None), (57, None)]


def test_unlike_short_sets_share_no_cell():
    rng = np.random.default_rng(3)
    for percent in (85, 80):
        seen = set()
        for n in [1, 1, 1, 2, 2, 3, 4, 5, 6, 7, 8] * 40:
            found = {int(x) for x in jaccard.signatures(np.unique(rng.integers(0, 2**63, n).astype(np.uint64)), percent)}
            assert found and not found & seen
            seen |= found


def test_sets_in_one_part_still_meet():
    rng = np.random.default_rng(4)
    for percent, n in ((85, 7), (85, 8), (80, 5), (80, 9), (60, 12)):
        for _ in range(40):
            own, apart = (np.unique(rng.integers(0, 2**40, n).astype(np.uint64)) for _ in range(2))  # all in the first part
            other = np.delete(own, rng.integers(0, n))
            assert np.intersect1d(jaccard.signatures(own, percent), jaccard.signatures(other, percent)).size
            assert not np.intersect1d(jaccard.signatures(own, percent), jaccard.signatures(apart, percent)).size


def test_sets_at_the_edge_of_the_size_ratio_meet():
    rng = np.random.default_rng(5)
    for percent, n, larger in ((70, 100, 142), (60, 100, 166), (50, 7, 14), (30, 40, 133), (80, 100, 125), (85, 85, 100)):
        for _ in range(20):
            whole = np.unique(rng.integers(0, 2**63, larger).astype(np.uint64))
            own = np.sort(rng.permutation(whole)[:n])
            assert np.intersect1d(jaccard.signatures(own, percent), jaccard.signatures(whole, percent)).size, (percent, n)


def test_a_contained_text_is_linked_at_70(documents, rows):
    words = [f"w{i}" for i in range(145)]
    table = [(1, " ".join(words)), (2, " ".join(words[:103])), (3, " ".join(words[:90]))]
    assert rows(jaccard.components(documents(*table), 4, 70), "doc_id", "n_shingles", "component_id") == plain(table, 4, 70)
    with pytest.raises(ValueError):
        jaccard.components(documents(*table), 4, 0)
