"""Ranked search against scores of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from haplometh.llm import maxscore

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute(docs, items, k=10):
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counts = [(d, c) for d, c in counts if c]
    n, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c in counts:
            m = 25 + (75 * sum(c.values()) * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=repr)


def searched(spark, documents, docs, items, k=10, parts=3):
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = maxscore.search(maxscore.index(documents(*docs).repartition(parts)), asked, k)
    return sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(n, seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "É1", "naïve", "Zz"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 80)))) for i in range(n)]


ITEMS = [(1, "w0 w1 w1 the"), (2, "w50 w59, NAÏVE zz"), (3, "w0 " * 30 + "w33"), (4, " ".join(f"w{i}" for i in range(60))), (5, "absent"), (6, None), (7, ""), (7, "w3")]


def test_terms_are_maximal_runs_in_lower_case():
    texts = ["Ab-c_9 É ß[x]", "", "\x7f{|}~", "x" * 3_000_000 + " y"]
    joined, start, end, owner = maxscore.terms_of([t.encode() for t in texts])
    assert [(joined[a:b].decode(), o) for a, b, o in zip(start, end, owner)] == [(t, i) for i, text in enumerate(texts) for t in terms(text)]


def test_postings_round_trip_with_exact_block_maxima():
    docs = [t.encode() for _, t in corpus(700)] + [b"w0 " * 70_000, b""]
    lengths, rows = maxscore.postings(docs)
    counts = [Counter(terms(d.decode())) for d in docs]
    assert list(lengths) == [sum(c.values()) for c in counts]
    told = maxscore.Statistics(len(docs) - 1, int(lengths.sum()))
    norm = told.norm(lengths)
    assert {r["term"] for r in rows.to_pylist()} == {t for c in counts for t in c}
    for r in rows.to_pylist():
        own = maxscore.List.of(3, r["heads"], r["peaks"], r["data"], norm, told)
        held = [(i, c[r["term"]]) for i, c in enumerate(counts) if r["term"] in c]
        assert r["df"] == len(held) and len(own.heads) == -(-len(held) // maxscore.BLOCK)
        doc, score = own.blocks(np.arange(len(own.heads)))
        gains = [3 * (1_000_000_000 * tf // (1000 * tf + 8 * int(norm[i]))) for i, tf in held]
        assert list(doc) == [i for i, _ in held] and list(score) == gains
        assert [int(b) for b in own.bounds] == [max(gains[i : i + maxscore.BLOCK]) for i in range(0, len(gains), maxscore.BLOCK)]


def test_blocks_below_the_threshold_stay_packed():
    docs = [b"common " + (b"rare " * 40 if i == 900 else b"filler " * (i % 7)) for i in range(2000)]
    lengths, rows = maxscore.postings(docs)
    told = maxscore.Statistics(len(docs), int(lengths.sum()))
    lists = {r["term"]: maxscore.List.of(w, r["heads"], r["peaks"], r["data"], told.norm(lengths), told) for r in rows.to_pylist() for w in [7000 if r["term"] == "rare" else 1]}
    best = int(lists["rare"].bounds.max())
    found, _ = maxscore.best_of_shard([(lists["common"], 1), (lists["rare"], 1)], len(docs), best)
    assert list(found) == [900] and len(lists["common"].opened) == 1 and len(lists["common"].heads) > 10


@pytest.mark.parametrize("limits", [(1 << 30, 1 << 16, 128), (2000, 20, 4)])
def test_search(spark, documents, monkeypatch, limits):
    for name, value in zip(("SHARD_BYTES", "SHARD_DOCS", "BLOCK"), limits, strict=True):
        monkeypatch.setattr(maxscore, name, value)
    monkeypatch.setattr(maxscore, "QUERIES", 3)
    docs = corpus(400) + [(1000 + i, "w5 w6 w7 w8") for i in range(40)] + [(None, "w5 w6 w7 w8"), (1003, "w5 w6 w7 w8"), (2000, None), (2001, ""), (2002, "-- !!")]
    assert searched(spark, documents, docs, ITEMS, parts=5) == brute(docs, ITEMS)
    assert searched(spark, documents, docs, ITEMS, k=3, parts=2) == brute(docs, ITEMS, 3)


def test_long_text_clashing_columns_and_empty_tables(spark, documents, clashing):
    docs = [(1, "w0 " * 200_000 + "w33"), (2, "w0"), (3, "w33 w0")]
    asked = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = maxscore.search(maxscore.index(clashing(documents(*docs))), clashing(asked))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, ITEMS)
    assert maxscore.search(maxscore.index(documents(*docs).limit(0)), asked).count() == 0
    assert maxscore.search(maxscore.index(documents(*docs)), asked.limit(0)).count() == 0
