import random
import re
from collections import Counter

import numpy as np
import pytest

from haplometh.llm import blocks, substrings


def plain(texts):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    size = substrings.SIZE
    seen = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_cover():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(substrings.PERIOD))


def corpus(seed):
    rng = random.Random(seed)
    passages = [[f"p{rng.randint(0, 50)}" for _ in range(rng.choice([20, 34, 35, 36, 50, 90]))] for _ in range(6)]
    texts = []
    for _ in range(60):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(passages)
        texts.append("".join(w + rng.choice([" ", "\n", "\t ", "\x0b"]) for w in words))
    return [*texts, texts[0], texts[1] + "X", None, "", "a " * 34, "b " * 35, "c " * 36, "d " * 100]


@pytest.mark.parametrize("seed", range(3))
def test_against_all_windows(documents, rows, monkeypatch, seed):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2000)
    texts = corpus(seed)
    got = rows(substrings.deduplicate(documents(*enumerate(texts)).repartition(3)), "doc_id", "n_words", "n_removed", "kept_text")
    assert got == [(i, *x) for i, x in enumerate(plain(texts))]


def test_edges(documents, clashing, rows):
    long = " ".join(f"x{i}" for i in range(40))
    docs = clashing(documents((None, long), (1, long), (1, long), (2, None), (3, "é " + long + "\xa0")))
    got = rows(substrings.deduplicate(docs), "doc_id", "n_words", "n_removed", "kept_text")
    assert got == [(None, 40, 40, ""), (1, 40, 40, ""), (1, 40, 40, ""), (2, 0, 0, ""), (3, 41, 39, "é x39\xa0")]
    assert substrings.deduplicate(docs.limit(0)).count() == 0


def test_exchange_bits():
    values = np.array([5, 9, 5, 2**63, 2**64 - 1, 9, 7], np.uint64)
    parts = {r: (np.frombuffer(h, np.uint64), twice) for r, h, twice in blocks.sent(values, 4)}
    assert sorted(v for h, _ in parts.values() for v in h) == sorted(set(values.tolist()))
    again = blocks.answered(values, 4, {r: twice for r, (_, twice) in parts.items()})
    assert again.tolist() == [True, True, True, False, False, True, False]
