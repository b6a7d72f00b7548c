"""The manifest against trees built by hand."""

from hashlib import sha256
from zlib import crc32

import pytest

from haplometh.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def row_digest(doc_id, text, lang, source, n_chars):
    fields = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h(*["-" if f is None else f"{len(f.encode())}:{f}" for f in fields])


def climb(row):
    """Levels of a tree, and for every leaf its siblings with their side."""
    levels = [row]
    while len(row) > 1:
        row = [h(*row[i : i + 2]) for i in range(0, len(row), 2)]
        levels.append(row)
    return levels


def siblings(levels, i):
    out = []
    for row in levels[:-1]:
        out.append((row[i ^ 1], i & 1) if i ^ 1 < len(row) else None)
        i //= 2
    return out


def brute(rows):
    trees = {}
    for r in sorted(rows, key=lambda r: (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, row_digest(*r))):
        trees.setdefault(r[2], []).append(r)
    built = {lang: climb([row_digest(*r) for r in own]) for lang, own in trees.items()}
    top = climb([levels[-1][0] for levels in built.values()])
    out = []
    for t, (lang, own) in enumerate(trees.items()):
        for i, r in enumerate(own):
            steps = siblings(built[lang], i) + siblings(top, t)
            changed = r[0] is not None and r[4] is not None and crc32(str(r[0]).encode()) % 7 == 0
            end = row_digest(*r[:4], r[4] + 1) if changed else row_digest(*r)
            for s in steps:
                end = h(end) if s is None else h(s[0], end) if s[1] else h(end, s[0])
            proof = h(*[s[0] for s in steps if s])
            out.append((r[0], row_digest(*r), built[lang][-1][0], top[-1][0], proof, end, end == top[-1][0]))
    return sorted(out, key=repr)


def audited(df):
    from pyspark.sql import functions as F

    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1)
    got = merkle.audit(merkle.manifest(df, tampered))
    return sorted(map(tuple, got.collect()), key=repr)


def rows_of(*rows):
    return [(*r, *(None,) * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]


CASES = {
    "one": [(1, "a", "en", "s")],
    "one a language": [(1, "a", "en", "s"), (2, "b", "de", "s"), (3, "c", None, None)],
    "nulls and copies": [(None, None), (None, "x"), (5, ""), (5, None), (5, ""), (5, ""), (0, "été", "fr", "q|r:"), (7, "b", "fr", None)],
    "odd sizes": [(i, "w" * (i % 9), ("a", "b", None, "é")[i % 7 % 4], "s") for i in range(37)],
    "a hot language": [(i, str(i), "en" if i % 10 else f"l{i}", None) for i in range(230)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("run_levels", [2, 10])
def test_manifest(spark, documents, monkeypatch, name, run_levels):
    monkeypatch.setattr(merkle, "RUN_LEVELS", run_levels)
    monkeypatch.setattr(merkle, "RUN", 1 << run_levels)
    assert audited(documents(*CASES[name]).repartition(3)) == brute(rows_of(*CASES[name]))


def test_order_of_rows_and_other_columns_do_not_matter(documents, clashing):
    rows = CASES["nulls and copies"]
    assert audited(documents(*rows)) == audited(clashing(documents(*rows[::-1])))


def test_long_text_and_empty_table(documents):
    rows = [(1, "lorem " * 300_000, "en", "s"), (2, "b", "en", "s")]
    assert audited(documents(*rows)) == brute(rows_of(*rows))
    assert audited(documents(*rows).limit(0)) == []
