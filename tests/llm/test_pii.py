import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from haplometh.llm import pii

#: The base patterns as they stand in the contract.
PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            found.append((kind, *m.span()))
    return found


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1.@+- ()259é0", max_size=40))
def test_base_is_the_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_base_on_known_texts():
    texts = ["x a.b@c.de, 1.2.3.4 256.1.1.1 x 4111 1111 1111 1111 +1 (743) 555-3824", "007.08.1.255.3", "a@b@c.d", "@x.y", "1" * 5000 + "." + "2" * 50]
    assert all(pii.base_spans(t) == plain(t) for t in texts)
    assert [k for k, *_ in pii.base_spans(texts[0])] == [0, 1, 2, 3]


@pytest.fixture(scope="module")
def finder(spark):
    return pii.fit(pii.labelled_table(spark))


def test_added_spans(finder):
    texts = ["call (555) 123-4567 now", "my tel 555-123-4567, ok", "host 2001:db8::1 is up", "pay 4111.1111.1111.1111 today", "version 2.0. of 2024-01-05 at 10:30", "+1 (743) 555-3824", "no digits here", ""]
    base = [pii.base_spans(t) for t in texts]
    found = pii.added_spans(texts, finder, base)
    assert [[t[a:b] for _, a, b in f] for t, f in zip(texts, found, strict=True)] == [["(555) 123-4567"], ["555-123-4567"], ["2001:db8::1"], ["4111.1111.1111.1111"], [], [], [], []]


def test_training_accuracy(spark, finder):
    from haplometh.llm.crf import emissions, viterbi

    right = total = 0
    for _, words, labels in pii.labelled_table(spark, copies=5).collect()[::7]:
        for run in pii.runs_of(words):
            group = finder.group([[pii.features(words, k) for k in run]])
            got = viterbi(emissions(group, finder.model.weight), finder.model)[0]
            right += sum(pii.LABELS[g] == labels[k] for g, k in zip(got, run, strict=True))
            total += len(run)
    assert right / total > 0.97


def test_viterbi_against_all_paths():
    from itertools import product

    import numpy as np

    from haplometh.llm.crf import Model, marginals, viterbi

    rng = np.random.default_rng(1)
    e, model = rng.normal(size=(3, 4, 3)), Model(None, rng.normal(size=(3, 3)), rng.normal(size=3))
    for row in range(3):
        score = {p: model.start[p[0]] + sum(e[row, t, p[t]] for t in range(4)) + sum(model.transition[a, b] for a, b in zip(p, p[1:], strict=False)) for p in product(range(3), repeat=4)}
        assert tuple(viterbi(e, model)[row]) == max(score, key=score.get)
        weight = np.exp(list(score.values()))
        node, _, total = marginals(e, model)
        assert np.isclose(total[row], np.log(weight.sum()))
        assert np.isclose(node[row, 2, 1], sum(w for p, w in zip(score, weight, strict=True) if p[2] == 1) / weight.sum())


def test_find_and_redact(spark, documents, clashing, finder, rows):
    docs = clashing(documents((1, "mail a.b@c.de or +1 (743) 555-3824"), (None, None), (3, ""), (1, "mail a.b@c.de or +1 (743) 555-3824")))
    found = pii.find(docs, finder).select("doc_id", pii.written(pii.F.col("base")).alias("s"))
    assert rows(found) == [(None, ""), (1, "email:5:13,phone:17:34"), (1, "email:5:13,phone:17:34"), (3, "")]
    masked = pii.redact(docs, finder)
    assert masked.columns == docs.columns and rows(masked, "doc_id", "text") == [(None, None), (1, "mail <EMAIL> or <PHONE>"), (1, "mail <EMAIL> or <PHONE>"), (3, "")]
    assert pii.find(docs.limit(0), finder).count() == 0 and pii.redact(docs.limit(0), finder).count() == 0


def test_without_labels(spark, documents):
    nothing = pii.fit(spark.createDataFrame([], pii.LABELLED_SCHEMA))
    assert pii.find(documents((1, "call 555-123-4567")), nothing).collect()[0]["added"] == []


def test_long_text(finder):
    text = "a@b.cd " * 50_000 + "9" * 100_000
    assert len(pii.base_spans(text)) == 50_000


def test_long_runs_are_decoded_whole(finder):
    from haplometh.llm.crf import emissions, viterbi

    for line, times in (("555 123 4567\n", 300), ("4111 1111 1111 1111\n+49 170 5551234\n", 120)):
        text = line * times
        words = text.split()
        assert len(words) > 2 * 256
        whole = viterbi(emissions(finder.group([[pii.features(words, k) for k in range(len(words))]]), finder.model.weight), finder.model)[0]
        starts = [m.start() for m in pii.WORD.finditer(text)]
        want, k = [], 0
        while k < len(words):
            upto = k + 1
            if pii.LABELS[whole[k]][0] == "B":
                while upto < len(words) and pii.LABELS[whole[upto]] == "I" + pii.LABELS[whole[k]][1:]:
                    upto += 1
                want.append((pii._OF[pii.LABELS[whole[k]][2:]], starts[k], starts[upto - 1] + len(words[upto - 1])))
            k = upto
        assert pii.added_spans([text], finder, [[]]) == [want] and want


def test_viterbi_by_pieces_is_that_of_the_whole():
    import numpy as np

    from haplometh.llm.crf import Model, viterbi, viterbi_pieces

    rng = np.random.default_rng(2)
    for n, length, piece in ((1, 9, 4), (3, 50, 7), (2, 16, 1), (2, 8, 8)):
        e, model = rng.normal(size=(n, length, 5)), Model(None, 2 * rng.normal(size=(5, 5)), rng.normal(size=5))
        assert (viterbi_pieces((e[:, a : a + piece] for a in range(0, length, piece)), model) == viterbi(e, model)).all()


def test_long_neighbours_are_read_whole(finder):
    """A neighbouring word beyond any window, or behind many blanks, still counts; so does a long word."""
    for text in ("x" * 500 + "tel 555-123-4567 ok", "tel" + " " * 200 + "555-123-4567" + "\n" * 300 + "now", "y" * 400 + " 7 " + "z" * 400):
        words, runs = text.split(), [(text[a:b] if a >= 0 else None) for run in pii._item_runs(text) for a, b, _ in run]
        at = words.index(runs[1])
        assert runs == [words[at - 1] if at else None, words[at], words[at + 1] if at + 1 < len(words) else None]
    assert len(pii.shape("A1" * 100)) == 200


def test_many_spans_beside_many_items(finder):
    text = " ".join(f"+1 (743) 555-{i:04d} tel 555-123-{i:04d}" for i in range(3000))
    base = pii.base_spans(text)
    added = pii.added_spans([text], finder, [base])[0]
    assert len(base) == 3000 and not any(pii._meets(pii._merged(base), a, b) for _, a, b in added)
    assert pii._merged([(0, 5, 9), (1, 1, 3), (2, 8, 12), (0, 12, 13)]) == ([1, 5, 12], [3, 12, 13])
    assert [pii._meets(([1, 5], [3, 9]), a, b) for a, b in ((0, 1), (0, 2), (3, 5), (4, 6), (9, 10))] == [False, True, False, True, False]
