import zlib

import numpy as np
import pytest

from haplometh.llm import langid
from haplometh.llm.crf import Model, marginals

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return docs, langid.fit(docs)


def test_held_out_accuracy(learned):
    docs, model = learned
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(langid.remainder() == 1).collect()
    assert len(got) > 200 and sum(r["lang_pred"] == r["lang"] for r in got) / len(got) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_remainder_is_the_checksum(spark, documents):
    got = documents(*[(i, "") for i in (0, 1, 17, 123456789, -5)]).select("doc_id", langid.remainder()).collect()
    assert all(r[1] == zlib.crc32(str(r[0]).encode()) % 3 for r in got)


def test_held_out_rows_are_not_learned_from(spark, documents):
    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 3 == 1)
    free = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 3 != 1)
    model = langid.fit(documents((held, "eins zwei drei", "xx"), (free, "one two three", "yy"), (free, "null", None)))
    assert model.languages == ["yy"]


def test_forward_backward_in_blocks(learned):
    _, model = learned
    texts = ["the thing with that", "", "les deau que la para con " * 60, "ich und die " * 3]
    probability, first = langid.label_words(texts, model)
    for text, a, b in zip(texts, first[:-1], first[1:], strict=True):
        if a < b:
            g = langid.grams([text])
            e = np.add.reduceat(model.gram[g.index].sum(axis=1), g.first[:-1], axis=0).astype(float) + model.word[langid.lexicon_rows(model.lexicon, g.hash)]
            node, _, _ = marginals(e[None], Model(None, model.transition, model.start))
            assert np.allclose(node[0], probability[a:b], atol=1e-8)


def test_code_switching(learned):
    _, model = learned
    probability, _ = langid.label_words(["the thing with that thing of the les deau que un le est"], model)
    best = [model.languages[k] for k in probability.argmax(axis=1)]
    assert best[:4] == ["en"] * 4 and best[-3:] == ["fr"] * 3


def test_grams_stay_in_their_word():
    one, two = langid.grams(["ab cd"]), langid.grams(["xx", "cd!"])
    assert np.array_equal(one.index[one.first[1] :], two.index[two.first[1] :]) and one.hash[1] == two.hash[1]
    assert list(two.text_first) == [0, 1, 2]


def test_edges(spark, documents, clashing, learned, rows):
    _, model = learned
    docs = clashing(documents((1, None), (2, ""), (3, "123 !?"), (None, "the thing of that"), (4, "the " * 30_000), (4, "the " * 30_000)))
    got = rows(langid.identify(docs, model), "doc_id", "lang_pred")
    assert got == [(None, "en"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en")]
    empty = docs.limit(0)
    assert langid.identify(empty, langid.fit(empty)).count() == 0
    assert rows(langid.identify(docs, langid.LanguageModel([])), "lang_pred") == [("und",)] * 6


def test_word_labels_leave_the_task(documents, learned):
    _, model = learned
    texts = ["the thing with that thing of the, les deau que un le est!", None, "12 !", "\u0130\u0130 the  that"]
    found = {r["doc_id"]: r["words"] for r in langid.labelled(documents(*enumerate(texts)), model).collect()}
    words = [texts[0][w["start"] : w["end"]] for w in found[0]]
    assert words == "the thing with that thing of the les deau que un le est".split()
    assert [w["lang"] for w in found[0]][:4] == ["en"] * 4 and [w["lang"] for w in found[0]][-3:] == ["fr"] * 3
    probability, _ = langid.label_words([texts[0]], model)
    assert np.allclose([w["probability"] for w in found[0]], probability.max(axis=1))
    assert found[1] == found[2] == [] and [texts[3][w["start"] : w["end"]] for w in found[3]][-2:] == ["the", "that"]
    assert [r["words"] for r in langid.labelled(documents((1, "the")), langid.LanguageModel([])).collect()] == [[]]


def test_the_sample_does_not_depend_on_the_order_of_rows(documents):
    """Also where ids repeat; rows that repeat id and text count once."""
    words = ["eins zwei drei", "vier fünf", "one two three", "four five", "six seven eight"]
    rows = [(3 * (i % 4) + 2, f"{words[i % 5]} {i % 13}", "de" if i % 5 < 2 else "en") for i in range(60)]
    orders = [rows, rows[::-1], rows + rows[:20]]
    models = [langid.fit(documents(*o).repartition(1 + n), docs_each=6) for n, o in enumerate(orders)]
    for other in models[1:]:
        assert other.languages == models[0].languages and np.array_equal(other.word, models[0].word) and np.array_equal(other.gram, models[0].gram)


def test_the_language_of_a_document_is_the_likeliest_of_its_words():
    model = langid.LanguageModel(["a", "b"])
    probability = np.array([[0.9, 0.1], [0.4, 0.6], [0.4, 0.6], [0.5, 0.5]])
    langs, scores = langid.decided(probability, np.array([0, 3, 3, 4]), model)
    assert langs == ["a", "und", "a"] and abs(scores[0] - 1.7 / 3) < 1e-9 and scores[1] == 0
