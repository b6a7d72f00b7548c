import numpy as np
import pytest
from pyspark.sql import functions as F

from haplometh.llm import quality

FOLDER = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def test_clean_stays_and_junk_goes(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r[0] for r in quality.resample(docs, labels).select("doc_id").collect()}
    good = {r[0] for r in labels.filter("quality = 1").collect()}
    bad = {r[0] for r in labels.filter("quality = 0").collect()}
    assert len(good & kept) / len(good) > 0.98 and len(bad & kept) / len(bad) < 0.3
    same = {r[0] for r in quality.select(docs.repartition(3), labels).select("doc_id").collect()}
    assert same == kept


def plain_ratio(texts, target):
    counts = np.zeros((2, quality.BUCKETS))
    for text, good in zip(texts, target, strict=True):
        places, _ = quality.ngrams([text])
        for p in places:
            counts[0, p] += 1
            counts[1, p] += good
    raw = (counts[0] + 1) / (counts[0] + 1).sum()
    goal = counts[1] + quality.PRIOR * raw
    return np.log(goal / goal.sum()) - np.log(raw)


def test_models_count_everything(spark, documents):
    texts = [f"good word{i % 5} text" for i in range(40)] + [f"bad!! junk{i % 3}" for i in range(20)]
    docs = documents(*enumerate(texts)).repartition(7)
    labels = spark.createDataFrame([(i, int(i < 40), 0) for i in range(0, 60, 2)], LABELS)
    ratio = quality.fit(docs, labels)
    assert np.allclose(ratio, plain_ratio(texts, [i < 40 and i % 2 == 0 for i in range(60)]))
    got = {r["doc_id"]: r["log_weight"] for r in quality.score(docs.select("doc_id", "text"), ratio).collect()}
    assert all(abs(got[i] - ratio[quality.ngrams([t])[0]].sum()) < 1e-9 for i, t in enumerate(texts))


def test_ngrams_stay_in_their_text():
    places, owner = quality.ngrams(["a b!!", None, "", "a"])
    assert len(places) == 6 and sorted(owner) == [0] * 5 + [3]
    assert len(set(quality.ngrams(["x x", "y y"])[0].tolist())) == 3  # two words and the pair of equals


@pytest.mark.parametrize("k", [1, 7, 500, 4999, 5000])
def test_kth_largest(spark, k, monkeypatch):
    monkeypatch.setattr(quality, "FEW", 10)
    monkeypatch.setattr(quality, "BINS", 16)
    values = [((i * 7919) % 5000) ** 3 / 1e3 - 1e5 if i % 3 else 5.5 for i in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert quality.kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]
    assert quality.kth_largest(df, "x", 5001) is None


def test_edges(spark, documents, clashing):
    docs = clashing(documents((1, "a fine text"), (2, None), (3, ""), (4, " \n"), (None, "a fine text"), (1, "a fine text"), (5, "!! " * 50_000)))
    for labels in ([], [(1, 1, 0)], [(1, 0, 0)], [(None, 1, None), (1, None, None)], [(1, 1, 0), (1, 1, 0), (5, 0, 0)]):
        table = spark.createDataFrame(labels, LABELS)
        out = quality.select(docs, table)
        assert out.columns == docs.columns
        ids = [r["doc_id"] for r in out.collect()]
        assert not {2, 3, 4} & set(ids) and ids.count(1) in (0, 2)
        assert quality.resample(docs, table).count() == len(ids)
        assert quality.resample(docs.limit(0), table).count() == 0
    assert quality.resample(docs, spark.createDataFrame([], LABELS)).filter(F.col("doc_id") == 1).count() == 2
