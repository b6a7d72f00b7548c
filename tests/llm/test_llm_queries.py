"""Registered queries against their SQL, and the pipeline against its own stages."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from haplometh.llm import mixing, pii, quality, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = contract.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    ours = df.select(*columns).collect()
    assert ours
    if name in queries.ORACLES:
        con = duckdb.connect()
        for file in os.listdir(FOLDER):
            con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
        result = con.execute(contract.oracle_sql()[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        theirs = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
        assert sorted(map(repr, map(tuple, ours))) == sorted(map(repr, theirs))


def test_thirteen_operators_and_the_pipeline():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert contract.queries()["pipeline"] is corpus_pipeline.run


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], FOLDER).cache())
    good, single, masked, mixed, encoded = seen[1:]
    assert all(df.columns == docs.columns and df.schema.simpleString() == docs.schema.simpleString() for df in seen[1:5])
    assert 0 < good.count() < docs.count() and 0 < single.count() < good.count()
    assert masked.count() == single.count() and mixed.count() == encoded.count()
    finder = pii.fit(pii.labelled_table(spark))
    assert all(not pii.base_spans(r["text"]) for r in masked.select("text").collect())
    assert {r["doc_id"] for r in masked.collect()} == {r["doc_id"] for r in single.collect()} and finder.index
    sizes = {r["doc_id"]: r["mix_copies"] for r in mixing.mix(masked).collect()}
    assert mixed.count() == sum(sizes.values())
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).select("doc_id", "ids_sha256").collect())) == sorted(map(tuple, encoded.select("doc_id", "ids_sha256").collect()))
    assert good.count() == quality.resample(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).count()
    for df in seen:
        df.unpersist()


def test_pipeline_on_empty_tables(spark):
    nothing = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, nothing, FOLDER)
        assert out.count() == 0
        nothing = out if "text" in out.columns else nothing
