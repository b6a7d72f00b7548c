"""From raw documents to token ids, in five stages that each keep the columns of ``documents`` but the last.

Every stage works on all that the one before kept: rejected documents go, one
of each group of near duplicates stays, personal data is masked, sources are
repeated or thinned to their targets, and the rest is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haplometh.llm import bpe, jaccard, mixing, pii, quality
from haplometh.storage import materialize

VOCABULARY = "byte_bpe_50k.json"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling selects, with ``labels`` as the target."""
    return quality.select(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the shingle join at five words and a similarity of 0.8."""
    return jaccard.representatives(docs, size=5, percent=80)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced; ``n_chars`` follows."""
    masked = pii.redact(docs, pii.fit(pii.labelled_table(spark)))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, with the digests of the round trip."""
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("PII", mask_personal_data),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: SQL has neither the hashed models nor the tokenizer; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
