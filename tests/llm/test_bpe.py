import gc
import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from haplometh.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = " \t\n\r\x0b\x0c\x1c\x85\xa0 　aAbé1²'sllſ中文字🙂‍́!?.,-_٣"


@pytest.fixture(scope="module")
def both():
    return bpe.codec(open(PATH, encoding="utf-8").read()), Tokenizer.from_file(PATH)


def random_texts():
    rng = random.Random(5)
    for k in range(4000):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 14)))
        if k % 5 == 0:
            text += "<|endoftext|>" + text
        if k % 3 == 0:
            text = "".join(chr(rng.choice([rng.randint(0, 0x2FFF), rng.randint(0x3000, 0xD7FF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(4)) + text
        yield text
    for k in range(300):
        yield "".join(rng.choice("aabehinorst") for _ in range(rng.randint(1, 200)))
        yield rng.choice("ab- !") * rng.randint(1, 300)
    yield "ab " * 20_000
    yield "x" * 50_000


def test_same_ids_and_text(both):
    own, theirs = both
    for text in random_texts():
        ids = own.encode(text)
        assert ids == theirs.encode(text, add_special_tokens=False).ids, text[:80]
        assert own.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def test_caches_are_bounded(both, monkeypatch):
    own, theirs = both
    monkeypatch.setattr(bpe, "CACHED_PIECES", 50)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 50)
    for k in range(300):
        text = f"word{k} other{k * 7} bleanth{'abcdefgh'[k % 8]}on."
        assert own.encode(text) == theirs.encode(text).ids
    assert len(own.pieces) <= 50


def test_query_shape(documents, clashing, rows, both):
    text = "Hello there,  world<|endoftext|>\n"
    docs = clashing(documents((1, text), (2, None), (3, ""), (None, text), (1, text)))
    ids = both[1].encode(text, add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    full = (len(ids), sha(",".join(map(str, ids))), sha(text))
    encoded = bpe.encode(docs, PATH)
    assert rows(encoded, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == [(None, *full), (1, *full), (1, *full), (2, 0, sha(""), sha("")), (3, 0, sha(""), sha(""))]
    assert rows(bpe.decode(encoded, PATH), "doc_id", "text") == [(None, text), (1, text), (1, text), (2, ""), (3, "")]
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def test_no_codec_stays_in_a_worker(spark, documents):
    def held(batches):
        found = sum(type(x).__name__ == "Codec" for x in gc.get_objects())
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([found] * batch.num_rows, pa.int64())], names=["held"])

    docs = documents(*[(k, f"one text of many {k}") for k in range(64)]).repartition(8)
    assert bpe.encode(docs, PATH).agg(F.sum("n_tokens")).collect()[0][0] > 0
    left = spark.range(0, 64, 1, 16).mapInArrow(held, "held long")
    assert {r.held for r in left.distinct().collect()} == {0}
