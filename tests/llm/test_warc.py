import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from haplometh.llm import warc

PAGES = "page_id long, url string, html string, data string, chunk string, digest string"


@pytest.fixture
def pages(spark):
    def build(*rows):
        return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES)

    return build


def result(df, rows):
    back = warc.read(warc.archive(df), with_data=False)
    return rows(back, "page_id", "payload_bytes", "digest", "type", "refers_to")


def sha(text):
    return hashlib.sha1((text or "").encode()).hexdigest()


def test_roles(pages, rows):
    long, short = "é" * 500, "x" * 999
    got = result(pages((1, "http://a", long), (2, "http://b", long), (3, None, short), (4, "u", short), (5, "u", None), (6, "u", ""), (9, "h", long)), rows)
    assert got == [
        (1, 1000, sha(long), "revisit", 9), (2, 1000, sha(long), "revisit", 9), (3, 999, sha(short), "response", None), (4, 999, sha(short), "response", None),
        (5, 0, sha(""), "response", None), (6, 0, sha(""), "response", None), (9, 1000, sha(long), "response", None),
    ]


def test_null_and_repeated_ids(pages, rows):
    long = "y" * 2000
    got = result(pages((None, "a", long), (4, "a", long), (4, "a", long), (2, "a", long), (2, "a", "z")), rows)
    assert [(r[0], r[3], r[4]) for r in got] == [(None, "revisit", 4), (2, "response", None), (2, "revisit", 4), (4, "response", None), (4, "response", None)]
    assert [r[3] for r in result(pages((None, "a", long), (None, "b", long)), rows)] == ["response", "response"]
    assert result(pages(), rows) == []


def test_payload_comes_back(spark, pages):
    texts = ["", "a\r\n\r\nb", "WARC/1.1\r\n\r\n", "é" * 40_000, "中" * (warc.CHUNK // 3), "z" * warc.CHUNK, "q" * (3 * warc.CHUNK + 1)]
    df = pages(*[(i, f"http://x/{i} \r\ny", t) for i, t in enumerate(texts)])
    table = warc.read(warc.archive(df))
    got = table.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "data", "digest", "ends"))).alias("c"), F.first("url").alias("url")).collect()
    assert len(got) == len(texts)
    for r in got:
        raw, digest = b"", hashlib.sha1()
        for k, c in enumerate(r["c"]):
            assert c["chunk"] == k and len(c["data"]) <= warc.CHUNK and c["ends"] == (k == len(r["c"]) - 1)
            raw += bytes(c["data"])
            digest.update(bytes(c["data"]))
            assert c["digest"] == digest.hexdigest()
        assert raw.decode() == texts[r["page_id"]] and "\r" not in r["url"]


def test_archives_roll_over_and_are_standard(spark, pages, tmp_path):
    df = pages(*[(i, f"http://x/{i}", hashlib.sha512(str(i).encode()).hexdigest() * 40) for i in range(30)]).coalesce(1)
    manifest = warc.write(warc.chunks(warc.with_roles(df)), str(tmp_path), most=1_000).collect()
    assert len(manifest) > 2 and sum(r["records"] for r in manifest) == 30
    body = gzip.decompress(open(manifest[0]["path"], "rb").read())
    assert body.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and body.endswith(b"\r\n\r\n")
    assert body.count(b"WARC/1.1\r\n") == manifest[0]["records"]


def test_damage_is_noticed(tmp_path):
    head = warc.head(1, "u", sha("abc"), 3, None)
    for body in (head + b"abd\r\n\r\n", head + b"ab", head + b"abcd\r\n\r\n", b"junk\r\n\r\n"):
        with pytest.raises((ValueError, KeyError, TypeError)):
            list(warc.records_of(io.BytesIO(gzip.compress(body)), True))
    assert len(list(warc.records_of(io.BytesIO(gzip.compress(head + b"abc\r\n\r\n")), True))) == 1


def test_long_urls_and_clashing_columns(spark, pages, rows):
    """An url that a header cannot hold is left out; its record is whole."""
    long = "http://x/" + " " * 1_100_000
    fits = "http://x/" + "y" * (warc.LONGEST_TARGET - 9)
    df = pages((1, long, "text"), (2, fits, "z" * 3000), (3, fits + "y", "z" * 3000))
    extra = df
    for name in "payload payload_bytes refers_to last ends type path records r_page r_digest n".split():
        extra = extra.withColumn(name, F.lit("x"))
    assert result(extra, rows) == result(df, rows)
    back = {r["page_id"]: r["url"] for r in warc.read(warc.archive(df)).collect()}
    assert back == {1: None, 2: fits, 3: None}
    assert warc.read(warc.archive(df.limit(0))).count() == 0
