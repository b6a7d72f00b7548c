"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haplometh.llm import blockjoin, bpe, jaccard, langid, lshforest, maxscore, merkle, mixing, pii, quality, substrings, vafile, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"), pii.fit(pii.labelled_table(spark)))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


@query
def op7_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe.encode(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return encoded.select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"), "ids_sha256", "decoded_sha256")


@query
def op2_languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return langid.identify(docs, langid.fit(docs)).select("doc_id", F.coalesce(langid.remainder() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op3_vector_files(spark: SparkSession, folder: str) -> DataFrame:
    return vafile.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5)


ORACLES["op3_vector_files"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return blockjoin.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


ORACLES["op10_neighbours"] = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_prepend(CAST(0 AS DOUBLE), list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), lambda a, b: a + b) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query
def op6_mixture(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    taken = (F.col("mix_size") * F.col("mix_copies")).alias("taken")
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_total").alias("source_size"), F.col("mix_target").alias("target"), taken)


@query
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    back = warc.read(warc.archive(table(spark, folder, "pages")), with_data=False)
    return back.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


ORACLES["op5_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest, max(page_id) OVER (PARTITION BY html) AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN keeper END AS refers_to
FROM q
"""


@query
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.resample(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.deduplicate(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


ORACLES["op8_repeated_passages"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT r, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT s.r, s.i, list_slice(d.w, s.i, s.i + 34) AS x FROM s JOIN d USING (r)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY x) AS c FROM h) WHERE c > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM again),
g AS (SELECT r, list(i) AS gone FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda v, k: NOT list_contains(gone, k)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (r)
"""


@query
def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.components(table(spark, folder, "documents"))


ORACLES["op4_near_duplicates"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(list_slice(w, i, i + 3), ' ') AS x
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b USING (x) WHERE a.r < b.r GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
t AS (SELECT r AS a, r AS b FROM d UNION SELECT t.a, e.b FROM t JOIN e ON e.a = t.b),
m AS (SELECT t.a, min(d.doc_id) AS component_id FROM t JOIN d ON d.r = t.b GROUP BY t.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id FROM d LEFT JOIN n USING (r) JOIN m ON m.a = d.r
"""


@query
def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars").cast("decimal(20,0)") + 1)
    told = merkle.audit(merkle.manifest(table(spark, folder, "documents"), tampered))
    return told.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


ORACLES["op13_manifest"] = r"""
WITH RECURSIVE code AS (
  SELECT doc_id, list_reduce(list_prepend(4294967295, flatten(list_transform(list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda b: list_prepend(b, [-1, -1, -1, -1, -1, -1, -1, -1])))),
    lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END) AS c
  FROM (SELECT DISTINCT doc_id FROM documents)),
f AS (
  SELECT d.doc_id, lang, CASE WHEN xor(c, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS changed, n_chars,
    coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents d LEFT JOIN code ON code.doc_id IS NOT DISTINCT FROM d.doc_id),
l AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen(CAST(changed AS VARCHAR)) || ':' || changed, '-') || tail) AS altered
  FROM f),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t FROM l),
nodes AS (
  SELECT t, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY t) AS n FROM p
  UNION ALL
  SELECT t, level + 1, i // 2, sha256(h || coalesce(mate, '')), (n + 1) // 2
  FROM (SELECT *, lead(h) OVER (PARTITION BY t ORDER BY i) AS mate FROM nodes) WHERE i % 2 = 0 AND n > 1),
subs AS (SELECT t, level, h AS subroot FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, t AS i, subroot AS h, count(*) OVER () AS n FROM subs
  UNION ALL
  SELECT level + 1, i // 2, sha256(h || coalesce(mate, '')), (n + 1) // 2
  FROM (SELECT *, lead(h) OVER (ORDER BY i) AS mate FROM tops) WHERE i % 2 = 0 AND n > 1),
walk AS (
  SELECT t, i AS leaf_at, 0 AS level, i, altered AS h, '' AS proof FROM p
  UNION ALL
  SELECT w.t, leaf_at, w.level + 1, w.i // 2, sha256(CASE WHEN w.i % 2 = 1 THEN s.h || w.h ELSE w.h || coalesce(s.h, '') END), proof || coalesce(s.h, '')
  FROM walk w JOIN subs r ON r.t = w.t AND w.level < r.level LEFT JOIN nodes s ON s.t = w.t AND s.level = w.level AND s.i = xor(w.i, 1)),
upper AS (
  SELECT w.t, leaf_at, 0 AS level, w.t AS i, w.h, proof FROM walk w JOIN subs r ON r.t = w.t AND w.level = r.level
  UNION ALL
  SELECT w.t, leaf_at, w.level + 1, w.i // 2, sha256(CASE WHEN w.i % 2 = 1 THEN s.h || w.h ELSE w.h || coalesce(s.h, '') END), proof || coalesce(s.h, '')
  FROM upper w JOIN (SELECT max(level) AS most FROM tops) m ON w.level < m.most LEFT JOIN tops s ON s.level = w.level AND s.i = xor(w.i, 1))
SELECT p.doc_id, p.leaf, subs.subroot, r.h AS root, sha256(u.proof) AS proof_sha256, u.h AS folded_root, u.h = r.h AS verified
FROM p JOIN subs USING (t) JOIN (SELECT h, level FROM tops WHERE n = 1) r ON TRUE JOIN upper u ON u.t = p.t AND u.leaf_at = p.i AND u.level = r.level
"""


@query
def op12_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    return lshforest.components(table(spark, folder, "documents"))


ORACLES["op12_lsh_forest"] = (
    ORACLES["op4_near_duplicates"].replace(">= 85 *", ">= 80 *").replace("m.component_id FROM d", "m.component_id, d.doc_id = m.component_id AS kept FROM d")
)


@query
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return maxscore.search(maxscore.index(table(spark, folder, "documents")), table(spark, folder, "benchmark"), 10)


ORACLES["op11_ranked_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
n AS (SELECT r, doc_id, count(*) AS n FROM d GROUP BY ALL),
c AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS tokens FROM n),
p AS (SELECT term, r, count(*) AS tf FROM d GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, c GROUP BY term, docs),
i AS (SELECT row_number() OVER () AS i, item_id, text FROM benchmark),
q AS (SELECT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i),
s AS (
  SELECT i, item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // tokens)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN n USING (r), c GROUP BY i, item_id, doc_id, r),
k AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""
