"""Registered queries of the training-data operators and their DuckDB SQL where SQL has one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdeck.llm import language, pii, quality
from tripdeck.llm.decontam import find_overlaps
from tripdeck.llm.jaccard import near_duplicate_classes
from tripdeck.llm.knn import integer_vectors, nearest_neighbours
from tripdeck.llm.licenses import scan_licenses, template_table
from tripdeck.llm.lm_scoring import stupid_backoff
from tripdeck.llm.metric_join import cosine_classes
from tripdeck.llm.packing import pack_documents
from tripdeck.llm.prefix_trie import conversation_turns, forked, prefix_trie
from tripdeck.llm.substrings import remove_repeats
from tripdeck.llm.whitening import integer_grid, whitening

REGISTRY = {}
ORACLE = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_lm_scoring(spark, sf_dir):
    """Stupid-backoff scores of all documents by the bigram model of all documents."""
    return (stupid_backoff(_table(spark, sf_dir, "documents"), order=2, alpha=0.4, min_count=2)
            .withColumn("log_score", F.round("log_score", 3)))


ORACLE["op1_lm_scoring"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS words
  FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w),
x AS (SELECT doc_id, words[i] AS v, CASE WHEN i > 1 THEN words[i - 1] END AS u FROM p),
c1 AS (SELECT v, count(*) AS c FROM x GROUP BY v),
c2 AS (SELECT u, v, count(*) AS c FROM x WHERE u IS NOT NULL GROUP BY u, v),
n AS (SELECT count(*) AS n FROM x),
s AS (
  SELECT x.doc_id,
         CASE WHEN x.u IS NULL THEN ln(a.c / n.n) WHEN c2.c >= 2 THEN ln(c2.c / b.c)
              ELSE ln(0.4::DOUBLE) + ln(a.c / n.n) END AS score,
         CASE WHEN x.u IS NOT NULL AND c2.c < 2 THEN 1 ELSE 0 END AS fell
  FROM x JOIN c1 a ON x.v = a.v LEFT JOIN c1 b ON x.u = b.v
  LEFT JOIN c2 ON x.u = c2.u AND x.v = c2.v CROSS JOIN n)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words,
       coalesce(round(sum(s.score), 3), 0.0) AS log_score,
       CAST(coalesce(sum(s.fell), 0) AS BIGINT) AS n_backoff
FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id, w.words
"""


@register
def op2_voronoi_knn(spark, sf_dir):
    """The 5 highest integer inner products of every 50th vector with all others."""
    vectors = integer_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 256)
    return nearest_neighbours(vectors, vectors.where("id % 50 = 0"), k=5)


ORACLE["op2_voronoi_knn"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id,
         CAST(list_inner_product(q.v, x.v) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id AND len(q.v) = len(x.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@register
def op3_best_fit_packing(spark, sf_dir):
    """All documents, tokenised and packed into sequences of at most 4096 tokens."""
    return pack_documents(_table(spark, sf_dir, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"), max_tokens=4096, end_id=1)


@register
def op4_jaccard_join(spark, sf_dir):
    """Near-duplicate classes of all documents: 4-word shingles, Jaccard of 0.85 or more."""
    return (near_duplicate_classes(_table(spark, sf_dir, "documents"), n=4, percent=85)
            .select("doc_id", "n_shingles", "component_id"))


ORACLE["op4_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS words
  FROM documents),
g AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []::VARCHAR[]
                      WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(words) - 2),
                             lambda i: array_to_string(words[i:i + 3], ' '))) END AS grams
  FROM w),
s AS (SELECT doc_id, len(grams) AS n FROM g),
x AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM g),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM x a JOIN x b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(u, v) AS (
  SELECT doc_id, doc_id FROM s
  UNION
  SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, min(r.v) AS component_id
FROM s JOIN reach r ON r.u = s.doc_id GROUP BY s.doc_id, s.n
"""


def held_out(parts: int, remainder: int):
    """Whether crc32 of the doc_id as text has this remainder modulo ``parts``."""
    return F.crc32(F.col("doc_id").cast("string")) % parts == remainder


@register
def op5_quality_classifier(spark, sf_dir):
    """Quality score of all documents, learnt from labels outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels").where(~held_out(5, 0)))
    return (quality.quality_scores(docs, model)
            .select("doc_id", held_out(5, 0).alias("held_out"), "score",
                    (F.col("score") >= 0.3).cast("int").alias("predicted")))


@register
def op6_license_scan(spark, sf_dir):
    """License notices found in all documents."""
    return scan_licenses(_table(spark, sf_dir, "documents"), template_table(spark))


@register
def op7_pii(spark, sf_dir):
    """Personal data in all documents: counts per base kind, a digest of base spans, all spans."""
    found = pii.personal_data(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != pii.TERM)
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long) as n_{k}")
              for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


@register
def op8_substring_dedup(spark, sf_dir):
    """All documents without the words of repeated 35-word windows, as counts and a digest."""
    return (remove_repeats(_table(spark, sf_dir, "documents"), window=35)
            .select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")))


ORACLE["op8_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM w WHERE len(words) >= 35),
x AS (SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS win FROM p),
hit AS (SELECT doc_id, i FROM x WHERE win IN (SELECT win FROM x GROUP BY win HAVING count(*) > 1)),
gone AS (SELECT doc_id, list(i) AS starts FROM hit GROUP BY doc_id),
cover AS (
  SELECT w.doc_id, words,
         list_distinct(flatten(list_transform(coalesce(starts, []::BIGINT[]),
                                              lambda s: range(s, s + 35)))) AS dead
  FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(dead) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_transform(
         list_filter(range(1, len(words) + 1), lambda i: NOT list_contains(dead, i)),
         lambda i: words[i]), ' ')) AS kept_sha256
FROM cover
"""


@register
def op9_language_id(spark, sf_dir):
    """Language of all documents, learnt from the labelled ones outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents").where("doc_id is not null")
    model = language.fit(docs.where(~held_out(4, 2)).select("lang", "text"))
    return (language.languages(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score",
                    F.array_join("lang_set", ",").alias("lang_set")))


@register
def op10_decontamination(spark, sf_dir):
    """Every verified overlap of a document with a benchmark item, best region per pair."""
    found = find_overlaps(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                          _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("leaks")).withColumnsRenamed(
        {"start": "start_word", "length": "n_words"})


@register
def op11_embedding_whitening(spark, sf_dir):
    """Whitened coordinates of every vector along the first 32 components, a row per pair."""
    fitted = whitening(integer_grid(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
                                    scale=64, shift=1_000_000), components=32)
    explained = F.array(*[F.lit(x) for x in fitted.explained]).cast("array<double>")
    return (fitted.rows()
            .select(F.col("id").alias("vec_id"), "n",
                    F.col("deviation").cast("long").alias("deviation"),
                    F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
                    F.get(explained, F.col("at")).alias("explained"),
                    F.lit(fitted.identity_error()).cast("double").alias("identity_error")))


@register
def op12_prefix_trie(spark, sf_dir):
    """The prefix trie of all conversations, each rebuilt with the head of every fifth one."""
    talks = _table(spark, sf_dir, "conversations")
    head = F.crc32(F.col("conv_id").cast("string")) % 9
    forks = (talks.where("conv_id is not null").select("conv_id").distinct()
             .withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
             .withColumn("head", head))
    return (prefix_trie(*forked(conversation_turns(talks), forks, longest=8))
            .withColumnRenamed("saved_bytes", "saved_tokens"))


ORACLE["op12_prefix_trie"] = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(4294967295, list_reduce(
           list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
           lambda a, b: list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)),
           4294967295)) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
m AS (SELECT c.conv_id, base, h, least(h, count(t.i)) AS taken
      FROM c LEFT JOIN t ON t.conv_id = c.base GROUP BY c.conv_id, base, h),
r AS (
  SELECT m.conv_id, t.i AS d, role, text FROM m JOIN t ON t.conv_id = m.base AND t.i <= h
  UNION ALL
  SELECT m.conv_id, t.i - h + taken, role, text FROM m JOIN t ON t.conv_id = m.conv_id AND t.i > h),
x AS (
  SELECT conv_id, d, strlen(text) AS bytes,
         array_to_string(list(md5(role || chr(0) || text)) OVER (
           PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING), ',') AS k,
         d = count(*) OVER (PARTITION BY conv_id) AS last
  FROM r),
p AS (
  SELECT conv_id, d, md5(k) AS k, bytes, last FROM x
  UNION ALL
  SELECT conv_id, 0, 'root', 0, conv_id NOT IN (SELECT conv_id FROM x) FROM c),
n AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n, max(bytes) AS bytes,
         list_sort(list(conv_id) FILTER (WHERE last)) AS ends
  FROM p GROUP BY k, d),
u AS (SELECT a.k, b.conv_id AS up FROM n a JOIN p q ON q.conv_id = a.conv_id AND q.d = a.d - 1
      JOIN n b ON b.k = q.k AND b.d = q.d),
kids AS (SELECT q.k, q.d, count(*) AS n FROM n a JOIN p q ON q.conv_id = a.conv_id AND q.d = a.d - 1
         GROUP BY q.k, q.d),
s AS (
  SELECT q.k, q.d, sum((a.n - 1) * a.bytes) AS saved, count(*) FILTER (WHERE kids.n IS NULL) AS leaves
  FROM n a LEFT JOIN kids ON kids.k = a.k AND kids.d = a.d
  JOIN p q ON q.conv_id = a.conv_id AND q.d <= a.d GROUP BY q.k, q.d)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.up AS parent_conv_id, n.n AS n_convs,
       coalesce(kids.n, 0) AS n_children, s.leaves AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(array_to_string(n.ends, ','), '')) AS ends_sha256
FROM n JOIN s ON s.k = n.k AND s.d = n.d LEFT JOIN u ON u.k = n.k
LEFT JOIN kids ON kids.k = n.k AND kids.d = n.d
"""


@register
def op13_metric_range_join(spark, sf_dir):
    """Near-duplicate classes of all vectors: equal labels and a cosine of 0.98 or more."""
    return (cosine_classes(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label",
                           least=0.98).withColumnRenamed("id", "vec_id"))


ORACLE["op13_metric_range_join"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CASE
    WHEN label IS NOT NULL AND embedding IS NOT NULL
     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
     AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    THEN list_transform(embedding, lambda x: CAST(x AS DOUBLE)) END AS v
  FROM embeddings WHERE vec_id IS NOT NULL),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id) AS n_links, c.component_id,
       c.component_id = v.vec_id AS kept
FROM v JOIN c ON c.vec_id = v.vec_id
"""
