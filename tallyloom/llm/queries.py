"""The operators of this subpackage over their whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tallyloom.llm import (
    ann,
    hard_negatives,
    jaccard_join,
    lm_scoring,
    mixing,
    packing,
    quality,
    sharding,
    suffix_dedup,
    token_cache,
    topk_join,
    toxicity,
    whitening,
)
from tallyloom.llm.registry import QUERIES, STATEMENTS, query, table  # noqa: F401

_OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, o.vec_id, list_sum(list_transform(list_zip(q.c, o.c), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v o ON q.vec_id % 50 = 0 AND o.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op1_topk_join", _OP1)
def op1_topk_join(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk_join.exact_topk(rows, F.col("_id") % 50 == 0, 5)


@query("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    return token_cache.document_tokens(table(spark, sf_dir, "documents", "doc_id", "text"),
                                       public_tokenizers.path("piece_bpe_32k.model"))


@query("op3_shards")
def op3_shards(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"), 40)


_OP4 = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY source_size * (6 / w)::BIGINT, source NULLS LAST) AS i,
  sum(source_size) OVER () AS all_words, sum(w) OVER () AS all_weights FROM w),
c AS (SELECT *, coalesce(sum(source_size) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b,
  coalesce(sum(w) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bw FROM o),
f AS (SELECT *, bool_and(3 * source_size * (all_weights - bw) <= w * (all_words - 3 * b)) OVER (ORDER BY i) AS capped FROM c),
t AS (SELECT source, source_size, CASE WHEN capped THEN (3 * source_size)::DOUBLE ELSE
  (w * (all_words - 3 * sum(CASE WHEN capped THEN source_size ELSE 0 END) OVER ()))::DOUBLE
  / (sum(CASE WHEN capped THEN 0 ELSE w END) OVER ())::DOUBLE END AS target FROM f),
p AS (SELECT doc_id, size, source_size, target,
  CASE WHEN source_size > 0 THEN floor(target / source_size * 1048576)::BIGINT ELSE 0 END AS each,
  ('0x' || substr(md5('mix|' || coalesce(d.source, '')), 1, 5))::BIGINT AS u,
  row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (((u + each * place) >> 20) - ((u + each * (place - 1)) >> 20)) * size AS taken FROM p
"""


@query("op4_mix", _OP4)
def op4_mix(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


@query("op8_nearest")
def op8_nearest(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.nearest(rows, F.col("_id") % 20 == 0, 20)


@query("op9_packing")
def op9_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"),
                                  public_tokenizers.path("word_bpe_49k.json"))


_OP5 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS met FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * met >= 90 * (x.n + y.n - met)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
"""


@query("op5_jaccard_join", _OP5)
def op5_jaccard_join(spark, sf_dir):
    return jaccard_join.with_component(table(spark, sf_dir, "documents", "doc_id", "text"), 3, 90)


@query("op6_quality")
def op6_quality(spark, sf_dir):
    return quality.score_documents(table(spark, sf_dir, "documents", "doc_id", "text"),
                                   table(spark, sf_dir, "labels", "doc_id", "quality"))


@query("op7_toxicity")
def op7_toxicity(spark, sf_dir):
    return toxicity.grade_documents(table(spark, sf_dir, "documents", "doc_id", "text"),
                                    table(spark, sf_dir, "labels", "doc_id", "toxic"))


@query("op10_lm_score")
def op10_lm_score(spark, sf_dir):
    return lm_scoring.score_texts(table(spark, sf_dir, "documents", "doc_id", "text"))


_OP11 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
p AS (SELECT r, unnest(range(0, octet_length(b) - 199)) AS i,
  unnest(list_transform(range(0, octet_length(b) - 199), lambda i: md5(array_slice(b, i + 1, i + 200)))) AS k FROM d),
w AS (SELECT r, i, count(*) OVER (PARTITION BY k) AS n FROM p),
m AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS opens FROM w WHERE n > 1),
g AS (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS g FROM m),
s AS (SELECT r, min(i) AS s, max(i) + 200 AS e FROM g GROUP BY r, g),
o AS (SELECT r, s, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS done FROM s),
k AS (SELECT o.r, sum(e - s)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans, max(e) AS done,
  string_agg(hex(array_slice(b, done + 1, s)), '' ORDER BY s) AS kept FROM o JOIN d ON o.r = d.r GROUP BY o.r)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, '') || hex(array_slice(b, coalesce(done, 0) + 1, octet_length(b))))) AS kept_sha256
FROM d LEFT JOIN k ON d.r = k.r
"""


@query("op11_suffix_dedup", _OP11)
def op11_suffix_dedup(spark, sf_dir):
    return suffix_dedup.repeat_report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op12_whitening")
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), 8)


_OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS anchor_id, o.vec_id, q.label = o.label AS alike,
    list_sum(list_transform(list_zip(q.c, o.c), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v o ON q.vec_id % 50 = 0 AND o.vec_id <> q.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.alike
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@query("op13_hard_negatives", _OP13)
def op13_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", shifted), F.col("_id") % 50 == 0)
