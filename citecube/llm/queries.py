"""Registered queries of the training-data operators, one per operator, with
SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, cap_filters, exact, hard_negatives, licenses, neardup, packing, prefix_trie, quality, sharding, substring, topk, urls
from .common import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[fn.__name__] = fn
        if sql:
            _SQL[fn.__name__] = sql
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@register()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    weights = quality.train(docs, read_table(spark, sf_dir, "labels"), usable=~quality.in_fold())
    return (quality.score(docs, weights).withColumnRenamed("id", "doc_id")
            .select("doc_id", quality.in_fold().alias("held_out"), "score",
                    (F.col("score") >= quality.REJECT_BELOW).cast("int").alias("predicted")))


@register(r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10""")
def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@register(r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i+2], ' '))) END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
l AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
r(id, m) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT l.b, r.m FROM r JOIN l ON l.a = r.id WHERE r.m < l.b)
SELECT s.doc_id, len(sh) AS n_shingles, min(m) AS component_id, s.doc_id = min(m) AS kept
FROM s JOIN r ON r.id = s.doc_id GROUP BY s.doc_id, len(sh)""")
def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (neardup.near_groups(read_table(spark, sf_dir, "documents"), words=3, percent=85)
            .withColumnRenamed("id", "doc_id"))


_TEMPLATE_VALUES = ", ".join("({}, '{}', '{}')".format(i, n, t) for i, (n, t) in enumerate(licenses.TEMPLATES))


@register(r"""
WITH t AS (SELECT * FROM (VALUES __TEMPLATES__) AS v(template, license, text)),
x AS (SELECT 't' || template AS id, text FROM t UNION ALL SELECT 'd' || doc_id, coalesce(text, '') FROM documents),
w AS (
  SELECT id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\p{L}\p{N}]+'), lambda x: x <> '') AS words FROM x),
g AS (
  SELECT id, unnest(range(0, len(words) - 4)) AS i,
         unnest(list_transform(range(1, len(words) - 3), lambda j: array_to_string(words[j:j+4], ' '))) AS h
  FROM w WHERE len(words) >= 5),
ts AS (SELECT DISTINCT template, license, h FROM g JOIN t ON g.id = 't' || template),
tn AS (SELECT *, count(*) OVER (PARTITION BY template) AS s FROM ts),
hit AS (
  SELECT CAST(substr(id, 2) AS BIGINT) AS doc_id, license, template, s, i, g.h FROM g JOIN tn ON g.h = tn.h WHERE id[1] = 'd'),
win AS (
  SELECT doc_id, license, template, s, (i // s) * s AS start, h FROM hit
  UNION ALL SELECT doc_id, license, template, s, (i // s - 1) * s, h FROM hit WHERE i // s >= 1),
m AS (
  SELECT doc_id, license, template, s, start, count(DISTINCT h) AS n FROM win GROUP BY ALL HAVING count(DISTINCT h) >= 0.8 * s)
SELECT doc_id, license, template, max(s) AS n_template, max(n) AS n_shared, count(*) AS n_windows, min(start) AS first_word
FROM m GROUP BY doc_id, license, template""".replace("__TEMPLATES__", _TEMPLATE_VALUES))
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@register(r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS s FROM documents),
g AS (SELECT s, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY s)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, s AS text_sha256 FROM d JOIN g USING (s)""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_labels(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@register()
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@register(r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(words) - 33)) AS i FROM w WHERE len(words) >= 35),
g AS (SELECT p.doc_id, p.i, md5(array_to_string(words[p.i:p.i+34], ' ')) AS h FROM p JOIN w USING (doc_id)),
r AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM g SEMI JOIN r USING (h)),
n AS (SELECT doc_id, count(*) AS n_removed, list(i) AS gone FROM c GROUP BY doc_id),
t AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM t ANTI JOIN c USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)""")
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(read_table(spark, sf_dir, "documents"), window=35).withColumnRenamed("id", "doc_id")


@register()
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("record.text", F.lit(""))
    return (sharding.shuffle_shards(read_table(spark, sf_dir, "documents"), shards=8)
            .select("record.doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                    F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


@register()
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(read_table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


@register()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(read_table(spark, sf_dir, "documents"),
                        public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


@register(r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
r(id, m) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT l.b, r.m FROM r JOIN l ON l.a = r.id WHERE r.m < l.b),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(any_value(n_links), 0) AS n_links, min(m) AS component_id, vec_id = min(m) AS kept
FROM embeddings JOIN r ON r.id = vec_id LEFT JOIN n ON n.a = vec_id GROUP BY vec_id""")
def op11_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (cap_filters.near_vectors(read_table(spark, sf_dir, "embeddings"), percent=90)
            .withColumnRenamed("id", "vec_id"))


@register(r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


@register(r"""
WITH o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS item,
         len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS donor,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
             lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
                                           lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) % 4 AS h
  FROM o GROUP BY conv_id),
r AS (
  SELECT c.conv_id, pos AS place, item, words FROM c JOIN o ON o.conv_id = donor AND pos <= h
  UNION ALL SELECT c.conv_id, 1000000000 + pos, item, words FROM c JOIN o USING (conv_id) WHERE pos > h),
l AS (
  SELECT c.conv_id, list(item ORDER BY place) FILTER (item IS NOT NULL) AS items,
         list(words ORDER BY place) FILTER (item IS NOT NULL) AS words
  FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
z AS (
  SELECT conv_id, d AS depth, coalesce(len(items), 0) = d AS last, CASE WHEN d = 0 THEN 0 ELSE words[d] END AS words,
         CASE WHEN d = 0 THEN '' ELSE md5(array_to_string(items[1:d], ',')) END AS node,
         CASE WHEN d = 1 THEN '' WHEN d > 1 THEN md5(array_to_string(items[1:d-1], ',')) END AS above
  FROM (SELECT *, unnest(range(0, coalesce(len(items), 0) + 1)) AS d FROM l)),
n AS (
  SELECT depth, node, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM z GROUP BY depth, node),
k AS (SELECT above AS node, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (node, depth)),
s AS (
  SELECT z.node, z.depth, sum((v.n_children = 0)::BIGINT) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved_tokens
  FROM v JOIN z ON z.conv_id = v.conv_id AND z.depth <= v.depth GROUP BY ALL)
SELECT v.conv_id, v.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM v JOIN s USING (node, depth) LEFT JOIN v u ON u.node = v.above AND u.depth = v.depth - 1""")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, ends = prefix_trie.trie(*prefix_trie.rebuild(prefix_trie.order_turns(read_table(spark, sf_dir, "conversations"))))
    return (nodes.join(prefix_trie.end_digests(ends), ["conv_id", "depth"], "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))))
