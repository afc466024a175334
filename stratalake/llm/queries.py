"""Registered queries of the operators and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, centroids, chat, filter_audit, fingerprints, html_text, langid, lm_score, mixing, ngram_join,
               packing, toxicity, url_filter)
from .common import prepare, table


def fold(n: int) -> Column:
    """crc32 of the document id as text, modulo n; 0 without an id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n, F.lit(0))


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(packing.TOKENIZER)


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, its turns and learned text read back from the output."""
    control = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)],
                                  "conv_id long, turn long, role string, text string")
    done = chat.format_conversations(rows.unionByName(extra))
    done = done.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                       chat.read_learned(F.col("segments")).alias("learned"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(said, 256).alias("turns_sha256"),
                       F.char_length("learned").cast("long").alias("loss_chars"),
                       F.sha2("learned", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of their words by weights 5, 2, 1."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored; labels of a third of the ids are held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.fit(docs, labels, fold(3) != 1)
    return toxicity.score(docs, model).select("doc_id", (fold(3) == 1).alias("held_out"), "score", "predicted")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; a quarter of the ids is held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.fit(docs, fold(4) != 2)
    return langid.classify(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its near copies and its number of links."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with likenesses."""
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 100."""
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding").withColumnRenamed("embedding", "vector")
    return ann.search(rows, F.col("vec_id") % 100 == 0, 10)


def op9_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), word_tokenizer())


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by its url."""
    prepare(spark)
    return url_filter.judge(table(spark, sf_dir, "pages", "page_id", "url"), url_filter.rule_table(spark)).select(
        "page_id", "host", "path", "rule", "verdict")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every complete vector in one of 16 clusters after three rounds."""
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding").withColumnRenamed("embedding", "vector")
    return centroids.cluster(rows)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from each source, in every order and step."""
    return filter_audit.audit(table(spark, sf_dir, "documents", "doc_id", "text", "source"),
                              table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model of six sevenths of the ids."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = lm_score.score(docs, lm_score.fit(docs, fold(7) != 2))
    return found.select("doc_id", (fold(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                        "base_score", "score")


QUERIES = {f.__name__: f for f in (
    op1_chat_formatting, op2_source_mixing, op3_html_extraction, op4_toxicity, op5_language_id,
    op6_ngram_jaccard_join, op7_fingerprints, op8_nearest_neighbours, op9_sequence_packing, op10_url_filter,
    op11_centroid_clustering, op12_filter_audit, op13_lm_scoring)}

#: One round of operator 11 in SQL: assignment a{i} to centroids c{i}, then their move to c{j}.
_ROUND = """
a{i} AS (SELECT r, vec_id, v, min(struct_pack(d := d, c := c)) AS m FROM (
    SELECT k.r, k.vec_id, k.v, c.c, list_sum([(k.v[i] - c.x[i]) * (k.v[i] - c.x[i]) FOR i IN range(1, 65)])::BIGINT AS d
    FROM k CROSS JOIN c{i} c) GROUP BY r, vec_id, v),
"""
_MOVE = """
s{i} AS (SELECT c, pos, sum(x)::BIGINT AS s, count(*) AS n FROM (
    SELECT m.c AS c, unnest(v) AS x, unnest(range(1, 65)) AS pos FROM a{i}) GROUP BY c, pos),
n{i} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS x FROM s{i} GROUP BY c),
c{j} AS (SELECT o.c, coalesce(n.x, o.x) AS x FROM c{i} o LEFT JOIN n{i} n USING (c)),
"""

ORACLES = {
    "op1_chat_formatting": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(20 + length(role) + length(text) + length(regexp_replace(role || text, '[^\\<\[]', '', 'g')))::BIGINT
    AS formatted_chars
FROM c GROUP BY conv_id""",
    "op2_source_mixing": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix|' || coalesce(doc_id::VARCHAR, 'null')) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, 2 * source_size AS cap,
  sum(source_size) OVER ()::DOUBLE AS total FROM s),
l AS (SELECT *, (1.5::DOUBLE * total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
  / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS lvl
  FROM w),
g AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(w::DOUBLE *
    max(CASE WHEN w * lvl <= cap THEN lvl END) OVER (), cap::DOUBLE)) AS target FROM l),
t AS (SELECT d.doc_id, d.size, g.source_size, g.target, floor(g.target)::BIGINT AS budget,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size > 0 THEN (budget // source_size) * size
     + least(greatest(budget % source_size - before, 0), size) ELSE 0 END)::BIGINT AS taken FROM t""",
    "op6_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, unnest([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, greatest(len(ws) - 4, 1) + 1)])
    AS gram FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS class_id FROM r GROUP BY a),
k AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT d.doc_id, m.class_id, coalesce(k.n_links, 0)::BIGINT AS n_links
FROM documents d JOIN m ON m.a = d.doc_id LEFT JOIN k ON k.a = d.doc_id""",
    "op11_centroid_clustering": r"""
WITH e AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
k AS (SELECT r, vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM e),
h AS (SELECT v, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, 'null')), v) - 1 AS c FROM k),
c0 AS (SELECT c, v AS x FROM h WHERE c < 16),""" + "".join(
        _ROUND.format(i=i) + _MOVE.format(i=i, j=i + 1) for i in range(3)) + _ROUND.format(i=3) + r"""
t AS (SELECT m.c AS c, sum(m.d)::BIGINT AS own FROM a3 GROUP BY 1)
SELECT vec_id, m.c::INTEGER AS cluster, m.d AS distance, own AS cluster_inertia,
  (SELECT sum(own) FROM t)::BIGINT AS inertia,
  sha256(array_to_string([i::VARCHAR FOR i IN c3.x], ',')) AS centroid_sha256
FROM a3 JOIN t ON t.c = a3.m.c JOIN c3 ON c3.c = a3.m.c""",
    "op12_filter_audit": r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(ws) < 200)::INTEGER + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INTEGER
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INTEGER
    + 8 * regexp_matches(text, '[#$%&*|]')::INTEGER
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INTEGER AS mask
  FROM d LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
o(word, used) AS (SELECT '', 0 UNION ALL
  SELECT word || f, used + b FROM o, (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) x(f, b) WHERE used & b = 0),
w AS (SELECT word AS filter_order, i::INTEGER AS step, substr(word, i, 1) AS f,
    1 << (ascii(substr(word, i, 1)) - 65) AS bit,
    list_sum([0] || [1 << (ascii(substr(word, j, 1)) - 65) FOR j IN range(1, i)])::INTEGER AS gone
  FROM o, range(1, 6) t(i) WHERE length(word) = 5),
s AS (SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (mask & (gone | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & gone = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & gone <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & gone = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & gone = 0), 0)::BIGINT AS toxic_lost
  FROM c CROSS JOIN w GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM s""",
    "op10_url_filter": r"""
WITH rules(rh, rp, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (SELECT row_number() OVER () AS i, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
f AS (SELECT i, arg_max(rh || rp, (length(rh) + length(rp)) * 1000 + length(rh)) AS rule,
    arg_max(v, (length(rh) + length(rp)) * 1000 + length(rh)) AS verdict
  FROM u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY i)
SELECT page_id, host, path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM u LEFT JOIN f USING (i)""",
}
