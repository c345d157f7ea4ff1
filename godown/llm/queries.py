"""``opN_<name>``: each operator, with production parameters, over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import functions as F

from godown.llm.common import crc_mod, table

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tokenizer_file(name: str) -> str:
    """A public vocabulary file; GODOWN_TOKENIZERS names another folder."""
    folder = os.environ.get("GODOWN_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return str(public_tokenizers.path(name))


URL_SQL = r"""
WITH RECURSIVE u AS (
  SELECT page_id, url, html,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 2, 's') AS path,
         regexp_replace(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?', 3, 's'), '^\?', '') AS query
  FROM pages),
k AS (
  SELECT *, list_aggregate(list_filter(string_split(query, '&'), lambda x: NOT regexp_matches(x, '^(utm_[^=]*|ref)(=|$)')), 'string_agg', '&') AS kept,
         CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
              WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM u),
j AS (
  SELECT page_id, url, html, host, path, rule,
         CASE rule WHEN 'com/' THEN 'allow' WHEN 'www.example.com/en/' THEN 'allow' WHEN 'example.com/en/' THEN 'block'
                   WHEN 'net/es/' THEN 'block' WHEN 'net/fr/' THEN 'block' END AS own,
         CASE WHEN contains(url, '://') THEN regexp_replace(host, '^(www|m)\.', '') || path
              || CASE WHEN coalesce(kept, '') != '' THEN '?' || kept ELSE '' END END AS key
  FROM k),
link AS (
  SELECT j.key AS a, t.key AS b FROM j
  JOIN j t ON t.url = regexp_extract(j.html, '<link[^>]*rel="canonical"[^>]*href="([^"]+)"', 1) AND j.key != t.key),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(node, other) AS (
  SELECT key, key FROM j WHERE key IS NOT NULL
  UNION SELECT r.node, e.b FROM reach r JOIN edge e ON e.a = r.other),
root AS (SELECT node, min(other) AS root FROM reach GROUP BY node),
fate AS (
  SELECT root.root, max(coalesce(j.own = 'allow', false)) AS allowed, max(coalesce(j.own = 'block', false)) AS blocked
  FROM j JOIN root ON root.node = j.key GROUP BY root.root)
SELECT j.page_id, j.host, j.path, j.rule,
       coalesce(j.own, CASE WHEN fate.blocked AND NOT fate.allowed THEN 'block' ELSE 'allow' END) AS verdict,
       root.root AS alias_of
FROM j LEFT JOIN root ON root.node = j.key LEFT JOIN fate ON fate.root = root.root
"""


@query("op1_url_redirects", URL_SQL)
def op1(spark, sf_dir):
    from godown.llm.url_filter import judge
    return judge(table(spark, sf_dir, "pages"))


@query("op2_subword_quality")
def op2(spark, sf_dir):
    from godown.llm import subword_quality as m
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = m.train(docs, labels.where(crc_mod("doc_id", 4) != 2))
    return (m.score(docs, model).withColumn("held_out", crc_mod("doc_id", 4) == 2)
            .withColumn("predicted", (F.col("score") >= 0.7).cast("int")).select("doc_id", "held_out", "score", "predicted"))


@query("op3_ppm_language")
def op3(spark, sf_dir):
    from godown.llm import ppm_language as m
    docs = table(spark, sf_dir, "documents")
    model = m.train(docs.where(crc_mod("doc_id", 5) != 0))
    return (m.identify(docs, model).withColumn("held_out", crc_mod("doc_id", 5) == 0)
            .select("doc_id", "held_out", "lang_pred", "score", "bits"))


@query("op4_sentencepiece_chunks")
def op4(spark, sf_dir):
    from godown.llm.sentencepiece_chunks import encode_digests
    return encode_digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query("op5_best_fit_packing")
def op5(spark, sf_dir):
    from godown.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@query("op6_toxic_segments")
def op6(spark, sf_dir):
    from godown.llm import toxic_segments as m
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = m.train(docs, labels.where(crc_mod("doc_id", 5) != 0))
    return (m.score(docs, model).withColumn("held_out", crc_mod("doc_id", 5) == 0)
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
            .select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages")))


@query("op7_imatch")
def op7(spark, sf_dir):
    from godown.llm.imatch import edited_fingerprints, lexicons
    docs = table(spark, sf_dir, "documents")
    return edited_fingerprints(docs, lexicons(docs))


SUBSTRING_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(ws[i:i + 12], ' '))) AS k
        FROM w WHERE len(ws) >= 13),
f AS (SELECT k, min(doc_id) AS first_id FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM win JOIN f USING (k) WHERE first_id < doc_id),
one AS (SELECT doc_id, unnest(ws) AS t, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (SELECT doc_id, string_agg(t, ' ' ORDER BY j) AS kept, count(*) AS n FROM one ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@query("op8_fm_substring", SUBSTRING_SQL)
def op8(spark, sf_dir):
    from godown.llm.substring_dedup import dedup_substrings
    return dedup_substrings(table(spark, sf_dir, "documents")).drop("kept")


JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
           WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
           ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id != y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach(node, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, l.b FROM reach r JOIN link l ON l.a = r.other),
root AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, root.component_id FROM documents d
LEFT JOIN n USING (doc_id) JOIN root ON root.node = d.doc_id
"""


@query("op9_jaccard_skip", JACCARD_SQL)
def op9(spark, sf_dir):
    from godown.llm.jaccard_join import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


DEDUP_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256 FROM n JOIN g USING (t)
"""


@query("op10_stream_dedup", DEDUP_SQL)
def op10(spark, sf_dir):
    from godown.llm.exact_dedup import exact_dedup
    return (exact_dedup(table(spark, sf_dir, "documents"))
            .select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")))


NEGATIVE_SQL = r"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0)))::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id != b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INT AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""


@query("op11_lemp_negatives", NEGATIVE_SQL)
def op11(spark, sf_dir):
    from godown.llm.common import written
    from godown.llm.hard_negatives import hard_negatives, integer_rows
    rows = written(integer_rows(table(spark, sf_dir, "embeddings"), relabel=lambda i, c: F.when(i % 7 == 0, (c + 1) % 10).otherwise(c)),
                   "negative_rows")
    return hard_negatives(rows, rows.where("vec_id % 100 = 0"))


@query("op13_lyndon_runs")
def op13(spark, sf_dir):
    from godown.llm.periodic_runs import longest, periodic_runs
    got = periodic_runs(planted_repeats(table(spark, sf_dir, "documents")))
    top = longest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return got.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("top.length * 1000 div top.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def planted_repeats(docs):
    """(doc_id, text): where crc32(doc_id) % 10 = 0, each word i >= a becomes word a + (i - a) % p; else the text as it is."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).cast("long").alias("g"),
                         F.when(h % 10 == 0, words).alias("w"))
    n = F.size("w").cast("long")
    a = F.expr("g % n")
    chosen = chosen.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, a))
    chosen = chosen.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.concat_ws(" ", F.transform(F.expr("sequence(0L, n - 1)"), lambda i: F.expr("w")[
        F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")]))
    return chosen.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), repeated).otherwise(F.col("text")).alias("text"))


@query("op12_wrapper_text")
def op12(spark, sf_dir):
    from godown.llm.html_wrappers import main_text
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
