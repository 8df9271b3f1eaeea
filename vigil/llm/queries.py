"""The package's registered queries: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import (balltree, decontaminate, divergence, exact_dedup, hard_negatives, html_text, langid, mixing, neardup, substring, toxicity,
                       wavelet, word_lm)
from vigil.llm.scratch import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learn = docs.filter(~langid.held_out(F.col("doc_id")))
    out = langid.identify(docs, learn, carry=["doc_id"])
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_lm.score(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    wavelet.write_shards(table(spark, sf_dir, "documents"), path, tokenizer=tokenizer_path(), end_id=2, added_tokens=True)
    return wavelet.read_documents(spark, path)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), window=50)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label, scale=256.0)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"), min_docs=30)


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_html_extraction": op2_html_extraction,
    "op3_decontamination": op3_decontamination,
    "op4_toxicity": op4_toxicity,
    "op5_language_id": op5_language_id,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_topk_search": op7_topk_search,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_token_output": op9_token_output,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE: dict[str, str] = {
    "op1_mixing": """
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
t AS (SELECT sum(sqrt(n::DOUBLE)) AS w, sum(n) AS n FROM n),
r AS (SELECT n.source, sqrt(n.n::DOUBLE) / t.w * t.n::DOUBLE / n.n AS mean FROM n, t),
q AS (SELECT source, greatest(ceil(mean / 32.0), 1)::INTEGER AS parts, mean / greatest(ceil(mean / 32.0), 1) AS m FROM r),
p AS (SELECT source, parts, k, exp(k * ln(m) - m - lgamma(k + 1)) AS p FROM q, range(0, 121) AS s(k)),
c AS (SELECT source, parts, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM p),
f AS (SELECT source, parts, list(c ORDER BY k) AS cdf FROM c GROUP BY source, parts),
d AS (SELECT d.*, i.i, f.cdf,
        ('0x' || substr(md5('17:' || coalesce(d.doc_id::VARCHAR, '') || ':' || i.i::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0 AS u
      FROM documents d JOIN f ON d.source IS NOT DISTINCT FROM f.source, LATERAL (SELECT unnest(range(1, f.parts + 1)) AS i) i),
e AS (SELECT doc_id, text, lang, source, n_chars, sum(len(list_filter(cdf, lambda x: x <= u)))::BIGINT AS n
      FROM d GROUP BY doc_id, text, lang, source, n_chars)
SELECT doc_id, text, lang, source, n_chars, unnest(range(1, n + 1))::INTEGER AS copy FROM e""",
    "op3_decontamination": r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM bw WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM win),
run AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, ns WHERE len(w) >= n)),
hit AS (SELECT run.doc_id, run.n, run.i, win.item_id FROM run JOIN win USING (n, s)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hit)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op7_topk_search": """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op11_exact_dedup": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.text) AS text_sha256 FROM d JOIN g USING (text)""",
    "op12_hard_negatives": """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM whole a JOIN whole c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id AND len(a.v) = len(c.v)
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth
  FROM scored WHERE alike
), negative AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike AND p.nth <= 5
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 3""",
    "op13_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), w AS (SELECT row, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
lang AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY w.lang, w.source, w.term),
tot AS (SELECT grp.lang, grp.source, coalesce(sum(cnt.n), 0) AS n FROM grp LEFT JOIN cnt USING (lang, source) GROUP BY grp.lang, grp.source),
full_p AS (
  SELECT tot.lang, tot.source, kept.term, coalesce(cnt.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(cnt.n, 0) + 5)) // (tot.n + 5 * lang.v) AS p,
         1 + (1000000000::HUGEINT * (kept.total + 5)) // (lang.n + 5 * lang.v) AS q
  FROM tot JOIN lang USING (lang) JOIN kept USING (lang) LEFT JOIN cnt ON cnt.lang = tot.lang AND cnt.source = tot.source AND cnt.term = kept.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM full_p a JOIN full_p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), every_pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
), term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM full_p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM every_pair UNION ALL SELECT * FROM term)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50""",
}
