"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import (decontam, html, licenses, minhash, mixing, periodic, quality, resampling, secrets, sharding,
                            substrings, topk, urls)


def _read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def op1_minhash_near_dedup(spark, sf_dir):
    return minhash.near_dups(_read(spark, sf_dir, "documents", "doc_id", "text"), shingle=2)


def op2_secret_scan(spark, sf_dir):
    return secrets.scan(_read(spark, sf_dir, "documents", "doc_id", "text"),
                        _read(spark, sf_dir, "labels", "doc_id", "quality")).drop("found")


def op3_license_scan(spark, sf_dir):
    return licenses.scan(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op4_substring_dedup(spark, sf_dir):
    return substrings.repeats(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op5_html_text(spark, sf_dir):
    return html.main_text(_read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op6_quality_rules(spark, sf_dir):
    judged = quality.assess(_read(spark, sf_dir, "documents", "doc_id", "text"),
                            _read(spark, sf_dir, "labels", "doc_id", "quality"))
    return judged.select("row.doc_id", "word_chars", "n_symbols", "n_dup_lines", "j.*")


def op7_sharding(spark, sf_dir):
    return sharding.shard(_read(spark, sf_dir, "documents", "doc_id", "text"), 16)


def op8_decontamination(spark, sf_dir):
    return decontam.contaminated(_read(spark, sf_dir, "documents", "doc_id", "text"),
                                 _read(spark, sf_dir, "benchmark", "item_id", "text"))


def op9_mixing(spark, sf_dir):
    return mixing.mix(_read(spark, sf_dir, "documents", "doc_id", "text", "source")).drop("source")


def op10_url_filter(spark, sf_dir):
    return urls.judge(_read(spark, sf_dir, "pages", "page_id", "url"))


def op11_importance_resampling(spark, sf_dir):
    return resampling.resample(_read(spark, sf_dir, "documents", "doc_id", "text"),
                               _read(spark, sf_dir, "benchmark", "text"))


def op12_exact_top_k(spark, sf_dir):
    return topk.top_k(_read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20)


def op13_periodic_runs(spark, sf_dir):
    found = periodic.find_runs(_read(spark, sf_dir, "documents", "doc_id", "text"), rewrite=periodic.planted_tail)
    return found.drop("n_words", "runs")


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_secret_scan, op3_license_scan, op4_substring_dedup, op5_html_text, op6_quality_rules,
    op7_sharding, op8_decontamination, op9_mixing, op10_url_filter, op11_importance_resampling, op12_exact_top_k,
    op13_periodic_runs, pipeline)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    # every pair that shares a shingle, exact Jaccard, then reachability
    "op1_minhash_near_dedup": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_in AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM both_in JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 80 * (a.n + b.n - i)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y),
low AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, low.component_id, d.doc_id = low.component_id AS kept
FROM documents d JOIN low ON low.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op10_url_filter": r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS u FROM pages),
q AS (
  SELECT page_id,
    translate(regexp_extract(u, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(u, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM p),
r(rule, verdict, rh, rp) AS (VALUES
  ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
  ('www.example.com/en/', 'allow', 'www.example.com', '/en/'), ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')),
hit AS (
  SELECT page_id, host, path, rule, verdict, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule) DESC, rule) AS k
  FROM q JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT q.page_id, q.host, q.path, hit.rule,
  coalesce(hit.verdict, CASE WHEN regexp_matches(q.host || q.path,
    '(^|[.-])(cheap-(pills|meds|viagra)|(online-)?casino|adult-(chat|video|content)|free-(money|porn|spins))([.-]|$|/)|/wp-login\.php$')
    THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN hit ON hit.k = 1 AND hit.page_id = q.page_id AND hit.host = q.host AND hit.path = q.path""",
    # CRC-32 by half bytes over the distinct features
    "op11_importance_resampling": rf"""
WITH d AS (
  SELECT row_number() OVER () AS u, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT row_number() OVER () AS u, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
fd AS (
  SELECT u, unnest(w || CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE [] END) AS f FROM d),
fb AS (
  SELECT u, unnest(w || CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE [] END) AS f FROM b),
nib AS (
  SELECT f, [4294967295::BIGINT] || flatten(list_transform(range(1, length(hex(encode(f))), 2),
    lambda i: [instr('123456789ABCDEF', hex(encode(f))[i + 1])::BIGINT, instr('123456789ABCDEF', hex(encode(f))[i])::BIGINT])) AS x
  FROM (SELECT f FROM fd UNION SELECT f FROM fb)),
k AS (
  SELECT f, xor(list_reduce(x, lambda r, y: xor(r >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
    3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][xor(r, y) % 16 + 1]::BIGINT)), 4294967295) % 10000 AS k FROM nib),
cs AS (SELECT k, count(*) AS s FROM fd JOIN k USING (f) GROUP BY k),
ct AS (SELECT k, count(*) AS t FROM fb JOIN k USING (f) GROUP BY k),
g AS (
  SELECT k, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (coalesce((SELECT sum(s) FROM cs), 0) + 10000)
    / ((s + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM ct), 0) + 10000))))::BIGINT AS g FROM cs LEFT JOIN ct USING (k)),
m AS (SELECT u, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM fd JOIN k USING (f) JOIN g USING (k) GROUP BY u),
e AS (
  SELECT d.u, doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN m USING (u)),
o AS (SELECT u, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS r, count(*) OVER () AS n FROM e WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 25 * n // 100 THEN r END AS rank FROM e LEFT JOIN o USING (u)""",
    # every product of a query and a candidate
    "op12_exact_top_k": r"""
WITH v AS (
  SELECT row_number() OVER () AS u, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(64 * x::DOUBLE))) = 0),
p AS (
  SELECT q.u, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.u <> c.u),
r AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
