"""The registered queries, one for each operator, over whole tables, and the
DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import (bpe, collocations, decontamination, graph_search, hard_negatives, html_text, line_rules, quality, simhash,
                           suffix_dedup, token_files, toxicity, url_filter)
from tributary.llm.common import read_table
from tributary.llm.url_filter import Rule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
RULES = [Rule("org", "/", True), Rule("example.org", "/es/", False), Rule("example.org", "/en/1", False),
         Rule("com", "/fr/", True), Rule("com", "/de/", False)]


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return register


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@query("op1_decontamination", rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
        FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
spots AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT a.* FROM spots a SEMI JOIN win USING (n, s)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
found AS (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits JOIN win USING (n, s)),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM found GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


@query("op5_url_filter", r"""
WITH RECURSIVE rules(host, path, allow) AS (VALUES ('org', '/', true), ('example.org', '/es/', false), ('example.org', '/en/1', false),
                                                   ('com', '/fr/', true), ('com', '/de/', false)),
tags AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\s[^>]*\b(?:canonical|refresh)\b[^>]*>')) AS tag
         FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
targets AS (SELECT url, CASE WHEN regexp_matches(tag, '(?is)rel\s*=\s*["'']?canonical')
                             THEN regexp_extract(tag, '(?is)\shref\s*=\s*["'']?([^"''\s>]+)', 1)
                             ELSE regexp_extract(tag, '(?is)url\s*=\s*["'']?([^"''\s>]+)', 1) END AS target FROM tags),
edges AS (SELECT regexp_replace(url, '(?s)#.*$', '') AS a,
                 regexp_replace(CASE WHEN starts_with(target, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || target ELSE target END,
                                '(?s)#.*$', '') AS b FROM targets WHERE contains(url, '://')),
linked AS (SELECT a, b FROM edges WHERE contains(b, '://') UNION SELECT b, a FROM edges WHERE contains(b, '://')),
reach(a, b) AS (SELECT a, a FROM linked UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a),
urls AS (SELECT DISTINCT url FROM pages UNION SELECT DISTINCT a FROM linked),
parts AS (SELECT url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM urls),
judged AS (SELECT p.url, p.host, p.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.allow, length(r.host || r.path)) AS allow
           FROM parts p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
           GROUP BY ALL),
bad AS (SELECT DISTINCT r.a AS node FROM reach r JOIN judged j ON j.url = r.b WHERE NOT j.allow)
SELECT page_id, host, path, rule, CASE WHEN coalesce(allow, node IS NULL) THEN 'allow' ELSE 'block' END AS verdict
FROM pages LEFT JOIN judged ON pages.url IS NOT DISTINCT FROM judged.url
LEFT JOIN bad ON regexp_replace(pages.url, '(?s)#.*$', '') = bad.node
""")
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op6_main_text")
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


@query("op7_suffix_dedup", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
s AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM d, unnest(range(0, n - 49)) AS t(i)),
least_doc AS (SELECT s, min(doc_id) AS m FROM s GROUP BY s HAVING min(doc_id) < max(doc_id)),
bad AS (SELECT doc_id, i, lag(i) OVER w AS before, lead(i) OVER w AS after FROM s JOIN least_doc USING (s) WHERE m < doc_id
        WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
counts AS (SELECT doc_id, sum(least(50, coalesce(after - i, 50))) AS n_removed, count(*) FILTER (before IS NULL OR i > before + 50) AS n_spans
           FROM bad GROUP BY doc_id),
gaps AS (SELECT doc_id, coalesce(before + 50, 0) AS a, i AS b FROM bad WHERE before IS NULL OR i > before + 50
         UNION ALL SELECT doc_id, i + 50, n FROM bad JOIN d USING (doc_id) WHERE after IS NULL),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
""")
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(read_table(spark, sf_dir, "documents"))


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, distance=4)


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN,
                               added=True)


@query("op10_graph_search")
def op10_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(read_table(spark, sf_dir, "embeddings"), k=5, every=50)


@query("op11_collocations", r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS s FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM p),
f AS MATERIALIZED (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
                   FROM w, (VALUES (1), (2), (3)) AS s(m), unnest(range(1, len(w) - m + 2)) AS t(i) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 10),
cuts AS (SELECT c.lang, c.phrase, c.m, a, k, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
         FROM c, unnest(range(1, c.m)) AS t(k), f x, f y
         WHERE x.lang = c.lang AND y.lang = c.lang AND x.phrase = array_to_string(c.w[:k], ' ') AND y.phrase = array_to_string(c.w[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
hidden AS (SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS longer FROM c, unnest(range(1, m)) AS t(i) WHERE m = 3 GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM best LEFT JOIN hidden USING (lang, phrase) JOIN n USING (lang) WHERE longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000
""")
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read_table(spark, sf_dir, "documents"))


@query("op12_hard_negatives", """
WITH e AS (SELECT vec_id, label, embedding AS v FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(v, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM e),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
             list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
      FROM r a, r b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"), label)


@query("op13_line_rules")
def op13_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
