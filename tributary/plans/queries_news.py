"""News queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tributary.functions import (clean_author, concat_blank, first_image_link, first_present, strip_tags_preview,
                                 summary_cut, text_after_marker, tolerant_date)
from tributary.operators import html as H
from tributary.operators.similarity import append_related, approx_related, related_top_k
from tributary.plans import news as N
from tributary.plans.catalog import query, table
from tributary.session import checkpoint_dir

_ART = """
arts AS (SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, text AS content, source, lang,
                TIMESTAMP '2024-01-01 00:00:00' + to_hours(doc_id) AS published_at FROM documents),
res AS (SELECT doc_id AS id,
               CASE WHEN quality = 1 THEN 'zh-title-' || CAST(doc_id AS VARCHAR) ELSE 'null' END AS title_result,
               CASE WHEN toxic = 0 THEN 'zh-content-' || CAST(doc_id AS VARCHAR) ELSE 'null' END AS content_result
        FROM labels),
st AS (
  SELECT a.*, r.title_result, r.content_result,
         CASE WHEN coalesce(length(title_result), 0) > 0 AND coalesce(length(content_result), 0) > 0 THEN 'translated'
              WHEN title_result = 'null' THEN 'title failed'
              WHEN content_result = 'null' THEN 'content failed' ELSE 'All failed' END AS translation_status,
         CASE WHEN title_result <> 'null' THEN title_result END AS title_zh,
         CASE WHEN content_result <> 'null' THEN content_result END AS content_zh
  FROM arts a LEFT JOIN res r USING (id))"""


def _st(spark, sf):
    return N.with_status(N.articles(table(spark, sf, "documents")), N.translation_results(table(spark, sf, "labels")))


@query("link_dedup", sql="""
WITH s AS (SELECT page_id, url, 0 AS src FROM pages UNION ALL
           SELECT page_id, CASE WHEN url LIKE '%#top' THEN '' ELSE url END, 1 FROM pages)
SELECT url, page_id, src FROM s WHERE url IS NOT NULL AND length(url) > 0
QUALIFY row_number() OVER (PARTITION BY url ORDER BY src, page_id) = 1""")
def link_dedup(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    s = p.withColumn("src", F.lit(0)).unionByName(
        p.withColumn("url", F.when(F.col("url").endswith("#top"), F.lit("")).otherwise(F.col("url")))
         .withColumn("src", F.lit(1)))
    return N.link_dedup(s, "url", ["src", "page_id"])


@query("preview", sql="""
SELECT page_id, substr(regexp_replace(html, '<[^>]*>?', '', 'g'), 1, 100) || '...' AS preview FROM pages""")
def preview(spark, sf):
    return table(spark, sf, "pages").select("page_id", strip_tags_preview("html").alias("preview"))


@query("summary_cut", sql="""
WITH d AS (SELECT doc_id, replace(text, chr(10), '...') AS s FROM documents)
SELECT doc_id, CASE WHEN strpos(s, '...') > 0 THEN split_part(s, '...', 1) || '...' ELSE s END AS summary FROM d""")
def summary_cut_q(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.replace(F.col("text"), F.lit("\n"), F.lit("...")).alias("s"))
    return d.select("doc_id", summary_cut("s").alias("summary"))


@query("result_text", sql="""
WITH d AS (SELECT doc_id, CASE WHEN lang = 'en' THEN 'Answer. Result: ' || text ELSE text END AS s FROM documents)
SELECT doc_id, CASE WHEN strpos(s, 'Result:') > 0 THEN trim(substr(s, strpos(s, 'Result:') + 7)) END AS result
FROM d""")
def result_text(spark, sf):
    d = table(spark, sf, "documents")
    s = F.when(F.col("lang") == "en", F.concat(F.lit("Answer. Result: "), F.col("text"))).otherwise(F.col("text"))
    return d.select("doc_id", text_after_marker(s).alias("result"))


@query("author_clean", sql="""
WITH d AS (SELECT doc_id, split_part(text, ' ', 1) || upper(substr(split_part(text, ' ', 2), 1, 1))
                         || substr(split_part(text, ' ', 2), 2) || ' Apr 3, 2024' AS raw
           FROM documents)
SELECT doc_id, trim(regexp_replace(regexp_replace(raw, '(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec).*', ''),
                                   '([a-z])([A-Z])', '\\1, \\2', 'g')) AS author FROM d""")
def author_clean(spark, sf):
    d = table(spark, sf, "documents")
    w2 = F.split_part(F.col("text"), F.lit(" "), F.lit(2))
    raw = F.concat(F.split_part(F.col("text"), F.lit(" "), F.lit(1)), F.upper(F.substring(w2, 1, 1)),
                   F.substring(w2, 2, 1 << 30), F.lit(" Apr 3, 2024"))
    return d.select("doc_id", clean_author(raw).alias("author"))


@query("first_source", sql=f"""WITH {_ART}
SELECT id, coalesce(CASE WHEN length(CASE WHEN lang = 'en' THEN source END) > 0 THEN source END,
                    CASE WHEN length('page-' || CAST(id AS VARCHAR)) > 0 THEN 'page-' || CAST(id AS VARCHAR) END) AS author,
       title || ' ' || source AS headline
FROM arts""")
def first_source(spark, sf):
    a = N.articles(table(spark, sf, "documents"))
    feed = F.when(F.col("lang") == "en", F.col("source"))
    pg = F.concat(F.lit("page-"), F.col("id").cast("string"))
    return a.select("id", first_present(feed, pg).alias("author"), concat_blank("title", "source").alias("headline"))


@query("publish_window", sql="""
SELECT event_id, ts FROM events
WHERE ts >= CAST(TRY_CAST('2024-01-20' AS DATE) - INTERVAL 7 DAY AS TIMESTAMP)
  AND ts <= CAST(TRY_CAST('2024-01-20' AS DATE) AS TIMESTAMP)""")
def publish_window(spark, sf):
    as_of = tolerant_date(F.lit("2024-01-20"))
    lo, hi = F.date_sub(as_of, 7).cast("timestamp_ntz"), as_of.cast("timestamp_ntz")
    return table(spark, sf, "events").filter(F.col("ts").between(lo, hi)).select("event_id", "ts")


@query("queue_status", sql=f"WITH {_ART} SELECT id, translation_status, title_zh, content_zh FROM st")
def queue_status(spark, sf):
    return _st(spark, sf).select("id", "translation_status", "title_zh", "content_zh")


@query("work_queue", sql=f"WITH {_ART} SELECT id FROM st WHERE title_zh IS NULL OR content_zh IS NULL")
def work_queue(spark, sf):
    return N.work_queue(_st(spark, sf)).select("id")


@query("status_tally", sql=f"""WITH {_ART}
SELECT translation_status, CAST(count(*) AS BIGINT) AS n FROM st GROUP BY 1""")
def status_tally(spark, sf):
    return _st(spark, sf).groupBy("translation_status").agg(F.count(F.lit(1)).alias("n"))


@query("edit_status", sql=f"""WITH {_ART}
SELECT id, CASE WHEN coalesce(length(content_zh), 0) = 0 THEN NULL
                WHEN lang = 'de' THEN 'didNothing'
                WHEN strpos(CASE WHEN lang = 'fr' THEN 'Skilled' ELSE content_zh END, 'Skilled') > 0 THEN 'skilled'
                ELSE 'edited' END AS edit_status
FROM st""")
def edit_status(spark, sf):
    s = _st(spark, sf)
    result = F.when(F.col("lang") == "de", F.lit(N.TIMEOUT)).when(F.col("lang") == "fr", F.lit("Skilled")) \
              .otherwise(F.col("content_zh"))
    return s.select("id", N.edit_status(F.col("content_zh"), result).alias("edit_status"))


@query("search", sql=f"""WITH {_ART}
SELECT id, title, published_at FROM st
WHERE translation_status = 'translated' AND (title ILIKE '%ation%' ESCAPE '\\' OR content ILIKE '%ation%' ESCAPE '\\')
ORDER BY published_at DESC, id DESC LIMIT 10""")
def search(spark, sf):
    return N.search(_st(spark, sf), "ation").select("id", "title", "published_at")


@query("page", sql=f"""WITH {_ART}
SELECT id, title, published_at FROM st WHERE translation_status = 'translated'
ORDER BY published_at DESC, id DESC LIMIT 20 OFFSET 40""")
def page_q(spark, sf):
    return N.page(_st(spark, sf), 3, 20).select("id", "title", "published_at")


@query("page_count", sql="""
SELECT CAST(count(*) AS BIGINT) AS total_count, CAST(ceil(count(*) / 20.0) AS BIGINT) AS page_count FROM documents""")
def page_count_q(spark, sf):
    return N.page_count(table(spark, sf, "documents"))


@query("unprocessed", sql="""
SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def unprocessed(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return d.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")


_REL_SQL = """
e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT a.vec_id AS news_id, b.vec_id AS related_news_id, list_cosine_similarity(a.v, b.v) AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
rel AS (SELECT news_id, related_news_id, round_even(score, 4) AS score FROM s WHERE score >= 0.2
        QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY score DESC, related_news_id) <= 5)"""


@query("related_top5", sql=f"WITH {_REL_SQL} SELECT * FROM rel")
def related_top5(spark, sf):
    return related_top_k(table(spark, sf, "embeddings"), "vec_id", "embedding")


@query("related_incremental", sql="""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT a.vec_id AS news_id, b.vec_id AS related_news_id, list_cosine_similarity(a.v, b.v) AS score,
             a.label < 5 AND b.label < 5 AS early FROM e a JOIN e b ON a.vec_id <> b.vec_id),
r1 AS (SELECT news_id, related_news_id, round_even(score, 4) AS score FROM s WHERE early AND score >= 0.2
       QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY s.score DESC, related_news_id) <= 5),
r2 AS (SELECT news_id, related_news_id, round_even(score, 4) AS score FROM s
       WHERE score >= 0.2 AND news_id NOT IN (SELECT news_id FROM r1)
       QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY s.score DESC, related_news_id) <= 5)
SELECT * FROM r1 UNION ALL SELECT * FROM r2""")
def related_incremental(spark, sf):
    """C6/N6 as the news job runs: a first load of some articles (half of the
    labels), then all, where only ids without related rows are looked up; a third
    run changes nothing."""
    e = table(spark, sf, "embeddings")
    path = f"{checkpoint_dir(spark).rstrip('/')}/related/{uuid.uuid4().hex}"
    for vectors in (e.filter(F.col("label") < 5), e, e):
        t = append_related(vectors, "vec_id", "embedding", path)
    return t.read()


@query("detail_related", sql=f"""WITH {_REL_SQL}, {_ART}
SELECT news_id, related_news_id, title, published_at FROM rel JOIN arts ON arts.id = rel.related_news_id
QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY published_at DESC, related_news_id DESC) <= 6""")
def detail_related(spark, sf):
    rel = related_top_k(table(spark, sf, "embeddings"), "vec_id", "embedding")
    arts = N.articles(table(spark, sf, "documents")).select("id", "title", "published_at")
    return N.related_details(rel, arts).select("news_id", "related_news_id", "title", "published_at")


@query("clean_pages")
def clean_pages(spark, sf):
    return H.clean_pages(table(spark, sf, "pages")).select("page_id", "url", "content", "translation_status")


# The driver's pages stand for one more source whose container is the
# ``article`` element (metadata rule on, to exercise it).
PAGE_CONTAINER = [("page", "article", None, None, True)]


@query("extract_text")
def extract_text(spark, sf):
    p = table(spark, sf, "pages").withColumn("source", F.lit("page"))
    c = spark.createDataFrame(N.SOURCE_CONTAINERS + PAGE_CONTAINER, N.CONTAINER_SCHEMA)
    return H.extract_text(p, c).select("page_id", "content")


@query("image_link", sql="""
SELECT page_id, coalesce(CASE WHEN url LIKE '%#top' THEN url || '#thumb' END, url || '.png') AS image_url FROM pages""")
def image_link(spark, sf):
    """Thumbnail when present, else the first link typed ``image/``."""
    p = table(spark, sf, "pages")
    links = F.array(F.struct(F.lit("text/html").alias("type"), F.col("url").alias("href")),
                    F.struct(F.lit("image/png").alias("type"), F.concat("url", F.lit(".png")).alias("href")),
                    F.struct(F.lit("image/jpeg").alias("type"), F.concat("url", F.lit(".jpg")).alias("href")))
    thumb = F.when(F.col("url").endswith("#top"), F.concat("url", F.lit("#thumb")))
    return p.select("page_id", F.coalesce(thumb, first_image_link(links)).alias("image_url"))


@query("related_top5_approx")
def related_top5_approx(spark, sf):
    """C6 at scale: LSH candidates scored exactly (approximate recall; the
    exact query is ``related_top5``)."""
    return approx_related(table(spark, sf, "embeddings"), "vec_id", "embedding")


@query("edit_queue", sql=f"""WITH {_ART},
e AS (SELECT *, CASE WHEN lang IN ('de', 'fr') THEN 'edited' END AS content_status FROM st)
SELECT id, translation_status FROM e WHERE translation_status = 'translated' AND content_status IS NULL""")
def edit_queue(spark, sf):
    """The content-editing queue (rows already edited carry a status)."""
    s = _st(spark, sf).withColumn("content_status",
                                  F.when(F.col("lang").isin("de", "fr"), F.lit(N.EDITED)))
    return N.status_queue(s, "content_status").select("id", "translation_status")


@query("page_seek", sql=f"""WITH {_ART}
SELECT id, title, published_at FROM st WHERE translation_status = 'translated'
ORDER BY published_at DESC, id DESC LIMIT 20 OFFSET 40""")
def page_seek(spark, sf):
    """Page 3 from the table of numbered pages, equal to the offset form."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/pages/{uuid.uuid4().hex}"
    N.write_pages(_st(spark, sf).select("id", "title", "published_at", "translation_status"), path, 20)
    return N.read_page(spark, path, 3).select("id", "title", "published_at")


@query("page_listing", sql=f"""WITH {_ART}
SELECT id, CAST((row_number() OVER (ORDER BY published_at DESC, id DESC) - 1) // 20 + 1 AS BIGINT) AS page_no
FROM st WHERE translation_status = 'translated'""")
def page_listing(spark, sf):
    """Every translated row with its page."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/pages/{uuid.uuid4().hex}"
    N.write_pages(_st(spark, sf).select("id", "published_at", "translation_status"), path, 20)
    return spark.read.parquet(path).select("id", "page_no")
