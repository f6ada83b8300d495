"""News tables.

Stand-ins: ``documents`` are articles (id = doc_id, title = first line,
content = text, published = 2024-01-01 + doc_id hours); ``labels`` carry
outcomes of the outside translation calls (quality = title translated,
toxic = content failed); ``pages`` are fetched pages; ``embeddings`` are
the article vectors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.functions import contains_ci
from tributary.session import cut_lineage

# Article container per news source (tag, attribute, value,
# metadata-paragraph removal), as configured for the crawler; the
# metadata rule is meant for the BBC layout only.
SOURCE_CONTAINERS = [
    ("Autosport", None, "class", "ms-article-content", False),
    ("BBC", None, "data-component", "text-block", True),
    ("Motorsport", None, "class", "ms-article-content", False),
    ("RaceFans", None, "class", "entry-content", False),
    ("Pitpass", None, "class", "KonaBody", False),
    ("F1 Technical News", None, "class", "content article", False),
    ("F1 Technical Articles", None, "class", "content article", False),
]
CONTAINER_SCHEMA = "source string, tag string, attr string, value string, drop_metadata boolean"

# Queue status words.
TRANSLATED, TITLE_FAILED, CONTENT_FAILED, ALL_FAILED = "translated", "title failed", "content failed", "All failed"
EDITED, SKILLED, DID_NOTHING = "edited", "skilled", "didNothing"
TIMEOUT = "TIMEOUT_ERROR"
FAILED_MARK = "null"


def articles(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").alias("id"),
        F.substring_index(F.col("text"), "\n", 1).alias("title"),
        F.col("text").alias("content"), "source", "lang",
        F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, CAST(doc_id AS INT), 0, 0)").alias("published_at"))


def translation_results(labels: DataFrame) -> DataFrame:
    """Outside-call outcomes as a table: translated text or the failure mark."""
    return labels.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("quality") == 1, F.concat(F.lit("zh-title-"), F.col("doc_id").cast("string")))
         .otherwise(F.lit(FAILED_MARK)).alias("title_result"),
        F.when(F.col("toxic") == 0, F.concat(F.lit("zh-content-"), F.col("doc_id").cast("string")))
         .otherwise(F.lit(FAILED_MARK)).alias("content_result"))


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (F.length(c) > 0)


def translation_status(title: Column, content: Column) -> Column:
    """Status from the two call results (a non-empty text is success,
    the literal failure mark included, as in the reference)."""
    return (F.when(_truthy(title) & _truthy(content), F.lit(TRANSLATED))
             .when(F.coalesce(title == FAILED_MARK, F.lit(False)), F.lit(TITLE_FAILED))
             .when(F.coalesce(content == FAILED_MARK, F.lit(False)), F.lit(CONTENT_FAILED))
             .otherwise(F.lit(ALL_FAILED)))


def edit_status(current: Column, result: Column) -> Column:
    """N5 (editing queue): didNothing on timeout or no answer, skilled when
    the answer says so, else edited; null when there was nothing to edit."""
    return (F.when(~_truthy(current), F.lit(None).cast("string"))
             .when(result.isNull() | (result == TIMEOUT), F.lit(DID_NOTHING))
             .when(F.instr(result, "Skilled") > 0, F.lit(SKILLED))
             .otherwise(F.lit(EDITED)))


def with_status(arts: DataFrame, results: DataFrame) -> DataFrame:
    """Articles with their translation columns and status (left join by id:
    an article without results has both results null)."""
    j = arts.join(results, on="id", how="left")
    return j.withColumn("translation_status", translation_status(F.col("title_result"), F.col("content_result"))) \
            .withColumn("title_zh", F.when(F.col("title_result") != FAILED_MARK, F.col("title_result"))) \
            .withColumn("content_zh", F.when(F.col("content_result") != FAILED_MARK, F.col("content_result")))


def work_queue(df: DataFrame) -> DataFrame:
    """Rows still missing a title or content translation."""
    return df.filter(F.col("title_zh").isNull() | F.col("content_zh").isNull())


def status_queue(df: DataFrame, status_col: str) -> DataFrame:
    """Translated rows whose editing status (content or title) is
    still null - the editing work queue."""
    return df.filter((F.col("translation_status") == TRANSLATED) & F.col(status_col).isNull())


def search(df: DataFrame, q: str, limit: int = 10) -> DataFrame:
    """Translated rows whose title or content contains ``q``
    (case-insensitive, literal), newest first.  One scan with OR replaces
    the reference's two queries and key merge."""
    hit = contains_ci("title", q) | contains_ci("content", q)
    return df.filter((F.col("translation_status") == TRANSLATED) & hit) \
             .orderBy(F.col("published_at").desc(), F.col("id").desc()).limit(limit)


def _check_size(size: int) -> None:
    if not 1 <= size <= 100:
        raise ValueError(f"page size {size} is not in 1..100")


def page(df: DataFrame, page_no: int, size: int = 20) -> DataFrame:
    """translated rows, newest first, rows (p-1)*s .. p*s-1 (s <= 100)."""
    _check_size(size)
    return df.filter(F.col("translation_status") == TRANSLATED) \
             .orderBy(F.col("published_at").desc(), F.col("id").desc()) \
             .offset((page_no - 1) * size).limit(size)


PUBLISHED_US = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', published_at)"


def page_after(df: DataFrame, after_us: int | None, after_id: int | None, size: int = 20) -> DataFrame:
    """F3 for deep pages: the ``size`` translated rows after the key
    (published_at as epoch microseconds - zone independent - and id) of
    the previous page's last row, newest first.  A filter on the key plus a
    top-k: the work does not grow with the page number, unlike an offset."""
    _check_size(size)
    d = df.filter(F.col("translation_status") == TRANSLATED).withColumn("page_key_us", F.expr(PUBLISHED_US))
    if after_us is not None:
        k, i = F.col("page_key_us"), F.lit(after_id)
        d = d.filter((k < F.lit(after_us)) | ((k == F.lit(after_us)) & (F.col("id") < i)))
    return d.orderBy(F.col("published_at").desc(), F.col("id").desc()).limit(size)


def write_pages(df: DataFrame, path: str, size: int = 20) -> str:
    """The translated rows, newest first, as a table with their page numbers
    (``page_no``, from 1), from which ``read_page`` takes any page in one pruned read.

    Rows are range-sorted once and written; each range's row count gives the place
    of its first row (prefix sums over one row a range), and places inside a range
    come from a window over it.  No task sees more than a range."""
    _check_size(size)
    newest = [F.col("published_at").desc(), F.col("id").desc()]
    d = df.filter(F.col("translation_status") == TRANSLATED)
    ranges = cut_lineage(d.repartitionByRange(*newest).withColumn("__range", F.spark_partition_id()))
    counts = ranges.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("__range", F.coalesce(before, F.lit(0)).alias("__start"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*newest)) - 1 + F.col("__start")
    numbered = ranges.join(starts, "__range").withColumn("page_no", F.floor(place / size) + 1).drop("__range", "__start")
    numbered.repartitionByRange("page_no").sortWithinPartitions("page_no", *newest).write.parquet(path)
    return path


def read_page(spark: SparkSession, path: str, page_no: int) -> DataFrame:
    """One page of a table of ``write_pages``: the filter reaches the scan, which
    skips the row groups of other pages."""
    d = spark.read.parquet(path).filter(F.col("page_no") == F.lit(page_no).cast("long"))
    return d.drop("page_no").orderBy(F.col("published_at").desc(), F.col("id").desc())


def page_count(df: DataFrame, size: int = 20) -> DataFrame:
    """Total rows (all rows, as the reference counts) and pages."""
    return df.agg(F.count(F.lit(1)).alias("total_count")) \
             .withColumn("page_count", F.ceil(F.col("total_count") / F.lit(size)).cast("long"))


def related_details(related: DataFrame, arts: DataFrame, limit: int = 6) -> DataFrame:
    """C4: for each article, its related articles' rows, newest first, at
    most ``limit`` (a join on the related id and a per-article top-k)."""
    j = related.join(arts.withColumnRenamed("id", "related_news_id"), on="related_news_id")
    w = Window.partitionBy("news_id").orderBy(F.col("published_at").desc(), F.col("related_news_id").desc())
    return j.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= limit).drop("__rn")


def link_dedup(pages: DataFrame, link: str, order: list[str]) -> DataFrame:
    """First row per link in input order; empty links dropped."""
    from tributary.operators.windows import keep_first
    p = pages.filter(F.col(link).isNotNull() & (F.length(F.col(link)) > 0))
    return keep_first(p, [link], order)
