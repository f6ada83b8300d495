"""HTML cleaning, text helpers, search escaping (FIXTURES §4)."""

from pyspark.sql import functions as F

from tributary.functions import clean_author, contains_ci, summary_cut, text_after_marker
from tributary.operators.html import clean_html, extract_container


def test_clean_rules():
    h = ('<div><p>Hi <a href="x">link</a><span>gone <b>x</b></span> Become a RaceFans supporter</p>'
         '<div class="big tnp-box">ad</div><div class="note">keep</div><div id="article-mpu-3">m</div>'
         '<div id="x_snack_dex_1">s</div><ul class="lcp_catlist"><li>c</li></ul>'
         '<script>var t="</p>";</script><p class="text-above-ad">t</p><h4>h</h4></div>')
    out = clean_html(h)
    assert out == '<div><p>Hi <b>link</b> </p><div class="note">keep</div></div>'


def test_class_part_only_on_listed_elements():
    assert "tnp" in clean_html('<section2><p class="tnp">x</p></section2>')


def test_container_outermost_and_metadata():
    h = "<article><p>Venue: X</p><p><b>a</b><b>b</b><b>c</b></p><p>body</p><article><p>in</p></article></article>"
    out = extract_container(h, None, None, "article", drop_metadata=True)
    assert out == "<p>body</p><article><p>in</p></article>"


def test_column_helpers(spark):
    df = spark.createDataFrame([("A ... B ... C", "x Result:  answer ", "CleerenRonald Apr 3")], "s string, r string, a string")
    row = df.select(summary_cut("s").alias("s"), text_after_marker("r").alias("r"), clean_author("a").alias("a")).first()
    assert (row.s, row.r, row.a) == ("A ...", "answer", "Cleeren, Ronald")
    assert df.select(text_after_marker(F.lit("none")).alias("x")).first().x is None


def test_search_escapes_wildcards(spark):
    df = spark.createDataFrame([("100% sure",), ("100 sure",), ("a_b",), ("axb",)], "t string")
    assert [r.t for r in df.filter(contains_ci("t", "0%")).collect()] == ["100% sure"]
    assert [r.t for r in df.filter(contains_ci("t", "A_B")).collect()] == ["a_b"]


def test_void_elements_and_entities_round_trip():
    out = clean_html('<p>a &amp; b<br>c &copy; <img src="x.png"></p><meta charset="utf-8">')
    assert out == '<p>a &amp; b<br/>c © </p><meta charset="utf-8"/>'


def test_metadata_rule_uses_own_paragraph_text():
    # Unclosed paragraphs nest; a dropped one keeps its nested paragraphs.
    h = "<article><p>Dates: 1-3 May<p>kept one</p><p><b>x</b><b>y</b><b>z</b><p>kept two</p></p></article>"
    assert extract_container(h, None, None, "article", True) == "<p>kept one</p><p>kept two</p>"


def test_source_containers(spark):
    from tributary.operators.html import extract_text
    from tributary.plans import news as N
    pages = spark.createDataFrame([
        (1, "BBC", '<div data-component="text-block"><p>Venue: X</p><p>race report</p></div>'),
        (2, "F1 Technical News", '<div class="content article"><p>tech</p></div><div class="content"><p>no</p></div>'),
        (3, "RaceFans", '<div class="entry-content extra"><p>fans</p></div>')], "id long, source string, html string")
    c = spark.createDataFrame(N.SOURCE_CONTAINERS, N.CONTAINER_SCHEMA)
    got = {r.id: r.content for r in extract_text(pages, c).collect()}
    assert got == {1: "<p>race report</p>", 2: "<p>tech</p>", 3: "<p>fans</p>"}


def test_clean_pages_on_driver_pages(spark):
    import __spark_entry__ as E
    rows = E.queries()["clean_pages"](spark, "/root/testdata/sf0.001").collect()
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
    assert len(rows) == pages
    for r in rows:
        assert "<script" not in r.content and "<a " not in r.content and "</a>" not in r.content
        assert r.translation_status == "pending"


def test_numbered_pages(spark):
    """Any page from the written table equals the offset form; ties, last page, no rows."""
    import uuid

    from tributary.plans import news
    from tributary.session import checkpoint_dir
    rows = spark.range(95).selectExpr("id", "CAST(NULL AS STRING) AS title",
                                      "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, CAST(id DIV 7 AS INT)) AS published_at",
                                      "CASE WHEN id % 10 = 0 THEN 'title failed' ELSE 'translated' END AS translation_status")
    path = news.write_pages(rows, f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}", 20)
    for p in (1, 3, 5, 6):
        assert news.read_page(spark, path, p).collect() == news.page(rows, p, 20).collect()
    plan = news.read_page(spark, path, 3)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(page_no,3)" in plan
    none = news.write_pages(rows.limit(0), f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}", 20)
    assert news.read_page(spark, none, 1).count() == 0


def test_trees_are_freed_without_the_collector():
    """A page's tree goes with its last use; waiting for the collector, a worker held many."""
    import gc
    from tributary.operators import html as H
    gc.collect()
    gc.disable()
    try:
        for _ in range(20):
            assert H.clean_html("<div><p>a<b>c</b></div><p>d") == "<div><p>a<b>c</b></p></div><p>d</p>"
        assert sum(isinstance(o, H._Node) for o in gc.get_objects()) == 0
    finally:
        gc.enable()


def test_pages_reach_a_worker_in_small_batches(spark):
    from tributary.operators.html import BATCH_BYTES, clean_pages
    out = clean_pages(spark.createDataFrame([(i, f"<p>{i}</p>") for i in range(300)], "id long, html string"))
    assert {r.id: r.content for r in out.collect()} == {i: f"<p>{i}</p>" for i in range(300)}
    assert 0 < int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= BATCH_BYTES
