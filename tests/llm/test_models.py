"""Classifiers, page text, URL rules and graph search on small fixtures."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import graph_search, html_text, quality, toxicity, url_filter
from tributary.llm.common import batches_of
from tributary.llm.labelled import sample as labelled_sample
from tributary.llm.queries import RULES

DOCS = "doc_id long, text string, score string"


def labelled(n=1000):
    rng = random.Random(2)
    words = ["".join(rng.choices(["an", "ti", "or", "he", "la", "su"], k=3)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        toxic, junk = i % 3 == 0, i % 4 == 0
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(["idiot", "scum", "vequ" + rng.choice(words)])
        rows.append((i, " | ".join(w) if junk else " ".join(w), "x"))
        labels.append((i, int(not junk), int(toxic)))
    return rows + [(None, "no id", "x"), (n, None, "x"), (n + 1, "", "x"), (n + 2, "!!! ??", "x"), (n + 3, "la " * 30000 + "idiot", "x"), (0, rows[0][1], "x")], labels


@pytest.mark.parametrize("model,label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifier_on_held_out_rows(spark, model, label):
    rows, labels = labelled()
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = model.score(docs, model.fit(docs, known)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    truth = {d: (q, t)[label == "toxic"] for d, q, t in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert held and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert len({r.score for r in got if r.doc_id == 0}) == 1
    if model is toxicity:
        assert next(r for r in got if r.doc_id == 1003).predicted == 1  # its last word only
    nothing = model.score(docs, model.fit(docs, known.limit(0))).select("score").distinct().collect()
    assert [r.score for r in nothing] == [0.0 if model is toxicity else 0.5]
    assert model.score(docs.limit(0), model.fit(docs, known.limit(0))).count() == 0


def test_toxicity_gradients():
    rng = np.random.default_rng(0)
    rows = [(" ".join(rng.choice(["aba", "cdc", "efe", "ghg"], 9)), int(i % 2)) for i in range(6)]
    import pyarrow as pa
    w = toxicity.words_of(pa.array([t for t, _ in rows]))
    y = np.array([v for _, v in rows], np.float32)
    net = toxicity.train(rows)
    net.dense = {k: v.astype(np.float64) for k, v in net.dense.items()}
    _, begin, n = toxicity.windows_of(w.first)
    g, *_ = net.gradients(w, begin, n, y)

    def loss():
        z = net.logits(w, begin, n).astype(float)
        return np.mean(np.logaddexp(0, z) - y * z)

    for k in ("wx", "u0", "u1", "wa", "va", "w"):
        i = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        before = net.dense[k][i]
        values = []
        for d in (1e-2, -1e-2):
            net.dense[k][i] = before + d
            values.append(loss())
        net.dense[k][i] = before
        assert abs((values[0] - values[1]) / 2e-2 - g[k][i]) < 0.05 * abs(g[k][i]) + 2e-4, k


def test_drop_toxic_keeps_columns(spark):
    rows, labels = labelled()
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = toxicity.drop_toxic(docs, known)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {d for d, _, t in labels if not t}


PAGE = """<html><head><title>T</title><script>var a="</p>";</script><style>p{}</style></head><body>
<header><a href="/">Home</a> Site name</header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
<div class="ad">Buy   this now, it is a good offer for you today.</div><div class="cookie-notice">We use cookies.</div>
<article><h1>Title &amp; more</h1><p><b>First   line<br>goes on <a href="#">there</a>.<p>Se&ccedil;ond</p><!-- gone --><div>x<i>y</i>z</div>
<form><input><button>Send</button></form></article>
<aside>Side box</aside><section id="comments"><p>A long comment of a reader who says a lot about it.</p></section><footer>&copy; me</footer>"""


def test_main_text(spark):
    rows = [(1, "u", PAGE, "old"), (2, None, None, "old"), (3, "u", "", "old"), (4, "u", "<p>" * 3000 + "deep", "old"),
            (5, "u", "<main>" + "<p>word</p>" * 5000, "old"), (6, "u", "a < b & c", "old"), (1, "u", PAGE, "old")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(df).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 7 and by[1].text == "Title & more\nFirst line goes on there.\nSeçond\nxyz" and by[1].n_chars == len(by[1].text)
    assert by[2].text == by[3].text == "" and by[2].n_chars == 0
    assert by[5].text.count("\n") == 4999
    assert html_text.extract(df.limit(0)).count() == 0


def test_tree_agrees_with_its_table():
    table = np.array(html_text.LABELLED, float)
    tree = html_text.grow(table)

    def says(node, x):
        while not isinstance(node, int):
            f, t, low, high = node
            node = low if x[f] <= t else high
        return node
    assert np.mean([says(tree, r[:-1]) == r[-1] for r in table]) > 0.95


def test_sample_has_one_row_of_a_repeated_id(spark):
    docs = spark.createDataFrame([(1, f"text {i:03d}") for i in range(200)] + [(2, "two"), (3, "three"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (1, 1)], "doc_id long, toxic int")
    rows = labelled_sample(docs, labels, "toxic", F.lit(True), {0: 5, 1: 5}, 100)
    assert sorted(map(tuple, rows.collect())) == [("text 000", 1), ("three", 0), ("two", 0)]


def test_url_verdicts(spark):
    canonical = '<link href="{}" rel="canonical">'
    rows = [(1, "https://a.example.org/es/1", None), (2, "http://EXAMPLE.org/en/12?x", ""), (3, "https://x.org", ""), (4, "https://x.org/a#f", ""),
            (5, "http://b.com/fr/x", ""), (6, "http://b.com/de/x", ""), (7, "http://c.net/p", canonical.format("http://b.com/de/x")),
            (8, "http://d.net/q", '<meta http-equiv="refresh" content="0; url=http://c.net/p#top">'), (9, "http://e.net/", canonical.format("http://b.com/fr/x")),
            (10, "http://f.com/fr/1", canonical.format("http://c.net/p")), (11, None, "x"), (12, "nothing", canonical.format("http://b.com/de/x")),
            (13, "http://d.net/q#z", ""), (14, "http://g.net/a", canonical.format("/b")), (15, "http://g.net/b", canonical.format("http://badexample.org/es/"))]
    df = spark.createDataFrame([(*r, "v") for r in rows], "page_id long, url string, html string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, RULES).collect()}
    assert got[1] == ("a.example.org", "/es/1", "example.org/es/", "block") and got[2] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[3] == ("x.org", "", None, "allow") and got[4] == ("x.org", "/a", "org/", "allow")
    assert got[5][3] == "allow" and got[6][3] == "block"
    assert got[7][2:] == got[8][2:] == got[13][2:] == (None, "block")
    assert got[9][3] == "allow" and got[10][2:] == ("com/fr/", "allow")
    assert got[11] == got[12] == ("", "", None, "allow")
    assert got[14][3] == got[15][3] == "allow"  # badexample.org isn't example.org
    assert url_filter.judge(df.limit(0), RULES).count() == 0


def test_url_targets_are_decoded_and_resolved(spark):
    canonical, refresh = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; url={}">'
    bad = "http://b.com/de/x"
    rows = [(1, "http://h.net/p?page=2&ref=x", canonical.format(bad)), (2, "http://h.net/amp", canonical.format("http://h.net/p?page=2&amp;ref=x")),
            (3, "http://h.net/num", refresh.format("http://h.net/p?page=2&#38;ref&#x3D;x")),
            (4, "http://h.net/d/e/rel", canonical.format("../../p?page=2&amp;ref=x")), (5, "http://h.net/p", refresh.format("?page=2&amp;ref=x")),
            (6, "http://h.net/d/sib", canonical.format("e/rel")), (7, "http://q.net/x", '<base href="http://h.net/d/">' + canonical.format("sib")),
            (8, "http://q.net/d/y", '<base target="_top" href="../"><link rel="canonical" href="x">'),
            (9, "HTTP://WWW.Q.net/Case", canonical.format("//Q.NET/x")), (10, "http://www.q.net/Case", ""), (11, "http://www.q.net/case", ""),
            (12, "http://c.net/?a=1&copy=2", canonical.format(bad)), (13, "http://c.net/z", canonical.format("/?a=1&copy=2")),
            (14, "http://n.net/a", canonical.format("mailto:x")), (15, "http://n.net/b", canonical.format("b2")), (16, "http://n.net/b2", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.judge(df, RULES).collect()}
    assert got == {**dict.fromkeys([*range(1, 11), 12, 13], "block"), **dict.fromkeys([11, 14, 15, 16], "allow")}


def test_graph_search_recall_and_ties(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((1500, 16)).astype(np.float32)
    v[200:700] = v[100]                                  # one vector that a third share
    rows = [(i, x.tolist(), 0) for i, x in enumerate(v)]
    rows += [(5000, None, 0), (5050, [0.0] * 16, 0), (5100, [float("nan")] * 16, 0), (5150, [1.0, None] * 8, 0), (5200, [], 0), (50, v[50].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    index = graph_search.build_index(df, 5, shard=300)
    got = {}
    for r in graph_search.search(index, df.where(F.col("vec_id") % 50 == 0), 5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 1500, 50))
    x = v.astype(float)
    hit = 0
    for q, found in got.items():
        s = graph_search.cosines(x, x[q])
        s[q] = -9
        best = np.lexsort((np.arange(len(s)), -s))[:5].tolist()
        hit += len({i for _, i, _ in found} & set(best))
        assert [r for r, *_ in sorted(found)] == [1, 2, 3, 4, 5] and all(abs(score - s[i]) < 1e-12 for _, i, score in found)
        if 200 <= q < 700:
            assert sorted(i for _, i, _ in found) == best == [i for _, i, _ in sorted(found)]
    assert hit >= 0.9 * 5 * len(got)
    assert graph_search.nearest(df.limit(0)).count() == 0
    assert graph_search.nearest(df.where("vec_id < 3")).count() == 2


def test_graph_search_pairs_blocks_without_broadcast(spark, monkeypatch):
    """What meets every shard is not multiplied into a table for the driver, and
    the best of several blocks and tasks is the same as of one."""
    rng = np.random.default_rng(4)
    v = rng.standard_normal((700, 8))
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(10, v[20].tolist()), (30, [1.0, 2.0]), (31, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = graph_search.build_index(df, 5, shard=60)
    plans, stage = [], graph_search.stage

    def seen(frame, *size):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return stage(frame, *size)
    monkeypatch.setattr(graph_search, "stage", seen)
    found = {}
    for block in (9, 2048):
        out = graph_search.search(index, df.where(F.col("vec_id") % 10 == 0), 5, block=block)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        found[block] = sorted(out.collect())
    assert found[9] == found[2048] and len(found[9]) == 350
    met = [p for p in plans if "MapInArrow" in p]
    assert len(met) == 2 and all("CartesianProduct" in p and "Broadcast" not in p for p in met)


def test_best_of_two_sets_counts_an_equal_row_once():
    none = graph_search.ABSENT
    ids, scores = graph_search.first_of(np.array([[7, 4, none], [none] * 3]), np.array([[0.9, 0.5, -np.inf], [-np.inf] * 3]),
                                        np.array([[7, 2, 9], [3, 1, none]]), np.array([[0.9, 0.5, 0.1], [0.2, float("nan"), -np.inf]]))
    assert ids[0].tolist() == [7, 2, 4] and scores[0].tolist() == [0.9, 0.5, 0.5]
    assert ids[1, 0] == 3 and scores[1].tolist() == [0.2, -np.inf, -np.inf]


def test_batch_size_is_put_back_as_it_was(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key, None)
    try:
        for value in (None, "12345"):
            spark.conf.unset(key)
            if value:
                spark.conf.set(key, value)
            with batches_of(spark, 777):
                assert spark.conf.get(key, None) == "777"
            assert spark.conf.get(key, None) == value
    finally:
        spark.conf.unset(key)
        if held:
            spark.conf.set(key, held)


LONG = "The river rises in the spring and the farmers who live there move their cattle to the hills until the water falls again. " * 3
LONG = LONG.strip()
SHAPES = [
    (f"<nav>Home About</nav><article><p>{LONG}</p></article>", LONG),
    (f"<article><p>{LONG}</p><div class='ad'>Buy our offer</div><p>{LONG}</p><aside>Side box</aside><p>{LONG}</p></article>", f"{LONG}\n{LONG}\n{LONG}"),
    (f"<article><p>{LONG}</p></article><div id='comments'><p>I agree.</p><p>{LONG}</p></div>", LONG),
    ("<article><p class='notice'>Ad<p>real text<p>and more</article>", "real text\nand more"),
    ("<article><ul><li class='share'>Tell others<li>One<li>Two</ul><p id='related-work'>Work of others.</p><p class='share-price'>It fell.</p></article>",
     "One\nTwo\nWork of others.\nIt fell."),
    ("<div id='content'><h1>Title</h1><p>Short.</p><p>A paragraph of fourteen words that says no more than it has to say here.</p></div><div class='footer'>Me</div>",
     "Title\nShort.\nA paragraph of fourteen words that says no more than it has to say here."),
    (f"<div class='main-content'><h2>A</h2><ul><li>x<li>y</ul></div><div class='sidebar'>{LONG}</div>", "A\nx\ny"),
    ("<div id='main'><div id='sidebar'>Links</div><p>Kept.</p></div>", "Kept."),
    ("<div id='content'>Outside <article><p>In.</p></article> after</div>", "In."),
    ("<main><table><tr><td class='ad'>Buy<td>Cell one<tr><td>Cell two</table></main>", "Cell one\nCell two"),
    ("<main><dl><dt>Term<dd class='promo'>Offer<dt>Next<dd>Meaning</dl></main>", "Term\nNext\nMeaning"),
    (f"<header>Site</header><div class='entry-content'><p>One.</p><div class='related-posts'>More</div><p>{LONG}</p></div>", f"One.\n{LONG}"),
    ("<article><section class='comment-list'><p>Nice!</p></section><p>Text.</p><div class='share-buttons'>F T</div></article>", "Text."),
    ("<article><p>One<div class='widget'><p>Box</div><p>Two</article>", "One\nTwo"),
    ("<article><form><p>Mail<p>Name</form><p>Text</p></article>", "Text"),
    (f"<p>{LONG}</p><p>{LONG}</p>", f"{LONG}\n{LONG}"),
    ("<article><p>A<table><tr><td><p>B<p>C</table><p>D</article>", "A\nB\nC\nD"),
    ("<article><blockquote><p>Said.</blockquote><p>Told.</article>", "Said.\nTold."),
    (f"<nav><ul><li><a href='/'>A</a><li><a href='/b'>B</a></ul></nav><article><h1>T</h1><p>{LONG}<footer>Tags: x</footer></article>", f"T\n{LONG}"),
    (f"<div class='cookie-notice'><p>{LONG}</p></div><article><p>Only this.</p></article>", "Only this."),
]


def test_main_text_of_other_shapes(spark):
    pages = [html if whole else f"<html><head><title>T</title></head><body>{html}</body></html>" for html, _ in SHAPES for whole in (True, False)]
    df = spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    wrong = {i: (pages[i], got[i]) for i in got if got[i] != SHAPES[i // 2][1]}
    assert not wrong
