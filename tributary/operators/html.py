"""HTML page cleaning and container extraction.

HTML structure cannot be edited with Column functions, so the tree work
runs in ``mapInArrow`` over Arrow batches with the standard library's
``html.parser``; the rules and every other step (phrase removal, null and
empty filters, status columns) stay Column expressions.  Each row is
parsed independently, so the job is as parallel as the page table.  A worker
holds a batch of BATCH_BYTES of pages (or one larger page) whatever the table, and
works through it in slices of SLICE_ROWS.
"""

from __future__ import annotations

from html import escape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements dropped with their content, class parts dropped
# per element, id rules, phrases removed from text, and the elements that
# have no end tag.
DROP_TAGS = ["span", "strong", "em", "section", "small", "figcaption", "img", "figure", "script", "h4"]
DROP_CLASS_PARTS = {"ul": ["lcp_catlist"], "div": ["tnp", "tnp-subscription", "alignright"], "p": ["text-above-ad"]}
DROP_ID_PREFIXES = ["article-mpu"]
DROP_ID_PARTS = ["snack_dex"]
REMOVE_PHRASES = ["Become a RaceFans supporter", "Go ad-free for just £1 per month", "Find out more and sign up"]
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
METADATA_PREFIXES = ["venue:", "coverage:", "dates:"]
# Bytes of an Arrow batch sent to a worker, and rows that it turns into Python texts at once.
BATCH_BYTES, SLICE_ROWS = 4 << 20, 64


class _Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag, attrs):
        self.tag, self.attrs, self.children = tag, attrs, []


class _Tree(HTMLParser):
    """A small lenient DOM: text, comments and elements; unclosed elements
    close at their parent's end tag.  Nodes don't know their parents (the open
    ones are a stack), so a page's tree is freed as soon as it is done with."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node(None, [])
        self.open = [self.root]

    @property
    def cur(self):
        return self.open[-1]

    def handle_starttag(self, tag, attrs):
        n = _Node(tag, attrs)
        self.cur.children.append(n)
        if tag not in VOID:
            self.open.append(n)

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(_Node(tag, attrs))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        self.cur.children.append(data)

    def handle_decl(self, decl):
        self.cur.children.append(_Raw(f"<!{decl}>"))

    def handle_comment(self, data):
        self.cur.children.append(_Raw(f"<!--{data}-->"))


class _Raw(str):
    pass


def _parse(html: str) -> _Node:
    t = _Tree()
    t.feed(html)
    t.close()
    return t.root


def _attr(n: _Node, name: str):
    for k, v in n.attrs:
        if k == name:
            return v
    return None


def _dropped(n: _Node) -> bool:
    if n.tag in DROP_TAGS:
        return True
    cls = _attr(n, "class")
    if cls and n.tag in DROP_CLASS_PARTS:
        values = cls.split()
        if any(part in v for part in DROP_CLASS_PARTS[n.tag] for v in values):
            return True
    ident = _attr(n, "id")
    if ident and (any(ident.startswith(p) for p in DROP_ID_PREFIXES) or any(p in ident for p in DROP_ID_PARTS)):
        return True
    return False


def _text(n) -> str:
    if isinstance(n, _Raw):
        return ""
    if isinstance(n, str):
        return n
    return "".join(_text(c) for c in n.children)


def _render(n, out: list) -> None:
    if isinstance(n, _Raw):
        out.append(n)
        return
    if isinstance(n, str):
        out.append(escape(n, quote=False))
        return
    if n.tag is None:
        for c in n.children:
            _render(c, out)
        return
    attrs = "".join(f' {k}="{escape(v or "", quote=True)}"' if v is not None else f" {k}" for k, v in n.attrs)
    if n.tag in VOID:  # void elements render self-closed
        out.append(f"<{n.tag}{attrs}/>")
        return
    out.append(f"<{n.tag}{attrs}>")
    for c in n.children:
        _render(c, out)
    out.append(f"</{n.tag}>")


def _clean(n: _Node) -> None:
    kept = []
    for c in n.children:
        if isinstance(c, _Node):
            if _dropped(c):
                continue
            if c.tag == "a":  # link to bold text
                b = _Node("b", [])
                b.children = [_text(c)]
                kept.append(b)
                continue
            _clean(c)
        elif not isinstance(c, _Raw):
            for ph in REMOVE_PHRASES:
                c = c.replace(ph, "")
        kept.append(c)
    n.children = kept


def clean_html(html: str | None) -> str | None:
    """N2 for one document (the per-row helper)."""
    if html is None:
        return None
    root = _parse(html)
    _clean(root)
    out: list = []
    _render(root, out)
    return "".join(out)


def _find_all(n: _Node, pred, outermost: bool = True):
    for c in n.children:
        if isinstance(c, _Node):
            if pred(c):
                yield c
                if outermost:
                    continue
            yield from _find_all(c, pred, outermost)


def _own(n: _Node):
    """Text and bold count of a paragraph without its nested paragraphs
    (unclosed ``<p>`` tags nest under html.parser)."""
    text, bolds = [], 0
    for c in n.children:
        if isinstance(c, _Node):
            if c.tag == "p":
                continue
            if c.tag == "b":
                bolds += 1
            t, b = _own(c)
            text.append(t)
            bolds += b
        elif not isinstance(c, _Raw):
            text.append(c)
    return "".join(text), bolds


def _drop_metadata(nodes: list) -> list:
    """Drop paragraphs whose own text starts with a metadata prefix or
    that hold more than two bold parts; paragraphs nested in a dropped one
    are kept (and tested in turn)."""
    out = []
    for c in nodes:
        if isinstance(c, _Node):
            if c.tag == "p":
                txt, bolds = _own(c)
                t = txt.strip().lower()
                if any(t.startswith(p) for p in METADATA_PREFIXES) or bolds > 2:
                    out.extend(_drop_metadata(list(_find_all(c, lambda x: x.tag == "p"))))
                    continue
            c.children = _drop_metadata(c.children)
        out.append(c)
    return out


def extract_container(html: str | None, attr: str | None, value: str | None, tag: str | None = None,
                      drop_metadata: bool = False) -> str | None:
    """The inner markup of the outermost elements matching the
    container rule (tag and/or attribute value); paragraphs that are
    metadata (``venue:``...) or hold more than two bold parts are removed
    when ``drop_metadata``."""
    if html is None:
        return None
    root = _parse(html)

    def match(n):
        if tag is not None and n.tag != tag:
            return False
        if attr is not None:
            v = _attr(n, attr)
            return v is not None and (value is None or value in v.split() or v == value)
        return True

    parts = []
    for cont in _find_all(root, match):
        kids = _drop_metadata(cont.children) if drop_metadata else cont.children
        out: list = []
        for c in kids:
            _render(c, out)
        parts.append("".join(out).strip())
    return "\n\n".join(p for p in parts if p)


def _with_text(df: DataFrame, fields: list, out_col: str, columns: list, fn) -> DataFrame:
    """``fields`` of the rows and, as ``out_col``, ``fn`` of their ``columns``."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    held = conf.get(key, str(BATCH_BYTES))
    if held.isdigit():  # bounds memory, no result
        conf.set(key, str(min(BATCH_BYTES, int(held))))
    names = [f.name for f in fields if f.name != out_col]
    schema = T.StructType([f for f in fields if f.name != out_col] + [T.StructField(out_col, T.StringType())])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(lo, SLICE_ROWS)
                texts = [fn(*row) for row in zip(*(part.column(c).to_pylist() for c in columns))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(texts, pa.string())], [*names, out_col])

    return df.mapInArrow(run, schema)


def clean_pages(pages: DataFrame, html_col: str = "html", out_col: str = "content") -> DataFrame:
    """N2 job: cleaned markup per row (``mapInArrow``), then rows left
    empty are dropped and the queue columns are set (Column expressions)."""
    cleaned = _with_text(pages, pages.schema.fields, out_col, [html_col], clean_html)
    return (cleaned.filter(F.col(out_col).isNotNull() & (F.length(F.trim(F.col(out_col))) > 0))
                   .withColumn("translation_status", F.lit("pending"))
                   .withColumn("content_zh", F.lit("")))


def extract_text(pages: DataFrame, containers: DataFrame, html_col: str = "html", source_col: str = "source",
                 out_col: str = "content") -> DataFrame:
    """N3 job: per source, the container rule comes from a small
    (source, tag, attr, value, drop_metadata) table joined by source."""
    j = pages.join(F.broadcast(containers), on=source_col, how="left")

    def text(html, attr, value, tag, drop_metadata):
        return extract_container(html, attr, value, tag, bool(drop_metadata))

    return _with_text(j, pages.schema.fields, out_col, [html_col, "attr", "value", "tag", "drop_metadata"], text)
