"""Main text of HTML pages from flat text blocks.

A page is cut at block-level tags into flat blocks: runs of text with one kind
of surroundings.  A block's features are its own, its predecessor's and its
successor's word count and link density (share of words inside links), and
whether the nearest marked container around it is the article or page
furniture.  A small decision tree, grown here from the labelled table below,
says which blocks are main text.

Only the cut into blocks is per-row Python; neighbours, tree and joining are
DataFrame expressions on the page's array of blocks, so nothing is shuffled.

Cases: null or empty html gives an empty text; unclosed tags end where HTML
implies it (p, li, dt, dd, td, th, tr) or with the container that encloses them; very long pages are read whole; rows
and repeats stay; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = "array<struct<text:string,words:int,linked:int,place:int>>"
FEATURES = ["words", "density", "words_before", "density_before", "words_after", "density_after", "place"]

# Element names of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
                   "ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
UNSEEN = frozenset("script style head title template noscript svg math iframe object select option textarea button".split())
RAW = frozenset("script style title textarea iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset("article main".split())
FURNITURE = frozenset("nav header footer aside form dialog menu address figure".split()) - {"figure", "address"}
MARKS = re.compile(r"(?i)(?:^|[\s_-])(?:ads?|adverts?|advertisement|banner|breadcrumbs?|comments?|cookies?|disqus|footer|header|masthead|menu|"
                   r"modal|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo|related|replies|reply|share|sharing|sidebar|"
                   r"social|sponsor|sponsored|subscribe|toolbar|widget)(?:$|[\s_-])")
MARK_WORDS = re.compile(r"(?i)[\s_-]+")
# In an article a mark counts only beside words that say no more of its subject:
# "share-buttons" is furniture there, "share-price" is not.
PLAIN_WORDS = frozenset("area article articles bar block bottom box btn button buttons container content count footer form global group holder icon "
                        "icons inline inner item items left link links list main meta module outer page panel post posts right row section site slot "
                        "text thread title top unit wrap wrapper".split())
CONTENT_MARKS = re.compile(r"(?i)(?:^|\s)(?:page|site|main|post|body)?[_-]?(?:content|main|body)(?:[_-](?:content|text|body|main|area|inner|wrapper))?(?:$|\s)")
MAIN_MARKS = re.compile(r"(?i)(?:^|[\s_-])(?:article|post|entry|story)(?:[_-](?:body|content|text))?(?:$|\s)")
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
NAMES = re.compile(r"""(?is)\b(class|id|role|hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")

# Start tags that end an open element, and the elements they don't reach beyond.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
                   "hgroup hr main menu nav ol p pre search section table ul".split())
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
           "thead": ({"thead", "tbody", "tr"}, {"table"}), "tbody": ({"thead", "tbody", "tr"}, {"table"}), "tfoot": ({"thead", "tbody", "tr"}, {"table"})}
P_STAYS = frozenset("td th caption object template body button".split())

# IN_CONTENT: in a container that is only named content, main or body.  It counts
# as the article where the page has none.
OUTSIDE, IN_ARTICLE, IN_FURNITURE, IN_CONTENT = 0, 1, 2, 3


def is_furniture(marks: list[str], in_article: bool) -> bool:
    found = [m for m in marks if MARKS.search(m)]
    if not in_article:
        return bool(found)
    return any(all(MARKS.search(w) or w.lower() in PLAIN_WORDS or w.isdigit() for w in MARK_WORDS.split(token) if w)
               for m in found for token in m.split() if MARKS.search(token))


def place_of(name: str, attributes: str, inside: int) -> int:
    """Where the text of an element stands, given where the element stands."""
    marks = [next(filter(None, m.groups()[1:]), "") for m in NAMES.finditer(attributes)] if "=" in attributes else []
    if inside == IN_FURNITURE or name in FURNITURE or is_furniture(marks, inside == IN_ARTICLE):
        return IN_FURNITURE
    if name in MAIN or any(MAIN_MARKS.search(m) for m in marks):
        return IN_ARTICLE
    if inside == OUTSIDE and name != "body" and any(CONTENT_MARKS.search(m) for m in marks):
        return IN_CONTENT
    return inside


def implied_end(name: str, stack: list[tuple[str, int]]) -> int | None:
    """How much of the stack stays when a start tag ends what is open."""
    keep = None
    if name in ENDS_P:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == "p":
                keep = k
                break
            if stack[k][0] in P_STAYS:
                break
    if name in IMPLIED:
        ended, beyond = IMPLIED[name]
        for k in range((len(stack) if keep is None else keep) - 1, -1, -1):
            if stack[k][0] in beyond:
                break
            if stack[k][0] in ended:
                keep = k
                if name not in ("tr", "thead", "tbody", "tfoot"):
                    break
    return keep


def flat_blocks(page: str) -> list[tuple[str, int, int, int]]:
    """(text, words, words inside links, place) of each block of a page."""
    out, runs, linked = [], [], []
    stack: list[tuple[str, int]] = []
    place, at, links, unseen = OUTSIDE, 0, 0, 0

    def close():
        text = " ".join(entities.unescape("".join(runs)).split())
        if text:
            out.append((text, text.count(" ") + 1, len(entities.unescape(" ".join(linked)).split()), place))
        runs.clear()
        linked.clear()

    def say(text):
        if text and not unseen:
            runs.append(text)
            if links:
                linked.append(text)

    while True:
        m = TAG.search(page, at)
        if m is None:
            break
        say(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in INLINE:
            if name == "br":
                say(" ")
            elif name == "a":
                links = 0 if m[1] else 1
            continue
        close()
        links = 0
        if m[1]:
            known = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if known is not None:
                place = stack[known][1]
                del stack[known:]
                unseen = sum(n in UNSEEN for n, _ in stack)
        elif name not in VOID and not m[3].endswith("/"):
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
                continue
            if name == "body":
                stack.clear()
                unseen, place = 0, OUTSIDE
            kept = implied_end(name, stack)
            if kept is not None:
                place = stack[kept][1]
                del stack[kept:]
                unseen = sum(n in UNSEEN for n, _ in stack)
            stack.append((name, place))
            unseen += name in UNSEEN
            place = place_of(name, m[3], place)
    say(page[at:])
    close()
    content = OUTSIDE if any(b[3] == IN_ARTICLE for b in out) else IN_ARTICLE
    return [(*b[:3], content if b[3] == IN_CONTENT else b[3]) for b in out]


# Labelled blocks: words, link density, words and density of the block before,
# words and density of the block after, place (0 outside, 1 in an article,
# 2 in page furniture), main text or not.
LABELLED = [
    (1, 1.0, 0, 0.0, 1, 1.0, 2, 0), (2, 1.0, 1, 1.0, 1, 1.0, 2, 0), (1, 1.0, 2, 1.0, 9, 0.0, 2, 0), (9, 0.0, 1, 1.0, 10, 0.0, 2, 0),
    (8, 0.0, 1, 1.0, 12, 0.0, 2, 0), (40, 0.0, 1, 1.0, 12, 0.0, 2, 0), (15, 0.1, 60, 0.0, 0, 0.0, 2, 0), (60, 0.0, 80, 0.0, 30, 0.0, 2, 0),
    (120, 0.0, 90, 0.0, 0, 0.0, 2, 0), (5, 0.6, 100, 0.0, 0, 0.0, 2, 0), (3, 0.0, 0, 0.0, 1, 1.0, 2, 0), (25, 0.0, 2, 0.0, 20, 0.0, 2, 0),
    (2, 1.0, 0, 0.0, 50, 0.0, 2, 0), (2, 0.0, 0, 0.0, 60, 0.0, 2, 0), (3, 0.0, 80, 0.0, 70, 0.0, 2, 0), (4, 0.0, 45, 0.0, 120, 0.0, 2, 0),
    (2, 0.0, 100, 0.0, 40, 0.0, 2, 0), (30, 0.0, 60, 0.0, 90, 0.0, 2, 0), (70, 0.0, 2, 0.0, 65, 0.0, 2, 0), (12, 0.5, 50, 0.0, 45, 0.0, 2, 0),
    (1, 1.0, 38, 0.0, 200, 0.0, 2, 0), (18, 0.0, 0, 0.0, 42, 0.1, 2, 0), (5, 0.0, 70, 0.1, 55, 0.0, 2, 0), (50, 0.1, 4, 0.0, 41, 0.0, 2, 0),
    (2, 0.0, 1, 1.0, 60, 0.0, 1, 1), (8, 0.0, 2, 1.0, 100, 0.0, 1, 1), (50, 0.0, 3, 1.0, 40, 0.0, 1, 1), (20, 0.1, 1, 1.0, 90, 0.0, 1, 1),
    (1, 0.0, 4, 0.8, 30, 0.0, 1, 1), (6, 0.0, 12, 0.6, 15, 0.0, 1, 1), (3, 1.0, 2, 1.0, 70, 0.0, 1, 1), (100, 0.0, 1, 1.0, 120, 0.0, 1, 1),
    (10, 0.0, 9, 0.0, 60, 0.0, 1, 1), (60, 0.0, 10, 0.0, 80, 0.0, 1, 1), (1, 0.0, 80, 0.0, 15, 0.0, 1, 1), (2, 0.0, 60, 0.0, 0, 0.0, 1, 1),
    (3, 0.0, 9, 0.0, 40, 0.0, 1, 1), (200, 0.02, 60, 0.0, 50, 0.0, 1, 1), (35, 0.1, 4, 0.0, 70, 0.0, 1, 1), (1, 0.0, 1, 0.0, 1, 0.0, 1, 1),
    (5, 1.0, 60, 0.0, 40, 0.0, 1, 1), (12, 0.5, 70, 0.0, 90, 0.0, 1, 1), (1, 1.0, 30, 0.0, 12, 0.0, 1, 1), (8, 0.0, 1, 1.0, 3, 0.0, 1, 1),
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0), (2, 1.0, 1, 1.0, 2, 1.0, 0, 0), (4, 0.8, 2, 1.0, 30, 0.0, 0, 0), (5, 0.0, 1, 1.0, 2, 1.0, 0, 0),
    (3, 0.0, 0, 0.0, 4, 1.0, 0, 0), (6, 0.0, 4, 1.0, 5, 0.0, 0, 0), (4, 0.0, 5, 0.0, 6, 0.0, 0, 0), (7, 0.4, 5, 0.9, 3, 1.0, 0, 0),
    (12, 0.6, 40, 0.0, 10, 1.0, 0, 0), (30, 0.7, 10, 0.5, 8, 1.0, 0, 0), (6, 0.0, 3, 0.0, 0, 0.0, 0, 0), (9, 0.0, 2, 1.0, 4, 0.0, 0, 0),
    (30, 0.0, 5, 0.0, 60, 0.0, 0, 1), (80, 0.0, 30, 0.0, 70, 0.05, 0, 1), (45, 0.1, 80, 0.0, 6, 0.0, 0, 1), (150, 0.05, 2, 0.0, 20, 0.0, 0, 1),
    (25, 0.0, 45, 0.0, 90, 0.0, 0, 1), (12, 0.0, 60, 0.0, 80, 0.0, 0, 1), (14, 0.0, 90, 0.0, 45, 0.0, 0, 1), (20, 0.1, 70, 0.0, 30, 0.0, 0, 1),
]


def grow(table: np.ndarray, depth: int = 6):
    """A decision tree by Gini impurity: a leaf is 0 or 1, an inner node
    (feature, threshold, tree if at most, tree if above)."""
    y = table[:, -1]
    if depth == 0 or y.min() == y.max():
        return int(y.mean() >= 0.5)
    best = None
    gini = lambda v: len(v) * v.mean() * (1 - v.mean())
    for f in reversed(range(table.shape[1] - 1)):  # of equal splits the last feature's first
        values = np.unique(table[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            low = table[:, f] <= t
            cost = gini(y[low]) + gini(y[~low])
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, float(t), low)
    if best is None:
        return int(y.mean() >= 0.5)
    _, f, t, low = best
    return f, t, grow(table[low], depth - 1), grow(table[~low], depth - 1)


def tree_column(tree, features: list[Column]) -> Column:
    if isinstance(tree, int):
        return F.lit(bool(tree))
    f, t, low, high = tree
    return F.when(features[f] <= t, tree_column(low, features)).otherwise(tree_column(high, features))


def with_blocks(df: DataFrame, html: str = "html", out: str = "blocks") -> DataFrame:
    @F.arrow_udf(BLOCKS)
    def cut(pages: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("text", pa.string()), ("words", pa.int32()), ("linked", pa.int32()), ("place", pa.int32())]))
        return pa.array([[dict(zip(("text", "words", "linked", "place"), b, strict=True)) for b in flat_blocks(p.as_py())] for p in pages], kind)

    return df.withColumn(out, cut(F.coalesce(F.col(html), F.lit(""))))


def main_text(df: DataFrame, html: str = "html", labelled=None) -> DataFrame:
    """``df`` with the column text: its blocks that the tree calls main text,
    in page order, joined by newlines."""
    tree = grow(np.array(LABELLED if labelled is None else labelled, float))
    blocks = F.col("blocks")
    none = F.struct(F.lit("").alias("text"), F.lit(0).alias("words"), F.lit(0).alias("linked"), F.lit(0).alias("place"))
    density = lambda b: F.when(b["words"] > 0, b["linked"] / b["words"]).otherwise(F.lit(0.0))

    def judged(b, i):
        before = F.when(i > 0, F.get(blocks, i - 1)).otherwise(none)
        after = F.coalesce(F.get(blocks, i + 1), none)
        values = [b["words"], density(b), before["words"], density(before), after["words"], density(after), b["place"]]
        return tree_column(tree, values)

    chosen = F.filter(blocks, judged)
    return with_blocks(df, html).withColumn("text", F.array_join(F.transform(chosen, lambda b: b["text"]), "\n")).drop("blocks")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    return main_text(pages.select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
