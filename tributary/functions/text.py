"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions._util import as_col

__all__ = [
    "remove_literals", "summary_cut", "text_after_marker", "strip_tags_preview",
    "clean_author", "concat_blank", "first_present", "first_image_link",
    "escape_like", "contains_ci",
]

# Month abbreviations that end an author line, the marker
# that precedes a model's answer, the ellipsis, and the preview length.
MONTH_ABBREVIATIONS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
                       "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
RESULT_MARKER = "Result:"
ELLIPSIS = "..."
PREVIEW_CHARS = 100


def remove_literals(s: Column | str, literals: list[str]) -> Column:
    """Remove each literal text, then trim."""
    c = as_col(s)
    for lit in literals:
        c = F.replace(c, F.lit(lit), F.lit(""))
    return F.trim(c)


def summary_cut(s: Column | str) -> Column:
    """Text before the first ``...`` plus ``...``; unchanged otherwise."""
    c = as_col(s)
    return F.when(F.instr(c, ELLIPSIS) > 0,
                  F.concat(F.substring_index(c, ELLIPSIS, 1), F.lit(ELLIPSIS))).otherwise(c)


def text_after_marker(s: Column | str, marker: str = RESULT_MARKER) -> Column:
    """Text after the first marker, trimmed; null when absent."""
    c = as_col(s)
    pos = F.instr(c, marker)
    return F.when(pos > 0, F.trim(F.substring(c, pos + F.lit(len(marker)), F.lit(1 << 30))))


def strip_tags_preview(html: Column | str, n: int = PREVIEW_CHARS) -> Column:
    """Drop tags by pattern, keep the first ``n`` characters + ``...``."""
    text = F.regexp_replace(as_col(html), r"<[^>]*>?", "")
    return F.concat(F.substring(text, 1, n), F.lit(ELLIPSIS))


def clean_author(s: Column | str) -> Column:
    """Cut at the first month abbreviation, split ``aB`` into ``a, B``, trim."""
    months = "|".join(MONTH_ABBREVIATIONS)
    c = F.regexp_replace(as_col(s), f"({months}).*", "")
    c = F.regexp_replace(c, r"([a-z])([A-Z])", "$1, $2")
    return F.trim(c)


def concat_blank(a: Column | str, b: Column | str) -> Column:
    """``a + ' ' + b`` with null when either side is null (pandas ``+``)."""
    return F.concat(as_col(a), F.lit(" "), as_col(b))


def first_present(*cols: Column | str) -> Column:
    """First non-null, non-empty of several sources."""
    return F.coalesce(*[F.when(F.length(as_col(c)) > 0, as_col(c)) for c in cols])


def first_image_link(links: Column | str) -> Column:
    """Href of the first link whose type starts with ``image/``.

    ``links`` is an array of struct<type string, href string>."""
    imgs = F.filter(as_col(links), lambda l: F.startswith(F.coalesce(l["type"], F.lit("")), F.lit("image/"))
                    & l["href"].isNotNull())
    return F.get(imgs, 0)["href"]


def escape_like(q: str) -> str:
    """Make ``%``, ``_`` and the escape char literal inside a LIKE pattern."""
    return q.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def contains_ci(s: Column | str, q: str, literal: bool = True) -> Column:
    """Case-insensitive substring test (``ILIKE %q%``)."""
    pat = escape_like(q) if literal else q
    return as_col(s).ilike(f"%{pat}%")
