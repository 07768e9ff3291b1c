"""Predicates over the columns of a unit.

A unit has doc_id, ord, unit_id, granularity, page, dtype, raw_text, audit_text, x0, y0,
x1, y1 (null without a box), page_width, page_height and recovery. What a missing value
stands for depends on the predicate, and is stated at each.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from . import text as T


def col(name: str, prefix: str = "") -> Column:
    return F.col(f"{prefix}{name}")


def edge(name: str, prefix: str = "", missing: float = 0.0) -> Column:
    return F.coalesce(col(name, prefix), F.lit(missing))


def width(prefix: str = "") -> Column:
    w = col("page_width", prefix)
    return F.when(w.isNull() | (w == 0), 595.0).otherwise(w)


def height(prefix: str = "") -> Column:
    h = col("page_height", prefix)
    return F.when(h.isNull() | (h == 0), 842.0).otherwise(h)


def middle(prefix: str = "") -> Column:
    return (edge("y0", prefix) + edge("y1", prefix)) / 2


def order(prefix: str = "") -> list[Column]:
    """Reading order; the place in the inventory decides ties."""
    return [F.coalesce(col("page", prefix), F.lit(0)), edge("y0", prefix), edge("x0", prefix), col("ord", prefix)]


def audit(prefix: str = "") -> Column:
    """The audit text, else the raw one in the form of output blocks."""
    return F.coalesce(F.nullif(col("audit_text", prefix), F.lit("")), T.normalize_audit(col("raw_text", prefix)))


def content(prefix: str = "") -> Column:
    """The audit text, else the raw text as it is, else nothing."""
    return F.coalesce(F.nullif(col("audit_text", prefix), F.lit("")), col("raw_text", prefix), F.lit(""))


def is_type(names: tuple[str, ...], prefix: str = "") -> Column:
    return F.coalesce(col("dtype", prefix).isin(*names), F.lit(False))


def left_isolated_section(prefix: str = "") -> Column:
    """A section number alone at the left edge; a missing box is not at the left."""
    return (col("granularity", prefix) == "block") & F.rlike(T.stripped(col("raw_text", prefix)), F.lit(P.ISOLATED_SECTION)) & (edge("x0", prefix, 999.0) < width(prefix) * 0.2)


def toc_number(prefix: str = "") -> Column:
    return is_type(("toc_number",), prefix) | F.rlike(T.stripped(col("raw_text", prefix)), F.lit(P.TOC_NUMBER)) & (edge("x0", prefix, 999.0) < width(prefix) * 0.16)


def toc_page(prefix: str = "") -> Column:
    return is_type(("toc_page",), prefix) | F.rlike(T.stripped(col("raw_text", prefix)), F.lit(r"(?U)^\d+$")) & (edge("x0", prefix) >= width(prefix) * 0.75)


def edge_candidate(prefix: str = "") -> Column:
    """Near the top or bottom, and like a header or footer."""
    s = T.squeezed(col("raw_text", prefix))
    near = (edge("y0", prefix) <= 50) | (edge("y0", prefix) >= 760)
    like = F.coalesce(F.startswith(col("dtype", prefix), F.lit("discarded")), F.lit(False)) | is_type(P.EDGE_TYPES, prefix) & (F.length(s) <= 100) | F.rlike(s, F.lit(P.RIGHTS)) | (F.length(s) <= 60) & F.rlike(s, F.lit(P.HEADER_FOOTER))
    return near & like


def safe_discard(prefix: str = "") -> Column:
    """A header or footer that may be discarded: its type or id says so too."""
    said = F.coalesce(F.startswith(col("dtype", prefix), F.lit("discarded")), F.lit(False)) | is_type(P.EDGE_TYPES, prefix) | F.coalesce(F.contains(col("unit_id", prefix), F.lit("discarded_blocks")), F.lit(False))
    return said & edge_candidate(prefix)


def standalone_footnote(prefix: str = "") -> Column:
    bottom = edge("y0", prefix) >= height(prefix) * 0.85
    like = is_type(P.FOOTNOTE_TYPES, prefix) | F.coalesce(F.contains(col("unit_id", prefix), F.lit("discarded_blocks")), F.lit(False))
    short = (edge("x0", prefix) >= 90) & (F.size(T.words(col("raw_text", prefix))) <= 90)
    return T.footnote_start(col("raw_text", prefix)) & bottom & (like | short)


def footnote_contamination(prefix: str = "") -> Column:
    inside = F.rlike(F.coalesce(col("raw_text", prefix), F.lit("")), F.lit(r"(?U)[.!?]\s+\d+\)\s+\S+"))
    return ~standalone_footnote(prefix) & (T.footnote_start(col("raw_text", prefix)) & (edge("y0", prefix) >= 730) | inside)


def recovered(prefix: str = "") -> Column:
    return col("recovery", prefix).isNotNull() | F.coalesce(F.startswith(col("unit_id", prefix), F.lit("source-pdf-recovery:")), F.lit(False))


def numbered_source(label: str, prefix: str = "") -> Column:
    """Does a Table or Figure number stand at a table, figure or caption?"""
    types = (*P.TABLE_TYPES, "caption") if label == "Table" else ("image", "figure", "caption")
    like = F.rlike(T.squeezed(col("raw_text", prefix)), F.lit(rf"(?iU)^{label}\s+\d+\s*(?:[-–—:]\s*)?[^.?!]{{0,120}}$"))
    return is_type(types, prefix) | like


def heading_pair_exempt(a: str, b: str) -> Column:
    """Two headings in a row (columns with these prefixes) that belong together."""
    raw_a, raw_b = col("raw_text", a), col("raw_text", b)
    low_a, low_b = F.lower(T.stripped(raw_a)), F.lower(T.stripped(raw_b))
    sec_a, sec_b = T.section_anchor(raw_a), T.section_anchor(raw_b)
    same_page = col("page", a).eqNullSafe(col("page", b))
    child = F.coalesce((F.size(sec_b) == F.size(sec_a) + 1) & (F.slice(sec_b, 1, F.size(sec_a)) == sec_a), F.lit(False))
    alone = F.rlike(T.stripped(raw_a), F.lit(P.ISOLATED_SECTION)) | F.rlike(T.stripped(raw_b), F.lit(P.ISOLATED_SECTION))
    split = alone & ~(sec_a.isNotNull() & sec_b.isNotNull()) & same_page & (F.abs(middle(a) - middle(b)) <= 8)
    one = same_page & (sec_a.isNotNull() != sec_b.isNotNull())
    lettered = lambda t: F.startswith(t, F.lit("appendix")) | F.startswith(t, F.lit("appendice")) | F.rlike(t, F.lit(r"(?U)^[a-z]\.\d+(?:\.\d+)*$"))
    appendix = same_page & (lettered(low_a) | lettered(low_b))
    terms = F.lit(True)
    for raw in (raw_a, raw_b):
        plain = F.lower(F.regexp_replace(F.coalesce(raw, F.lit("")), "<[^>]+>", " "))
        terms = terms & F.contains(plain, F.lit("termini")) & F.contains(plain, F.lit("definizioni"))
    tables = F.lit(False)
    for low in (low_a, low_b):
        tables = tables | F.contains(low, F.lit("prospetto")) | F.contains(low, F.lit("table "))
    return child | split | one | appendix | terms | same_page & tables | recovered(a) | recovered(b) | T.code_line(raw_a) | T.code_line(raw_b) | T.common_subheading(raw_b)


def column_pair_exempt(a: str, b: str) -> Column:
    """Two columns of a schema, or an appendix number and its label."""
    left, right = T.stripped(col("raw_text", a)), T.stripped(col("raw_text", b))
    schema = F.rlike(left, F.lit(r"^[A-Za-z_][A-Za-z0-9_]*:$")) & F.rlike(right, F.lit(P.SCHEMA_WORDS))
    return schema | F.rlike(left, F.lit(r"(?U)^[A-Z]\.\d+(?:\.\d+)*$")) & T.common_subheading(right)
