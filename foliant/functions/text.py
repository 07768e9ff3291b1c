"""Text functions: normal forms, tokens, shingles, anchors, ids, symbol repair.

All but decoding (character references and NFKC, which Spark has no function for) are
plain columns. Decoding is an Arrow UDF; ask for it only where texts can need it.
"""

from __future__ import annotations

import html
import json
import hashlib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import patterns as P


def let(value: Column, use) -> Column:
    """``use(value)`` with the value reckoned once, however often it stands there."""
    return F.transform(F.array(value), use)[0]


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def squeezed(text: Column) -> Column:
    """Each run of white space as one space, none at the ends; null as empty."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "), "^ | $", "")


def stripped(text: Column) -> Column:
    """Without white space at the ends; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")


def words(text: Column) -> Column:
    """Runs of what isn't white space."""
    return _all(F.coalesce(text, F.lit("")), r"(?U)\S+")


def normalize_audit(text: Column) -> Column:
    """The form of output blocks: squeezed, lower case."""
    return F.lower(squeezed(text))


def _decode(texts: pd.Series, nfkc: bool) -> pd.Series:
    out = texts.map(html.unescape, na_action="ignore")
    return out.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore") if nfkc else out


@F.pandas_udf(StringType())
def _decoded(text: pd.Series) -> pd.Series:
    return _decode(text, False)


@F.pandas_udf(StringType())
def _decoded_nfkc(text: pd.Series) -> pd.Series:
    return _decode(text, True)


def _where(needed: Column, text: Column, udf) -> Column:
    """``udf`` of texts that need it; all others stay in the JVM, Python gets nulls for them."""
    return F.when(needed, udf(F.when(needed, text))).otherwise(F.coalesce(text, F.lit("")))


def decoded(text: Column) -> Column:
    """Character references resolved."""
    return _where(F.contains(text, F.lit("&")), text, _decoded)


def decoded_nfkc(text: Column) -> Column:
    """Character references resolved, compatibility forms composed. ASCII and the letters À to ÿ are composed forms as they stand."""
    return _where(F.contains(text, F.lit("&")) | F.rlike(text, F.lit(r"[^\x00-\x7FÀ-ÿ]")), text, _decoded_nfkc)


def normalize_for_audit(text: Column, decode: bool = True, lowercase: bool = True) -> Column:
    """The form of source units: decoded, words joined over line ends, bullets as hyphens, squeezed, lower case."""
    t = decoded_nfkc(text) if decode else F.coalesce(text, F.lit(""))
    t = F.regexp_replace(t, r"\r\n?", "\n")
    t = F.regexp_replace(t, r"([A-Za-z])-\n([A-Za-z])", "$1$2")
    t = squeezed(F.translate(t, P.AUDIT_BULLETS, "-" * len(P.AUDIT_BULLETS)))
    return F.lower(t) if lowercase else t


def stable_id(*parts: Column) -> Column:
    """16 hexadecimal digits of the SHA-256 of the parts joined by bars."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts]), 256), 1, 16)


def canonical_id(audit: Column, granularity: Column, dtype: Column) -> Column:
    return F.concat(F.lit("cu:"), stable_id(audit, granularity, dtype))


def dedupe_id(audit: Column) -> Column:
    return F.concat(F.lit("dg:"), stable_id(audit))


def shingles(audit: Column, size: int = 8, limit: int = 10) -> Column:
    """Up to ``limit`` evenly spaced runs of ``size`` words of a normalised text; none if it is shorter."""

    def spread(w: Column) -> Column:
        n = F.size(w)
        step = F.greatest(F.lit(1), F.floor(n / limit).cast("int"))
        starts = F.slice(F.sequence(F.lit(1), F.greatest(F.lit(1), n - size + 1), step), 1, limit)
        some = F.transform(starts, lambda i: F.array_join(F.slice(w, i, size), " "))
        return F.when(n >= size, some).otherwise(F.array().cast("array<string>"))

    return let(words(audit), spread)


def normalize_anchor(text: Column) -> Column:
    return F.lower(squeezed(F.translate(F.coalesce(text, F.lit("")), " ", " ")))


def anchors(text: Column, pattern: str = P.REQUIRED_ANCHOR) -> Column:
    """Different normalised anchors of a text."""
    return F.array_distinct(F.transform(_all(F.coalesce(text, F.lit("")), pattern), normalize_anchor))


def anchors_of(values: Column, pattern: str = P.REQUIRED_ANCHOR) -> Column:
    """Different normalised anchors of an array of texts."""
    return F.array_distinct(F.flatten(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: anchors(v, pattern))))


def kept_candidates(found: Column) -> Column:
    """Candidate anchors without bare standard numbers of one or two digits."""
    return F.filter(found, lambda a: ~F.rlike(a, F.lit(P.BARE_STANDARD)))


def quoted(text: Column) -> Column:
    """A text as a literal inside a Java pattern."""
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def word_runs(text: Column) -> Column:
    """Longest runs of word signs and points: what the ends of a whole token are marked off by."""
    return _all(text, r"(?U)[\w.]+")


def anchor_present(anchor: Column, text: Column) -> Column:
    """Does the anchor stand in the text as a whole token?"""
    a = normalize_anchor(anchor)
    return (a != "") & F.rlike(F.concat(F.lit(" "), normalize_anchor(text), F.lit(" ")), F.concat(F.lit(r"(?U)(?<![\w.])"), quoted(a), F.lit(r"(?![\w.])")))


def tokens(text: Column) -> Column:
    """Lower-case runs of digits and Latin letters; hyphens and slashes part words."""
    return _all(F.lower(F.translate(text, "-/", "  ")), "[0-9a-zÀ-ɏ]+")


def canonical_tokens(text: Column, decode: bool = True) -> Column:
    """``tokens`` of the decoded text without tags."""
    t = decoded(text) if decode else F.coalesce(text, F.lit(""))
    return tokens(F.regexp_replace(t, r"(?U)</?\s*[A-Za-z][A-Za-z0-9:-]*(?:\s+[^<>]*?)?>", " "))


def recovery_kind(anchor: Column) -> Column:
    a = normalize_anchor(anchor)
    kinds = (("section", P.SECTION_ANCHOR), ("table", r"(?U)^table\s+\d+$"), ("figure", r"(?U)^figure\s+\d+$"), ("appendix", r"(?U)^appendix\s+[a-z]$"))
    out = F.lit("anchor")
    for name, pattern in reversed(kinds):
        out = F.when(F.rlike(a, F.lit(pattern)), name).otherwise(out)
    return out


def recovery_dtype(kind: Column) -> Column:
    return F.when(kind.isin("section", "appendix"), "title").when(kind.isin("table", "figure"), "caption").otherwise("source_pdf_recovery")


def char_count(text: Column) -> Column:
    """Characters that aren't white space."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", ""))


def snippet_for(text: Column, start: Column, end: Column, radius: int = 80) -> Column:
    """Squeezed text around places counted from 0."""
    low = F.greatest(F.lit(0), start - radius)
    return squeezed(F.substr(text, low + 1, end + radius - low))


def found_with_snippets(text: Column, pattern: str, radius: int = 80) -> Column:
    """(anchor, snippet) of every match. A match stands behind all gaps and matches before it, which splitting gives."""
    text = F.coalesce(text, F.lit(""))

    def placed(m: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        sizes = F.transform(m, F.length)
        total = lambda a: F.aggregate(a, F.lit(0), lambda x, n: x + n)

        def one(found: Column, k: Column) -> Column:
            start = total(F.slice(gaps, 1, k + 1)) + total(F.slice(sizes, 1, k))
            return F.struct(normalize_anchor(found).alias("anchor"), snippet_for(text, start, start + F.length(found), radius).alias("snippet"))

        return F.transform(m, one)

    return let(_all(text, pattern), placed)


def pseudo_box(box: Column, *places: Column) -> Column:
    """The box, else a line at the first place that is known (a height, a character, a number in order)."""
    at = F.coalesce(*[p.cast("double") for p in places], F.lit(0.0))
    return F.when(F.size(box) == 4, box.cast("array<double>")).otherwise(F.array(F.lit(0.0), at, F.lit(0.0), at))


def slug(anchor: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(normalize_anchor(anchor), "[^a-z0-9]+", "-"), "^-|-$", "")
    return F.when(s == "", "anchor").otherwise(s)


def _numbers(dotted: Column) -> Column:
    return F.transform(F.split(dotted, r"\."), lambda p: p.try_cast("bigint"))


def plausible_section(anchor: Column) -> Column:
    """Can the dotted number be that of a section?"""

    def sound(parts: Column) -> Column:
        n, first, last = F.size(parts), F.element_at(parts, 1), F.element_at(parts, -1)
        return first.between(1, 20) & (n <= 6) & ~((n >= 4) & last.isin(0, 255)) & ~((n == 2) & (last >= 100))

    return F.when(F.rlike(anchor, F.lit(P.SECTION_ANCHOR)), F.coalesce(let(_numbers(anchor), sound), F.lit(False))).otherwise(False)


def _whole(anchor: Column) -> Column:
    return F.concat(F.lit(r"(?iU)(?<![\w.])"), quoted(anchor), F.lit(r"(?![\w.])"))


def trim_to_anchor(snippet: Column, anchor: Column) -> Column:
    """From the anchor on, where it stands as a whole token; else unchanged."""
    after = F.split(snippet, _whole(anchor), 2)
    return F.when(F.rlike(snippet, _whole(anchor)), stripped(F.substr(snippet, F.length(F.element_at(after, 1)) + 1))).otherwise(snippet)


def credible_location(snippet: Column, anchor: Column) -> Column:
    """Does the snippet show the anchor itself and not a mention, a dotted leader or a value?"""
    s = squeezed(snippet)
    mention = F.rlike(F.lower(s), F.concat(F.lit(P.REFERRED), quoted(anchor), F.lit(r"\b")))
    after = stripped(F.substr(trim_to_anchor(s, anchor), F.length(anchor) + 1))
    section = plausible_section(anchor) & ~F.rlike(anchor, F.lit(r"(?U)^\d+\.\d{3,}(?:\.\d{3,})*$")) & F.rlike(after, F.lit(P.AFTER_SECTION)) & ~F.rlike(after, F.lit(P.UNIT_AFTER_SECTION))
    return (s != "") & ~F.rlike(s, F.lit(r"\.{6,}")) & ~mention & F.when(recovery_kind(anchor) == "section", section).otherwise(True)


def safe_line(line: Column, has_bbox: Column, heading_like: Column, anchor: Column) -> Column:
    """The line from the anchor on if it can stand as recovered content, else null."""
    kind = recovery_kind(anchor)
    trimmed = trim_to_anchor(squeezed(line), anchor)
    after = stripped(F.substr(trimmed, F.length(anchor) + 1))
    ok = (squeezed(line) != "") & has_bbox & credible_location(trimmed, anchor) & ~F.rlike(trimmed, F.lit("(?i)translated by google"))
    heading = F.coalesce(heading_like, F.lit(False)) & (F.size(words(after)) <= 18) & ~F.rlike(after, F.lit("[.!?;:]"))
    ok = ok & F.when(kind == "section", heading).when(kind.isin("table", "figure"), F.size(words(trimmed)) <= 24).otherwise(True)
    return F.when(ok, trimmed)


def sentence_terminal(text: Column) -> Column:
    return F.rlike(stripped(text), F.lit(r"[.!?:;)]$"))


def continuation(text: Column) -> Column:
    """Begins with a lower-case letter."""
    first = F.substring(stripped(text), 1, 1)
    return (first != "") & (first == F.lower(first)) & (first != F.upper(first))


def normalize_bullets(text: Column) -> Column:
    t = stripped(F.translate(F.coalesce(text, F.lit("")), P.DASHES_AND_BULLETS, "-" * len(P.DASHES_AND_BULLETS)))
    return F.regexp_replace(t, r"(?U)^\s*-\s*", "- ")


def repair_symbols(text: Column) -> Column:
    """Comparison signs in ASCII, also where they were read as ŷ before numbers; runs of spaces as one."""
    t = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("≤"), F.lit("<=")), F.lit("≥"), F.lit(">="))
    t = F.regexp_replace(t, r"(?iU)(?<=\d)\s*ŷ\s*(?=\d|\s*(?:bar|m3|m³|l/h|%|s|ms|V|Hz)\b)", " <= ")
    t = F.regexp_replace(t, r"(?iU)\b(pressure|flow|temperature|value|limit|max|min)\s*ŷ\s*(?=\d)", "$1 <= ")
    return stripped(F.regexp_replace(t, r"(?U)\s{2,}", " "))


def footnote_start(text: Column) -> Column:
    return F.rlike(F.coalesce(text, F.lit("")), F.lit(P.FOOTNOTE_START))


def section_number(text: Column) -> Column:
    """The dotted number that a text begins with, else null. Not footnotes, shares, labels, single numbers over 50."""
    t = F.coalesce(text, F.lit(""))
    number = F.regexp_extract(t, r"(?U)^\s*(?>(\d+(?:\.\d+)*)\b)(?![%:])", 1)
    ok = (number != "") & ~footnote_start(t) & (F.contains(number, F.lit(".")) | F.coalesce(number.try_cast("bigint") <= 50, F.lit(False)))
    return F.when(ok, number)


def section_anchor(text: Column) -> Column:
    """``section_number`` as numbers."""
    return _numbers(section_number(text))


def numbered_anchor(text: Column, label: str) -> Column:
    """The first number behind the label (Table or Figure), else null."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), rf"(?iU)\b{label}\s+(\d+)\b", 1).try_cast("bigint")


def latin_words(audit: Column) -> Column:
    return _all(F.lower(F.coalesce(audit, F.lit(""))), "[a-zà-ÿ]+")


def listed(found: Column, names: list[str]) -> Column:
    """How many of the words are listed."""
    return F.size(F.filter(found, lambda w: w.isin(*names)))


def mixed_foreign(audit: Column, terms: list[str]) -> Column:

    def mixed(w: Column) -> Column:
        foreign = listed(w, terms)
        return (foreign >= 2) & (listed(w, P.ENGLISH_CONTEXT) >= 2) & (foreign / F.greatest(F.size(w), F.lit(1)) < 0.4)

    return let(latin_words(audit), mixed)


def suspicious_unit(number: Column, unit: Column) -> Column:
    low = F.lower(unit)
    first = F.substring(unit, 1, 1)
    capital = (first == F.upper(first)) & (first != F.lower(first))
    large = F.rlike(number, F.lit(r"(?U)^\d+$")) & F.coalesce(number.try_cast("bigint") >= 1000, F.lit(True))
    return F.rlike(unit, F.lit("[A-Za-z]")) & ~F.contains(number, F.lit(".")) & ~large & ~low.isin(*P.KNOWN_UNITS, *P.NON_UNIT_WORDS) & ~F.startswith(low, F.lit("m3")) & ~capital & (F.length(unit) <= 4)


def number_unit_pairs(text: Column, pattern: str = P.NUMBER_AND_UNIT) -> Column:
    """(n, u) of each number with its unit."""
    return let(text, lambda t: F.arrays_zip(_all(t, pattern, 1).alias("n"), _all(t, pattern, 2).alias("u")))


def first_suspicious(text: Column, pairs=number_unit_pairs) -> Column:
    """The first suspicious number with its unit, else null."""
    found = F.filter(pairs(F.coalesce(text, F.lit(""))), lambda p: suspicious_unit(p["n"], p["u"]))
    first = let(found, lambda bad: F.when(F.size(bad) > 0, F.concat_ws(" ", bad[0]["n"], bad[0]["u"])))
    return F.when(F.rlike(text, F.lit(r"(?U)\d")), first)


def code_line(text: Column) -> Column:
    t = stripped(text)
    return t.isin("{", "}", "[", "]") | F.rlike(t, F.lit(r"(?U)^[A-Za-z_][A-Za-z0-9_]*\s*:")) | F.contains(t, F.lit("::="))


def common_subheading(text: Column) -> Column:
    label = F.lower(squeezed(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s*\d+(?:\.\d+)*\s+", "")))
    return label.isin(*P.SUBHEADINGS) | F.regexp_replace(label, r"^[()]+|[()]+$", "").isin(*P.SUBHEADINGS)


def protocol_expression(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return F.contains(t, F.lit("||")) & F.rlike(t, F.lit(P.PROTOCOL_WORDS))


def safe_placeholder(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    rest = F.regexp_replace(t, P.PLACEHOLDER, "")
    return F.rlike(t, F.lit(P.PLACEHOLDER)) & ~F.contains(rest, F.lit("<<")) & ~F.contains(rest, F.lit(">>"))


@F.pandas_udf(StringType())
def review_item_id(rule: pd.Series, reason: pd.Series, refs: pd.Series, found: pd.Series, pages_json: pd.Series) -> pd.Series:
    """The id of a review item: a hash of its content as compact sorted JSON."""

    def one(r, why, ref, anchor, pages) -> str:
        payload = {"rule_id": r, "reason": why, "refs": sorted({str(x) for x in (ref if ref is not None else ()) if x}), "anchors": sorted(str(x) for x in (anchor if anchor is not None else ()) if x), "pages": json.loads(pages) if pages else []}
        data = json.dumps(payload, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        return f"review:{r or 'unknown'}:{hashlib.sha256(data.encode()).hexdigest()[:20]}"

    return pd.Series([one(*row) for row in zip(rule, reason, refs, found, pages_json, strict=True)], dtype=object)


def html_escaped(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        t = F.replace(t, F.lit(sign), F.lit(name))
    return t
