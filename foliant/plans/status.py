"""Statuses of documents in one pass: what ``run_audit(...).status`` gives, without its tables of blocks, items and losses.

For documents in blocks whose audit text is the raw one in the form of output blocks
(``text.normalize_audit``) and without evidence. All windows go over a document in reading
order, so units that were dealt out by document are sorted once and shuffled no more.

An output block that shows its blocks' tokens loses nothing, so tokens are only compared
where a repair changed them. What a row and its neighbours can't decide is left open
(column ``whole``), for the whole plan: documents with units that D0 or A1 may bring
together, with a page that may have lost too many tokens, with an anchor that its own
output block doesn't show as such, and units that aren't in the order of their inventory.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..functions import units as U
from ..operators import completeness as C
from ..operators import detectors as D

NEEDED = ("doc_id", "ord", "unit_id", "granularity", "page", "dtype", "raw_text", "audit_text", "x0", "y0", "x1", "y1", "page_width", "page_height", "recovery")


ORDER = ("at_page", "at_y0", "at_x0", "at_ord")
#: White space that squeezing or stripping changes.
ODD_SPACE = r"(?U)[\s&&[^ ]]|^ | (?: |$)"
#: Eight of ``text.tokens`` in a text in lower case.
EIGHT_TOKENS = "^(?:[^0-9a-zÀ-ɏ]*+[0-9a-zÀ-ɏ]++){8}"


def _is(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _one(c: Column) -> Column:
    return _is(c).cast("int")


def _anchors(text: Column) -> Column:
    """Anchors of both kinds, each marked by its kind."""
    kinds = [F.transform(T.anchors(text, P.REQUIRED_ANCHOR), lambda a: F.concat(F.lit("r"), a)), F.transform(T.kept_candidates(T.anchors(text, P.CANDIDATE_ANCHOR)), lambda a: F.concat(F.lit("c"), a))]
    return F.concat(*kinds)


def _covered(tokens: Column, shown: Column) -> Column:
    """How many of the tokens are shown, as multisets."""
    count = lambda a, t: F.size(F.filter(a, lambda x: x == t))
    return F.aggregate(F.array_distinct(tokens), F.lit(0), lambda n, t: n + F.least(count(tokens, t), count(shown, t)))


def _eight(low: Column) -> Column:
    """Has a text with tags or references eight tokens? Null where only decoding could tell.

    References are resolved within a word, so the tokens of other words are sure, unless a tag may begin.
    """
    tokens = F.size(T.canonical_tokens(low, False))
    others = F.rlike(F.regexp_replace(low, "[^ ]*&[^ ]*", " "), F.lit(EIGHT_TOKENS))
    sure = others & ~F.contains(low, F.lit("<")) & ~F.rlike(low, F.lit("&(?:#|n?v?lt)"))
    return F.when(~F.rlike(low, F.lit("&[^\\t\\n\\f <&;]")), tokens >= 8).when(sure, True)


def _rows(units: DataFrame, terms: list[str]) -> DataFrame:
    """Blocks with what is known of each by itself. Before a costly search a cheap one leaves out texts that can't have what is looked for."""
    raw, st, low, odd, digit = F.coalesce("raw_text", F.lit("")), F.col("st"), F.col("low"), F.col("odd"), F.col("digit")
    rows = units.select(*NEEDED, F.rlike(raw, F.lit(ODD_SPACE)).alias("odd"), F.rlike(raw, F.lit(r"(?U)\d")).alias("digit"), U.safe_discard().alias("gone"))
    rows = rows.withColumns({"st": F.when(odd, T.stripped(F.col("raw_text"))).otherwise(raw), "low": F.lower(F.when(odd, T.squeezed(F.col("raw_text"))).otherwise(raw))}).withColumn("audit_text", low)
    rules = {k: cond for k, (cond, _, _) in D.row_rules(F.lit(False), terms).items() if k != "C3"}
    for k in ("A3", "A4", "C1"):
        rules[k] = F.when(digit, rules[k])
    rules["C2"] = F.when((U.edge("y0") <= 50) | (U.edge("y0") >= 760), rules["C2"])
    rules["D3"] = F.when(F.contains(raw, F.lit("|")), rules["D3"])
    rules["E2"] = F.when(digit & F.rlike(raw, F.lit(r"(?U)\d\s+[A-Za-zµ³/%]")), rules["E2"])
    rules["E3"] = F.when(reduce(or_, [F.contains(raw, F.lit(x)) for x in P.CORRUPTION.replace("\\", "").split("|")]), rules["E3"])
    number = F.when(digit & F.rlike(raw, F.lit(r"(?U)^\s*\d")), T.section_number(raw))
    inside = F.when(digit & (U.is_type(P.TABLE_TYPES) | F.contains(low, F.lit("<table"))), F.transform(D.embedded_numbers(raw), lambda e: e["number"]))
    plain = ~F.contains(low, F.lit("<")) & ~F.contains(low, F.lit("&"))
    ascii_only = F.octet_length(raw) == F.length(raw)
    repaired = odd | F.startswith(raw, F.lit("-")) | F.when(ascii_only, False).otherwise(F.rlike(raw, F.lit(f"[{P.DASHES_AND_BULLETS}≤≥ŷŶ]")))
    first = F.substring(st, 1, 1)
    mixed = F.when(reduce(or_, [F.contains(low, F.lit(x)) for x in P.ENGLISH_CONTEXT]), T.mixed_foreign(low, terms))
    own = F.col("review") & ~U.is_type(P.EDGE_TYPES)
    named = F.col("review") & reduce(or_, [F.contains(low, F.lit(t)) for t in P.ORDERED_TERMS])
    use = F.contains(low, F.lit("defined")) & F.rlike(low, F.lit(r"(?U)\bdefined\b")) & ~U.is_type(P.FOOTNOTE_TYPES) & ~_is(F.contains(F.col("unit_id"), F.lit("discarded_blocks")))
    for elsewhere in P.DEFINED_ELSEWHERE:
        use = use & ~F.contains(low, F.lit(elsewhere))
    rows = rows.withColumns({
        "review": ~F.col("gone"),
        "title": U.is_type(P.TITLE_TYPES),
        "textual": U.is_type(P.TEXT_TYPES),
        "blank": st == "",
        "ended": F.rlike(F.right(st, F.lit(2)), F.lit(r"[.!?:;)]$")),
        "goes_on": (first != "") & (first == F.lower(first)) & (first != F.upper(first)),
        "code": F.when(F.contains(raw, F.lit(":")) | (F.length(st) == 1), T.code_line(F.col("raw_text"))).otherwise(False),
        "numbers": F.when(digit, F.array_compact(F.concat(F.array(number), F.coalesce(inside, F.array().cast("array<string>"))))).otherwise(F.array().cast("array<string>")),
        **{f"nth_{label}": F.when(digit & F.rlike(raw, F.lit(rf"(?iU)\b{label}\s+\d")) & U.numbered_source(label), T.numbered_anchor(F.col("raw_text"), label)) for label in ("Table", "Figure")},
        "hits": F.when(~F.col("gone"), reduce(add, [_one(c) for c in rules.values()])).otherwise(0),
        "alone": F.when(digit | (F.length(st) == 1), U.toc_number() | U.left_isolated_section()).otherwise(U.is_type(("toc_number",)) | (F.substring(st, 2, 1) == ".")),
        "asked": _is(F.col("recovery")["requires_review"]),
        "fixed": F.when(repaired, T.repair_symbols(T.normalize_bullets(F.col("raw_text")))).otherwise(raw),
        "marked": digit | F.rlike(low, F.lit("(?iU)appendix")),
        "plain": plain,
        "long": F.when(plain, F.rlike(low, F.lit(EIGHT_TOKENS))).otherwise(_eight(low)),
    })
    return rows.withColumns({
        "short": F.col("textual") & ~F.col("ended") & ~F.col("code") & ~F.rlike(st, F.lit(r"(?U)^\S+\s+\S+\s+\S")),
        "mixed": _one(F.col("review") & mixed),
        "own": own,
        "defined": F.when(named, F.lower(T.stripped(F.regexp_extract(raw, P.DEFINITION, 1)))),
        "used": F.when(named & use, low),
    }).drop("odd", "digit", "audit_text")


def _in_order(rows: DataFrame) -> DataFrame:
    """Each block with its neighbours: ``a`` stands before it, ``r`` is the last to review, ``h`` the last that parts headings."""
    # by columns: windows over expressions are sorted anew, each by itself
    rows = rows.withColumns(dict(zip(ORDER, U.order(), strict=True)))
    w = Window.partitionBy("doc_id").orderBy(*ORDER)
    before, up_to, all_of = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = lambda cond, value, frame: F.last(F.when(cond, value), ignorenulls=True).over(frame)
    review, short, place = F.col("review"), F.col("short"), F.col("place")
    # what is sampled: of the blocks kept, but which are discarded is only known when fragments are joined
    rows = rows.withColumns({
        "place": F.row_number().over(w),
        "a": F.lag(F.struct("ord", "page", "textual", "x0", "y0", "y1", "ended", "st", "low", "alone", "marked", "plain")).over(w),
        "r": last(review, F.struct("unit_id", "page", "dtype", "raw_text", "x0", "y0", "x1", "y1", "ended", "code"), before),
        "h": last(review & (F.col("title") | ~F.col("blank")), F.struct("unit_id", "page", "dtype", F.when(F.col("title"), F.col("raw_text")).alias("raw_text"), "y0", "y1", "recovery"), before),
        "any_mixed": F.max("mixed").over(all_of),
        "shorts": F.sum(F.when(review & short, 1).otherwise(0)).over(up_to),
        "number_before": last(review & (F.size("numbers") > 0), F.element_at("numbers", -1), before),
        **{f"{c}_before": last(review, F.col(c), before) for c in ("nth_Table", "nth_Figure")},
    })
    gap = U.edge("y0") - U.edge("y1", "a.")
    # a pair whose blocks D0 or A1 took isn't joined; such documents are left to the whole plan
    joinable = F.col("a").isNotNull() & F.col("a.page").eqNullSafe(F.col("page")) & (F.col("a.textual") | F.col("textual")) & gap.between(0, 12) & (F.abs(U.edge("x0", "a.") - U.edge("x0")) <= 12) & ~F.col("a.ended") & F.col("goes_on")
    rows = rows.withColumn("joinable", _is(joinable))
    rows = rows.withColumns({
        "run": place - F.coalesce(last(~F.col("joinable"), place, up_to), F.lit(0)),
        "shorts_before": F.coalesce(last(review & ~short & ~F.col("blank"), F.col("shorts"), up_to), F.lit(0)),
    }).withColumn("second", F.col("run") % 2 == 1)
    rows = rows.withColumn("first", F.lead("second", 1, False).over(w))
    rows = rows.withColumn("live", ~F.col("gone") | F.col("first") | F.col("second"))
    rows = rows.withColumn("candidate", F.col("live") & ~F.col("asked") & _is(F.col("long")))
    counted = F.sum(_one(F.col("candidate")))
    rows = rows.withColumns({"i": counted.over(up_to) - 1, "of": counted.over(all_of)})
    i, n, stride, half = F.col("i"), F.col("of"), F.greatest(F.lit(1), F.floor(F.col("of") / 5)), F.floor(F.col("of") / 2)
    # of the multiples of the stride, the middle and the last the first eight
    nth = F.ceil(i / stride) + _one((half < i) & (half % stride != 0))
    rows = rows.withColumn("sampled", F.col("candidate") & ((n <= 8) | (i == n - 1) | (i == half) | (i % stride == 0)) & (nth < 8))
    return rows.withColumn("a_sampled", F.lag("sampled", 1, False).over(w))


def _jumps() -> Column:
    """How many of the block's section numbers skip some after the number before."""
    canon = lambda c: F.transform(F.split(c, r"\."), lambda p: p.try_cast("bigint"))
    befores = F.concat(F.array("number_before"), F.col("numbers"))

    def jump(number: Column, k: Column) -> Column:
        def judged(ab: Column) -> Column:
            a, b = ab["a"], ab["b"]
            n = F.size(b)
            deep = (F.size(a) == n) & (F.slice(a, 1, n - 1) == F.slice(b, 1, n - 1)) & (F.element_at(b, -1) > F.element_at(a, -1) + 1)
            return F.when(n > 1, deep).otherwise((F.size(a) == 1) & (b[0] > a[0] + 1))

        before = F.get(befores, k)
        return before.isNotNull() & T.let(F.struct(canon(before).alias("a"), canon(number).alias("b")), judged)

    return F.when(F.col("review") & (F.size("numbers") > 0), F.size(F.filter(F.transform("numbers", jump), lambda j: _is(j)))).otherwise(0)


def _judged(rows: DataFrame, terms: list[str]) -> DataFrame:
    """Each block with its items, its lost tokens and what speaks for the whole plan."""
    first, second, low, a_low = F.col("first"), F.col("second"), F.col("low"), F.col("a.low")
    merged = F.concat(F.col("a.st"), F.lit(" "), F.col("st"))
    fixed = ~second & ~F.col("gone") & (F.col("fixed") != F.coalesce("raw_text", F.lit("")))
    marked = F.col("marked") | second & F.col("a.marked")
    # a first block's text stands in its second one, discarded ones stand nowhere, and most others show their own text
    tells = ~first & F.col("live") & (second & (marked | ~F.col("plain") | ~F.col("a.plain")) | fixed)
    rows = rows.withColumn("shown", F.when(tells, T.normalize_audit(F.when(second, merged).otherwise(F.col("fixed")))))
    told = F.col("shown").isNotNull() & (second | (F.col("shown") != low))
    astray = F.when(told & marked, F.size(F.array_except(F.when(second, F.concat(_anchors(a_low), _anchors(low))).otherwise(_anchors(low)), _anchors(F.col("shown")))) > 0)
    changed = told & F.when(second, ~(F.col("a.plain") & F.col("plain"))).otherwise(True)
    rows = rows.withColumns({"changed": changed, "astray": _is(astray)})
    tokens = lambda text: F.when(F.col("changed"), T.canonical_tokens(F.when(F.col("changed"), text)))
    rows = rows.withColumns({"tokens": tokens(low), "a_tokens": F.when(second, tokens(a_low)), "out": tokens(F.col("shown"))})
    rows = rows.withColumn("both", F.when(second, F.concat("a_tokens", "tokens")).otherwise(F.col("tokens")))
    rows = rows.withColumn("changed", F.col("changed") & (F.col("both") != F.col("out")))
    low_share = lambda tokens: _covered(tokens, F.col("out")) / F.size(tokens) < C.SAMPLE_THRESHOLD
    review = F.col("review")
    # only where a block mixes languages it matters which one the document has
    foreign = F.col("own") & (F.col("any_mixed") > 0)
    rows = rows.withColumn("w", F.when(foreign, T.latin_words(low)))
    b3 = (F.col("page") == F.col("r.page") + 1) & (U.edge("y0", "r.") >= 730) & (U.edge("y0") <= 80) & ~F.col("r.ended") & F.col("goes_on") & ~F.col("r.code") & ~F.col("code")
    c4 = (F.coalesce("page", F.lit(0)) == F.coalesce("r.page", F.lit(0))) & (U.edge("x0") - U.edge("x1", "r.") > 80) & (F.abs(U.middle("r.") - U.middle()) <= 4) & U.is_type(("text",), "r.") & U.is_type(("text",))
    c4 = F.when(F.col("r.unit_id").isNotNull() & F.col("unit_id").isNotNull() & c4, ~U.column_pair_exempt("r.", ""))
    a5 = F.when(F.col("title") & U.is_type(P.TITLE_TYPES, "h."), ~U.heading_pair_exempt("h.", ""))
    b2 = F.col("short") & (F.col("shorts") - F.col("shorts_before") >= 3)
    f2 = [F.col(f"nth_{x}") > F.col(f"nth_{x}_before") + 1 for x in ("Table", "Figure")]
    items = F.col("hits") + F.when(review, reduce(add, [_one(c) for c in (a5, b2, b3, c4, *f2)])).otherwise(0) + 2 * _jumps()
    same_page = F.coalesce("page", F.lit(0)) == F.coalesce("a.page", F.lit(0))
    rise = F.when(same_page, U.middle() - U.middle("a."))
    return rows.select(
        "doc_id", "page", "place", "defined", "used", "mixed", F.when(foreign, F.size("w")).otherwise(0).alias("latin"), F.when(foreign, T.listed(F.col("w"), terms)).otherwise(0).alias("foreign"), "asked", "candidate", "alone", items.alias("items"),
        F.when(F.col("candidate"), 8).otherwise(0).alias("size"),  # at least
        F.when(F.col("changed"), F.size("both") - _covered(F.col("both"), F.col("out"))).otherwise(0).alias("lost"),
        (F.col("live") & (low != "")).alias("full"),
        (~first & F.col("live") & F.when(F.col("shown").isNotNull(), F.col("shown") != "").otherwise((low != "") | _is(second & (a_low != "")))).alias("there"),
        _is(F.when(F.col("changed"), F.col("sampled") & low_share(F.col("tokens")) | second & F.col("a_sampled") & low_share(F.col("a_tokens")))).alias("failed"),
        (F.col("astray") | F.col("long").isNull() | F.col("doc_id").isNull() | F.col("page").isNull() | (F.col("granularity") != "block") | _is(F.col("ord") <= F.col("a.ord")) | _is((F.col("alone") | F.col("a.alone")) & (rise <= 8))).alias("whole"),
        _is(rise < 0).alias("falls"),
    )


def statuses(units: DataFrame, threshold: float = C.THRESHOLD, terms: list[str] = P.ITALIAN_TERMS) -> DataFrame:
    """doc_id, n_loss, n_review, status, whole: for every document that isn't ``whole`` the status of ``run_audit``; the others are for it."""
    rows = _judged(_in_order(_rows(units, terms)), terms)
    place = F.col("place")
    marks = {}
    for k, t in enumerate(P.ORDERED_TERMS):
        marks[f"d{k}"] = F.min(F.when(F.col("defined") == t, place))
        marks[f"u{k}"] = F.min(F.when(F.rlike("used", F.lit(rf"(?U)\b{t}\b")), place))
    sums = ("items", "mixed", "latin", "foreign", "size", "lost")
    flags = ("asked", "candidate", "alone", "full", "there", "failed", "whole", "falls")
    pages = rows.groupBy("doc_id", "page").agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in flags], *[c.alias(n) for n, c in marks.items()])
    # tokens lost by one block may stand in another, so the share is a lower bound
    few = (F.col("lost") > 0) & ((F.col("size") <= F.col("lost")) | _is((F.col("size") - F.col("lost")) / F.nullif(F.col("size"), F.lit(0)) < threshold))
    docs = pages.groupBy("doc_id").agg(*[F.sum(c).alias(c) for c in ("items", "mixed", "latin", "foreign")], *[F.max(c).alias(c) for c in flags if c != "whole"], F.max(F.col("whole") | few).alias("whole"), F.max(F.col("full") & ~F.col("there")).alias("missing"), *[F.min(n).alias(n) for n in marks])
    dominant = (F.col("latin") >= 20) & (F.col("foreign") / F.col("latin") >= 0.06)
    early = [_one(F.col(f"u{k}").isNotNull() & (F.col(f"d{k}").isNull() | (F.col(f"d{k}") > F.col(f"u{k}")))) for k in range(len(P.ORDERED_TERMS))]
    reviews = F.col("items") + F.when(dominant, 0).otherwise(F.col("mixed")) + reduce(add, early) + _one(F.col("asked")) + _one(F.col("failed") | (F.col("full") & ~F.col("candidate")))
    found = docs.select("doc_id", _one(F.col("missing")).cast("bigint").alias("n_loss"), reviews.cast("bigint").alias("n_review"), (F.col("whole") | (F.col("alone") & F.col("falls"))).alias("whole"))
    return found.select("doc_id", "n_loss", "n_review", C.status_of(F.col("n_loss"), F.col("n_review")).alias("status"), "whole")
