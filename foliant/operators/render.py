"""Rendering and what is checked after it: blocks and documents as HTML, anchors, clipping, status, reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T


def block_html() -> Column:
    """An output block (raw_text, operation, disposition) as HTML; tables go through without scripts and handlers."""
    raw = F.coalesce(F.col("raw_text"), F.lit(""))
    clean = F.regexp_replace(F.regexp_replace(raw, r"(?is)<(script|style|iframe|object|embed)\b.*?(</\1\s*>|$)", ""), r"(?is)\s(on\w+|srcdoc)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", "")
    clean = F.regexp_replace(clean, r"(?is)(href|src)\s*=\s*([\"']?)\s*javascript:", "$1=$2#")
    table = F.rlike(raw, F.lit(r"(?is)^\s*<table[\s>].*</table>\s*$"))
    escaped = T.html_escaped(raw)
    head = F.regexp_extract(raw, r"(?s)^(.*) [^ ]*$", 1)
    has_space = F.contains(raw, F.lit(" "))
    title, page = F.when(has_space, head).otherwise(raw), F.when(has_space, F.regexp_extract(raw, " ([^ ]*)$", 1)).otherwise("")
    number = F.regexp_extract(raw, r"(?U)^\s*(\d+(?:\.\d+)*)\s+.", 1)
    level = F.least(F.lit(4), F.length(number) - F.length(F.replace(number, F.lit("."), F.lit(""))) + 1).cast("string")
    return (
        F.when(F.col("disposition") == "discarded", "")
        .when(table, clean)
        .when(F.col("operation") == "TOC_three_column_repair", F.concat(F.lit('<div class="toc-row"><span>'), T.html_escaped(title), F.lit("</span><span>"), T.html_escaped(page), F.lit("</span></div>")))
        .when(F.startswith(raw, F.lit("- ")), F.concat(F.lit("<li>"), T.html_escaped(T.stripped(F.substr(raw, F.lit(3)))), F.lit("</li>")))
        .when(number != "", F.concat(F.lit("<h"), level, F.lit(">"), escaped, F.lit("</h"), level, F.lit(">")))
        .otherwise(F.concat(F.lit("<p>"), escaped, F.lit("</p>")))
    )


def document_html(output: DataFrame, title: str = "Repaired document") -> DataFrame:
    """doc_id, html: every document's blocks in their order as one page."""
    parts = F.array_sort(F.collect_list(F.struct("phase", "seq", block_html().alias("html"))))
    body = F.array_join(F.transform(parts, lambda p: p["html"]), "\n")
    page = F.concat(F.lit('<!doctype html>\n<html lang="en">\n<head><meta charset="utf-8"><title>'), T.html_escaped(F.lit(title)), F.lit("</title></head>\n<body>\n"), body, F.lit("\n</body>\n</html>\n"))
    return output.groupBy("doc_id").agg(page.alias("html"))


def missing_after_render(expected: DataFrame, rendered: DataFrame) -> DataFrame:
    """Anchors (doc_id, anchor) of the output that the rendered texts (doc_id, text) lack."""
    there = rendered.select("doc_id", F.explode(T.anchors(F.col("text"), P.REQUIRED_ANCHOR)).alias("anchor"))
    return expected.select("doc_id", T.normalize_anchor(F.col("anchor")).alias("anchor")).distinct().join(there, ["doc_id", "anchor"], "left_anti")


def empty_renders(rendered: DataFrame) -> DataFrame:
    """doc_id of rendered texts without content."""
    return rendered.filter(T.stripped(F.col("text")) == "").select("doc_id")


def clipped(boxes: DataFrame, margin: float = 2.0) -> DataFrame:
    """Rows of drawn boxes (x0..y1) outside their page (px0..py1) by more than the margin."""
    return boxes.filter((F.col("x0") < F.col("px0") - margin) | (F.col("y0") < F.col("py0") - margin) | (F.col("x1") > F.col("px1") + margin) | (F.col("y1") > F.col("py1") + margin))


def post_status(status: DataFrame, losses: DataFrame) -> DataFrame:
    """doc_id, status, render_status after rendering; ``losses``: a doc_id for each loss of I1 to I3."""
    lost = losses.select("doc_id").distinct().withColumn("lost", F.lit(True))
    bad = F.col("lost").isNotNull()
    return status.join(lost, "doc_id", "left").select("doc_id", F.when(bad, "review").otherwise(F.coalesce("status", F.lit("draft"))).alias("status"), F.when(bad, "review").otherwise("pass").alias("render_status"))


def delivery_status(wanted: Column, created: Column, exists: Column) -> Column:
    """'html_only' if no PDF is wanted, 'delivered' if it was made and is there, else 'failed'."""
    return F.when(~wanted, "html_only").when(created & exists, "delivered").otherwise("failed")


def findings_by_rule(items: DataFrame) -> DataFrame:
    """rule_id, severity, n, docs over the corpus."""
    return items.groupBy("rule_id", "severity").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs"))


def post_losses(expected: DataFrame, rendered: DataFrame, boxes: DataFrame | None = None) -> DataFrame:
    """doc_id, rule_id, reason, n: what rendering lost, by rule; boxes: drawn boxes of a paged artefact, for I3."""
    found = [(empty_renders(rendered), "I1", "rendered_text_empty"), (missing_after_render(expected, rendered), "I2", "required_anchor_missing_after_render")]
    if boxes is not None:
        found.append((clipped(boxes), "I3", "rendered_content_outside_page_bounds"))
    each = [df.select("doc_id", F.lit(rule).alias("rule_id"), F.lit(reason).alias("reason")) for df, rule, reason in found]
    return reduce(DataFrame.unionByName, each).groupBy("doc_id", "rule_id", "reason").agg(F.count("*").alias("n"))


def audit_summary(counts: DataFrame) -> DataFrame:
    """doc_id, summary: the counts of ``completeness.audit_counts`` as lines."""
    said = (
        ("G1", "source pages: ", "g1_pages", "; missing pages: ", "g1_missing"), ("G2", "low coverage pages: ", "g2_low"), ("G3", "required anchors: ", "g3_anchors", "; missing: ", "g3_missing"),
        ("G3C", "candidate anchors: ", "g3c_anchors", "; missing: ", "g3c_missing"), ("G4", "figure/table anchors: ", "g4_anchors", "; missing: ", "g4_missing"), ("G5", "sampled blocks: ", "g5_blocks", "; failed: ", "g5_failed"),
    )
    lines = [F.concat(F.lit(f"- `{rule}` "), *[F.col(x).cast("string") if x.startswith("g") else F.lit(x) for x in rest]) for rule, *rest in said]
    return counts.select("doc_id", F.concat_ws("\n", *lines).alias("summary"))


def report(status: DataFrame, post: DataFrame, items: DataFrame, fixed: DataFrame, lost: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """doc_id, markdown: status, losses and open items (doc_id, rule_id, severity, reason), repairs (doc_id, rule_id, fixed).

    ``lost``: see ``post_losses``; ``counts``: see ``completeness.audit_counts``.
    """

    def lines(df: DataFrame, text: Column, name: str) -> DataFrame:
        return df.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("- `"), "rule_id", F.lit("` "), F.coalesce(text, F.lit(""))))), "\n").alias(name))

    parts = [lines(items.filter("severity = 'content_loss'"), F.col("reason"), "loss"), lines(items.filter("severity = 'needs_review'"), F.col("reason"), "review"), lines(fixed, F.col("fixed"), "fixed")]
    both = status.select("doc_id", F.col("status").alias("before")).join(post.select("doc_id", F.col("status").alias("after")), "doc_id", "left")
    none = F.lit(None).cast("string")
    after = [lines(lost, F.col("reason"), "after_lines")] if lost is not None else []
    told = [audit_summary(counts)] if counts is not None else []
    for part in (*parts, *after, *told):
        both = both.join(part, "doc_id", "left")
    rest = F.concat(F.coalesce(F.concat(F.col("after_lines") if after else none, F.lit("\n")), F.lit("")), F.coalesce(F.concat(F.lit("\n## Audit summary\n\n"), F.col("summary") if told else none, F.lit("\n")), F.lit("")))
    agreed = F.when(F.col("before").eqNullSafe(F.col("after")), F.col("before")).otherwise("review")
    sections = [F.concat(F.lit(f"\n\n## {title}\n\n"), F.coalesce(c, F.lit("- none"))) for title, c in (("Content loss", "loss"), ("Needs review", "review"), ("Auto fixed", "fixed"))]
    return both.select("doc_id", F.concat(F.lit("# Repair report\n\nStatus: `"), agreed, F.lit("`"), *sections, F.lit("\n\n## Post render\n\n- Status: `"), F.coalesce("after", F.lit("unknown")), F.lit("`\n"), rest).alias("markdown"))
