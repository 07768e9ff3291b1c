"""Independent evidence from the source file: pages, media, anchors, gaps, recovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..functions import units as U
from .completeness import live_blocks, missing_anchors


def pages_without_inventory(pages: DataFrame, units: DataFrame) -> DataFrame:
    """G1P: doc_id, page of source pages with text, images or drawings that no unit stands on."""
    marks = [F.coalesce(F.col(c), F.lit(0)) for c in ("text_chars", "image_count", "drawing_count")]
    seen = pages.filter((marks[0] != 0) | (marks[1] != 0) | (marks[2] != 0)).select("doc_id", F.coalesce("page", F.lit(0)).alias("page")).distinct()
    return seen.join(units.select("doc_id", F.coalesce("page", F.lit(0)).alias("page")), ["doc_id", "page"], "left_anti")


def media_without_output(pages: DataFrame, units: DataFrame, output: DataFrame) -> DataFrame:
    """G4M: doc_id, page, images, drawings of pages with significant media but no emitted media unit.

    Where significant images weren't counted, all images of a page without text count.
    """
    cited = live_blocks(output).select("doc_id", F.explode("source_refs").alias("unit_id")).distinct()
    media = units.filter(F.lower(F.coalesce("dtype", F.lit(""))).isin(*P.MEDIA_TYPES)).join(cited, ["doc_id", "unit_id"], "left_semi").select("doc_id", F.coalesce("page", F.lit(0)).alias("page"))
    images = F.coalesce("significant_image_count", F.when(F.coalesce("text_chars", F.lit(0)) == 0, F.coalesce("image_count", F.lit(0))).otherwise(0))
    counted = pages.select("doc_id", F.coalesce("page", F.lit(0)).alias("page"), images.cast("bigint").alias("images"), F.coalesce("significant_drawing_count", F.lit(0)).cast("bigint").alias("drawings"))
    return counted.filter("images > 0 or drawings > 0").join(media, ["doc_id", "page"], "left_anti")


def page_anchors(hits: DataFrame) -> DataFrame:
    """doc_id, page, anchor_count of pages with anchors."""
    return hits.groupBy("doc_id", "page").agg(F.count_distinct("anchor").alias("anchor_count"))


def grouped_locations(hits: DataFrame, most: int = 20) -> DataFrame:
    """doc_id, anchor, places, locations: the first ``most`` places of each anchor, in their order."""
    w = Window.partitionBy("doc_id", "anchor").orderBy("hit_ord")
    first = hits.withColumn("nth", F.row_number().over(w))
    place = F.struct("hit_ord", "page", "snippet", "x0", "y0", "x1", "y1", "heading_like")
    shown = F.array_sort(F.collect_list(F.when(F.col("nth") <= most, place)))
    return first.groupBy("doc_id", "anchor").agg(F.count("*").alias("places"), shown.alias("locations"))


def structural_anchors(hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """G3P: required anchors with a credible place, and the places of those without; up to five each."""
    shaped = hits.filter(F.rlike("anchor", F.lit(P.REQUIRED_ANCHOR))).withColumn("credible", T.credible_location(F.col("snippet"), F.col("anchor")))
    w = Window.partitionBy("doc_id", "anchor")
    judged = shaped.withColumn("any", F.bool_or("credible").over(w))
    first = lambda df: df.withColumn("nth", F.row_number().over(w.orderBy("hit_ord"))).filter("nth <= 5").drop("nth", "any", "credible")
    return first(judged.filter("credible")), first(judged.filter("not any"))


def evidence_anchor_loss(hits: DataFrame, output: DataFrame) -> DataFrame:
    """G3P: doc_id, anchor of credible source anchors that the output lost."""
    return missing_anchors(structural_anchors(hits)[0].select("doc_id", "anchor").distinct(), live_blocks(output).select("doc_id", U.content().alias("text")))


def skipped_anchors(items: DataFrame) -> DataFrame:
    """The rows of ``items`` with ``missing``: the anchors between previous and current of A2, F1 and F2."""
    low, high = F.col("previous").try_cast("bigint"), F.col("current").try_cast("bigint")
    between = lambda a, b: F.when(b > a + 1, F.sequence(a + 1, b - 1)).otherwise(F.array().cast("array<bigint>"))
    a, b = (F.split(c, r"\.") for c in ("previous", "current"))
    n = F.size(b)
    same = (F.size(a) == n) & (F.array_join(F.slice(a, 1, n - 1), ".") == F.array_join(F.slice(b, 1, n - 1), "."))
    stem = F.array_join(F.slice(b, 1, n - 1), ".")
    last = between(F.element_at(a, -1).try_cast("bigint"), F.element_at(b, -1).try_cast("bigint"))
    sections = F.when(F.coalesce(same, F.lit(False)), F.transform(last, lambda k: F.when(n > 1, F.concat(stem, F.lit("."), k.cast("string"))).otherwise(k.cast("string"))))
    label = F.when(F.contains("reason", F.lit("table_number_sequence_gap")), "table ").when(F.contains("reason", F.lit("figure_number_sequence_gap")), "figure ")
    captions = F.transform(between(low, high), lambda k: F.concat(label, k.cast("string")))
    missing = F.when(label.isNotNull(), captions).when(F.col("rule_id").isin("A2", "F1"), sections)
    return items.withColumn("missing", F.coalesce(missing, F.array().cast("array<string>")))


def suppress_gaps(items: DataFrame, hits: DataFrame, documents: DataFrame) -> DataFrame:
    """``items`` with ``suppressed``: none of the skipped anchors is in the document's evidence.

    ``documents``: doc_id of documents that have evidence; others suppress nothing. An
    anchor with places needs a credible one, an anchor in no place isn't there.
    """
    there = hits.filter(T.credible_location(F.col("snippet"), F.col("anchor"))).select("doc_id", F.col("anchor").alias("a")).distinct()
    keyed = skipped_anchors(items).withColumn("key", F.xxhash64("doc_id", "rule_id", "source_refs", "reason"))
    found = keyed.select("doc_id", "key", F.explode("missing").alias("a")).join(there, ["doc_id", "a"], "left_semi").select("doc_id", "key").distinct().withColumn("found", F.lit(True))
    with_evidence = documents.select("doc_id").distinct().withColumn("evidence", F.lit(True))
    out = keyed.join(found, ["doc_id", "key"], "left").join(with_evidence, "doc_id", "left")
    return out.withColumn("suppressed", (F.size("missing") > 0) & F.col("evidence").isNotNull() & F.col("found").isNull()).drop("key", "found", "evidence")


def structural_text(units: DataFrame) -> DataFrame:
    """doc_id, text: what headings, captions, pictures and tables say in a document, line by line in the order of its units.

    Of a table the numbers that fill a cell, and its text if that begins as a caption does.
    """
    raw = F.coalesce("raw_text", F.lit(""))
    cells = F.regexp_extract_all(raw, F.lit(P.NUMBER_CELL), F.lit(1))
    named = F.when(F.rlike(raw, F.lit(P.CAPTION_START)), F.array(U.content())).otherwise(F.array().cast("array<string>"))
    parts = F.when(U.is_type(P.STRUCTURAL_TYPES), F.array(U.content())).when(U.is_type(P.TABLE_TYPES), F.concat(cells, named))
    each = units.select("doc_id", "ord", parts.alias("parts")).filter(F.size("parts") > 0)
    lines = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ord", "parts"))), lambda p: p["parts"]))
    return each.groupBy("doc_id").agg(F.array_join(lines, "\n").alias("text"))


def recovery(units: DataFrame, hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """G3R: units for required anchors that only the evidence has, and anchors without a usable line.

    The first usable place of an anchor counts; of equal lines of a page that of the
    first anchor by name.
    """
    own = units.select("doc_id", F.explode(T.anchors(U.content())).alias("anchor")).distinct()
    boxed = F.col("x0").isNotNull() & F.col("y0").isNotNull() & F.col("x1").isNotNull() & F.col("y1").isNotNull()
    wanted = hits.filter(F.rlike("anchor", F.lit(P.REQUIRED_ANCHOR))).join(own, ["doc_id", "anchor"], "left_anti")
    lines = wanted.withColumn("line", T.safe_line(F.col("line_text"), boxed, F.col("heading_like"), F.col("anchor")))
    best = lines.groupBy("doc_id", "anchor").agg(F.min_by(F.struct("page", "line", "x0", "y0", "x1", "y1"), F.when(F.col("line").isNotNull(), F.col("hit_ord"))).alias("hit"))
    kind = T.recovery_kind(F.col("anchor"))
    found = best.filter("hit is not null").select("doc_id", "anchor", "hit.*").withColumn("page", F.coalesce("page", F.lit(0)))
    nth = F.row_number().over(Window.partitionBy("doc_id", "page", F.lower("line")).orderBy("anchor"))
    found = found.withColumn("nth", nth).filter("nth = 1").drop("nth")
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("anchor")) + 2_000_000_000
    note = F.struct(F.lit("G3R").alias("rule_id"), "anchor", kind.alias("kind"), F.lit("source_pdf_audit_line").alias("source"), F.lit(True).alias("requires_review"))
    made = found.select("doc_id", place.cast("int").alias("ord"), F.concat(F.lit("source-pdf-recovery:p"), "page", F.lit(":"), T.slug(F.col("anchor"))).alias("unit_id"), F.lit("block").alias("granularity"), "page", T.recovery_dtype(kind).alias("dtype"), F.col("line").alias("raw_text"), F.lower("line").alias("audit_text"), "x0", "y0", "x1", "y1", F.lit(None).cast("double").alias("page_width"), F.lit(None).cast("double").alias("page_height"), note.alias("recovery"))
    return made, best.filter("hit is null").select("doc_id", "anchor", kind.alias("kind"), F.lit("no_complete_bbox_backed_structural_line").alias("reason"))


def recover(units: DataFrame, hits: DataFrame) -> DataFrame:
    """Units with the recovered ones."""
    return units.unionByName(recovery(units, hits)[0])
