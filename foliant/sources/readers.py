"""Sources: parser JSON, unit tables, documents as units, evidence tables, rendered pages, connector payloads."""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructType

from ..functions import patterns as P
from ..functions import text as T
from ..schemas import DECISIONS, DECISION_DOCS, OUTPUT_BLOCKS, UNITS
from ..ship import ship

_PAGES = "array<struct<page_idx:int,page_size:array<double>,para_blocks:array<string>,discarded_blocks:array<string>>>"


def _walk(node, out: list[str]) -> None:
    if isinstance(node, dict):
        for span in node.get("spans") if isinstance(node.get("spans"), list) else ():
            table = span.get("html") if span.get("type") == "table" else None
            out.append(table or span.get("content") or span.get("text") or "")
        for inner in ("lines", "blocks"):
            _walk(node.get(inner), out)
    elif isinstance(node, list):
        for item in node:
            _walk(item, out)


@F.pandas_udf(StructType().add("type", StringType()).add("text", StringType()).add("bbox", ArrayType(DoubleType())))
def parsed_block(block: pd.Series) -> pd.DataFrame:
    """Type, text (spans at any depth, one a line) and box of a block given as JSON."""
    rows = []
    for raw in block:
        node = json.loads(raw) if raw else {}
        parts: list[str] = []
        _walk(node, parts)
        box = node.get("bbox")
        rows.append((node.get("type"), "\n".join(p.strip() for p in parts if p.strip()).strip(), [float(x) for x in box] if isinstance(box, list) and len(box) == 4 else None))
    return pd.DataFrame(rows, columns=["type", "text", "bbox"])


def read_parser_json(spark: SparkSession, path: str, engine: str = "engine") -> DataFrame:
    """Units of parser JSON files, one document each; the document's id is its file name.

    A page gives its blocks (running text, then discarded), itself, and up to ten runs of
    eight words. Blank blocks give none. Pages without an index take their place.
    """
    raw = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), "([^/]+)$", 1).alias("doc_id"), F.regexp_replace("value", "^﻿", "").alias("json"))
    return parse_documents(raw, engine)


def parse_documents(raw: DataFrame, engine: str = "engine") -> DataFrame:
    """Units of doc_id, json: see ``read_parser_json``."""
    ship(raw.sparkSession)
    pages = raw.select("doc_id", F.posexplode(F.from_json("json", f"pdf_info {_PAGES}")["pdf_info"]).alias("place", "p"))
    pages = pages.select("doc_id", F.coalesce("p.page_idx", "place").alias("page"), "place", F.coalesce("p.para_blocks", F.array()).alias("para"), F.coalesce("p.discarded_blocks", F.array()).alias("gone"), "p.page_size")

    def named(column: str, group: str) -> Column:
        return F.transform(column, lambda b, i: F.struct(F.lit(group).alias("grp"), i.alias("i"), b.alias("json")))

    listed = F.concat(named("para", "para_blocks"), named("gone", "discarded_blocks"))
    blocks = pages.select("doc_id", "page", "place", "page_size", F.posexplode(listed).alias("n", "b")).withColumn("x", parsed_block("b.json")).filter("x.text <> ''")
    blocks = blocks.select("doc_id", "page", "place", "n", F.concat_ws(":", F.col("b.grp"), F.col("b.i").cast("string")).alias("index"), F.lit("block").alias("granularity"), F.coalesce("x.type", "b.grp").alias("dtype"), F.col("x.text").alias("raw_text"), F.col("x.bbox").alias("bbox"), "page_size")
    texts = blocks.groupBy("doc_id", "place").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "raw_text"))), lambda b: b["raw_text"]), "\n").alias("raw_text"))
    whole = pages.join(texts, ["doc_id", "place"], "left").select("doc_id", "page", "place", F.lit(1_000_000).alias("n"), F.lit("page").alias("index"), F.lit("page").alias("granularity"), F.lit("page").alias("dtype"), F.coalesce("raw_text", F.lit("")).alias("raw_text"), F.lit(None).cast("array<double>").alias("bbox"), "page_size")
    runs = whole.select("doc_id", "page", "place", "page_size", F.posexplode(T.shingles(T.normalize_for_audit(F.col("raw_text")))).alias("i", "raw_text"))
    runs = runs.select("doc_id", "page", "place", (F.col("i") + 1_000_001).alias("n"), F.concat(F.lit("shingle:"), F.col("i").cast("string")).alias("index"), F.lit("text").alias("granularity"), F.lit("text").alias("dtype"), "raw_text", F.lit(None).cast("array<double>").alias("bbox"), "page_size")
    units = blocks.unionByName(whole).unionByName(runs).withColumn("audit_text", T.normalize_for_audit(F.col("raw_text")))
    box = [F.col("bbox")[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]
    size = [F.try_element_at("page_size", F.lit(i + 1)).alias(n) for i, n in enumerate(("page_width", "page_height"))]
    return units.select("doc_id", (F.col("place") * 2_000_000 + F.col("n")).cast("int").alias("ord"), F.concat(F.lit(f"{engine}:p"), "page", F.lit(":"), "index").alias("unit_id"), "granularity", "page", "dtype", "raw_text", "audit_text", *box, *size, F.lit(None).cast("struct<rule_id:string,anchor:string,kind:string,source:string,requires_review:boolean>").alias("recovery"))


def with_ids(units: DataFrame, engine: str = "engine") -> DataFrame:
    """canonical_unit_id, dedupe_group_id and primary_engine beside the columns of units."""
    audit = F.coalesce("audit_text", F.lit(""))
    return units.withColumns({"canonical_unit_id": T.canonical_id(audit, F.col("granularity"), F.col("dtype")), "dedupe_group_id": T.dedupe_id(audit), "primary_engine": F.lit(engine)})


def read_units(spark: SparkSession, path: str) -> DataFrame:
    """Units as JSON lines; columns that a file lacks are null."""
    return spark.read.schema(UNITS).json(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Output blocks of repaired documents as JSON lines; columns that a file lacks are null."""
    return spark.read.schema(OUTPUT_BLOCKS).json(path)


def read_decisions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Review decisions (one JSON document a line): decision documents, decisions."""
    raw = spark.read.schema(f"{DECISION_DOCS}, decisions array<struct<action:string,review_item_id:string,rule_id:string,source_refs:array<string>,unit_ids:array<string>,reason:string,match_reason:string>>").json(path)
    each = raw.select("doc_id", F.posexplode("decisions").alias("idx", "d")).select("doc_id", "idx", "d.*")
    return raw.drop("decisions"), each.select(*[c.split()[0] for c in DECISIONS.split(", ")])


def _as_units(rows: DataFrame, per_page: int = 40) -> DataFrame:
    """doc_id, k, text: pages of ``per_page`` blocks, one below the other."""
    page, line = F.floor(F.col("k") / per_page).cast("int"), F.col("k") % per_page
    y0 = (60 + 18 * line).cast("double")
    return rows.select(
        "doc_id", F.col("k").cast("int").alias("ord"), F.concat(F.lit("doc:"), "doc_id", F.lit(":p"), page, F.lit(":b"), F.col("k")).alias("unit_id"), F.lit("block").alias("granularity"), page.alias("page"), F.lit("text").alias("dtype"),
        F.col("text").alias("raw_text"), T.normalize_audit(F.col("text")).alias("audit_text"), F.lit(40.0).alias("x0"), y0.alias("y0"), (40 + 5 * F.length("text")).cast("double").alias("x1"), (y0 + 14).alias("y1"),
        F.lit(None).cast("double").alias("page_width"), F.lit(None).cast("double").alias("page_height"), F.lit(None).cast("struct<rule_id:string,anchor:string,kind:string,source:string,requires_review:boolean>").alias("recovery"),
    )


def by_document(documents: DataFrame, grouped: bool = True) -> DataFrame:
    """doc_id (as a string), text; dealt out by doc_id if later steps are grouped by document.

    With a document's text in place before it is cut into units, their windows and sums need
    no shuffle of their own. Steps that look at single units, or sum by another key, need none at all.
    """
    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.repartition("doc_id") if grouped else rows


def units_by_line(documents: DataFrame, grouped: bool = True) -> DataFrame:
    """Documents as units, one for each line."""
    rows = by_document(documents, grouped).select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("k", "text"))
    return _as_units(rows)


def units_by_words(documents: DataFrame, size: int = 12, grouped: bool = True) -> DataFrame:
    """Documents as units of ``size`` words."""
    def chunks(w):
        starts = F.when(F.size(w) > 0, F.sequence(F.lit(1), F.size(w), F.lit(size))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, size), " "))

    rows = by_document(documents, grouped).select("doc_id", F.posexplode(T.let(T.words(F.col("text")), chunks)).alias("k", "text"))
    return _as_units(rows)


def span_lines(spans: DataFrame) -> DataFrame:
    """Lines of a table of spans (see schemas.SPANS): doc_id, page, line, line_text, box, max_font_size, bold_ratio, median_size."""
    shown = F.when(F.coalesce("text", F.lit("")) != "", F.col("size"))
    length = F.length(F.coalesce("text", F.lit("")))
    text = T.squeezed(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("span", "text"))), lambda s: F.coalesce(s["text"], F.lit(""))), ""))
    lines = spans.groupBy("doc_id", "page", "line").agg(text.alias("line_text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.coalesce(F.max(shown), F.lit(0.0)).alias("max_font_size"), (F.sum(F.when(F.col("flags").bitwiseAND(16) != 0, length).otherwise(0)) / F.greatest(F.sum(length), F.lit(1))).alias("bold_ratio"))
    body = spans.filter("coalesce(text, '') <> ''").groupBy("doc_id", "page").agg(F.median("size").alias("median_size"))
    return lines.filter("line_text <> ''").join(body, ["doc_id", "page"], "left")


def anchor_hits(lines: DataFrame, heading_ratio: float | None = None) -> DataFrame:
    """Places of anchors in evidence lines (schemas.HITS).

    ``heading_ratio``: a line whose font is so many times the page's median, or half of
    it bold, counts as a heading; by default none does.
    """
    like = F.lit(False) if heading_ratio is None else (F.col("max_font_size") >= heading_ratio * F.col("median_size")) | (F.col("bold_ratio") >= 0.5)
    each = lines.select("*", F.explode(T.anchors(F.col("line_text"), P.SOURCE_ANCHOR)).alias("anchor"), like.alias("heading_like"))
    nth = F.row_number().over(Window.partitionBy("doc_id", "anchor").orderBy("page", "line")) - 1
    return each.select("doc_id", "anchor", nth.alias("hit_ord"), "page", F.col("line_text").alias("snippet"), "line_text", "x0", "y0", "x1", "y1", F.coalesce("heading_like", F.lit(False)).alias("heading_like"))


def anchor_snippets(texts: DataFrame) -> DataFrame:
    """doc_id, page, nth, anchor, snippet: every anchor in texts of pages (doc_id, page, text), with the text around it."""
    each = texts.select("doc_id", "page", F.posexplode(T.found_with_snippets(F.col("text"), P.SOURCE_ANCHOR)).alias("nth", "f"))
    return each.select("doc_id", "page", "nth", "f.anchor", "f.snippet")


def text_pages(texts: DataFrame) -> DataFrame:
    """Evidence of pages (schemas.PAGES) of which only the text is known."""
    none = [F.lit(0).alias("image_count"), F.lit(0).alias("drawing_count"), F.lit(None).cast("int").alias("significant_image_count"), F.lit(None).cast("int").alias("significant_drawing_count")]
    return texts.select("doc_id", "page", T.char_count(F.col("text")).cast("bigint").alias("text_chars"), *none)


def page_hits(texts: DataFrame, hits: DataFrame) -> DataFrame:
    """``hits`` of lines, and places in pages' texts of anchors that no line of the page has; numbered anew."""
    more = anchor_snippets(texts).join(hits.select("doc_id", "page", "anchor").distinct(), ["doc_id", "page", "anchor"], "left_anti")
    blank = [F.lit(None).cast("string").alias("line_text"), *[F.lit(None).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")], F.lit(False).alias("heading_like")]
    columns = ["doc_id", "anchor", "page", "snippet", "line_text", "x0", "y0", "x1", "y1", "heading_like"]
    both = hits.select(*columns, F.lit(0).alias("kind"), F.col("hit_ord").alias("at")).unionByName(more.select("doc_id", "anchor", "page", "snippet", *blank, F.lit(1).alias("kind"), F.col("nth").alias("at")))
    nth = F.row_number().over(Window.partitionBy("doc_id", "anchor").orderBy("page", "kind", "at")) - 1
    return both.select("doc_id", "anchor", nth.alias("hit_ord"), *columns[2:])


class _Data(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.parts: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs) -> None:
        self.skip += tag in ("style", "script", "title")

    def handle_endtag(self, tag) -> None:
        self.skip -= tag in ("style", "script", "title") and self.skip > 0

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.parts.append(data)


@F.pandas_udf(StringType())
def rendered_text(page: pd.Series) -> pd.Series:
    """Text of rendered HTML, without styles, scripts and the title."""

    def one(raw: str | None) -> str:
        parser = _Data()
        parser.feed(raw or "")
        parser.close()
        return " ".join(parser.parts)

    return page.map(one)


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (the file's name), path, length, sha256 of whole files."""
    return spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "([^/]+)$", 1).alias("doc_id"), "path", "length", F.sha2("content", 256).alias("sha256"))


def rendered_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (the file's name without its ending), text of rendered HTML or plain text files; PDF files are read by ``pdf.read_text``."""
    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.regexp_replace(F.decode("content", "UTF-8"), "^\uFEFF", "").alias("raw"))
    page = F.rlike("name", F.lit(r"(?i)\.html?$"))
    text = F.when(page, rendered_text(F.when(page, F.col("raw")))).otherwise(F.col("raw"))
    return files.select(F.regexp_replace("name", r"\.[^.]*$", "").alias("doc_id"), text.alias("text"))


def classify_page(chars: Column, images: Column, drawings: Column) -> Column:
    """The profile of a page: scanned, full of figures, or text."""
    return F.when((chars < 50) & (images > 0), "scan_page").when((drawings > 80) | (images > 3), "figure_heavy_page").otherwise("text_page")


def result_urls(payloads: DataFrame) -> DataFrame:
    """url of each finished result in connector payloads (column ``data``)."""
    each = payloads.select(F.explode("data.extract_result").alias("r")).filter("r.state = 'done'")
    url = F.trim(F.coalesce(F.nullif("r.full_zip_url", F.lit("")), "r.zip_url"))
    return each.select(url.alias("url")).filter("url <> ''")


def poll_finished(payloads: DataFrame) -> DataFrame:
    """batch_id, finished: are all results of a batch done or failed?"""
    return payloads.select("batch_id", F.explode("data.extract_result").alias("r")).groupBy("batch_id").agg(F.bool_and(F.col("r.state").isin("done", "failed")).alias("finished"))


def lexicon(inline: str = "", extra: str = "") -> list[str]:
    """Foreign terms: the list given inline instead of the fixed one, and further ones."""
    cut = lambda s: [w.strip().lower() for w in re.split(r"[,;\n]", s) if w.strip()]
    return sorted(set(cut(inline) or P.ITALIAN_TERMS) | set(cut(extra)))


def key_values(text: str) -> dict[str, str]:
    """KEY=VALUE settings of a connector, one a line; a line without = is an error."""
    out = {}
    for line in filter(None, map(str.strip, text.splitlines())):
        key, sign, value = line.partition("=")
        if not sign:
            raise ValueError(f"KEY=VALUE expected, got {line!r}")
        out[key] = value
    return out
